import re

from marquee.llm.url_filters import HOST_RULES, PATTERN_RULES, filter_urls, rule_index, split_url

URLS = [
    None, "", "no scheme.org/x", "http://Example.ORG/en/1?x#y", "https://a.b.example.org/en/2", "http://example.org",
    "http://badexample.org/es/", "http://example.org/es/", "http://x.com/fr/1", "http://x.com/de/", "http://com/fr/",
    "http://x.net/ads/doubleclick/1", "http://x.net/a.zip", "http://x.net/a.zip?b", "http://x.net/wp-login.php",
    "http://x.net/wpxlogin.php", "http://x.net/cart/add", "http://h.net?a=1/../x.jpg", "ftp://poker", "http://x.net/" + "a" * 50_000,
    "http://É.net/casino", "a://b://c/d", "http://x.net/casino", "http://x.net/casino",
]


def pages(spark):
    rows = [(i, u, "other") for i, u in enumerate(URLS)] + [(None, "http://x.org/", "other")]
    return spark.createDataFrame(rows, "page_id long, url string, host string").repartition(2)


def plain(url):
    host, path = split_url(url)
    fits = [r for r in HOST_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.host + r.path))
        return host, path, best.host + best.path, best.verdict, None
    for rule in PATTERN_RULES:
        if re.search(rule.regex, (url or "").lower(), re.ASCII):
            return host, path, None, rule.verdict, rule.regex
    return host, path, None, "allow", None


def test_equals_all_rules_on_all_urls(spark):
    rows = filter_urls(pages(spark)).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        url = "http://x.org/" if r.page_id is None else URLS[r.page_id]
        assert tuple(r)[1:6] == plain(url)
        assert r.tried < len(PATTERN_RULES) / 2


def test_split():
    assert split_url("HTTP://User@Ex.COM:80/a?b") == ("user@ex.com:80", "/a")
    assert split_url("x://É#/a") == ("É", "") and split_url("/a/b") == ("", "")


def test_rules_lie_under_their_rarest_token():
    index, always = rule_index(PATTERN_RULES, {"utm": 50, "campaign": 3, "content": 9})
    number = next(i for i, r in enumerate(PATTERN_RULES) if "utm" in r.tokens)
    assert number in index["campaign"] and len(always) == sum(not r.tokens for r in PATTERN_RULES)


def test_tokens_are_whole_tokens_of_every_match(spark):
    urls = ["http://x.net/wp-login.php5", "http://x.net/wp-cron.phps", "http://x.net/?utm_campaign=a1&utm_content=b", "http://x.net/tag/a/page/2", "http://x.net/?page=2&ref=de2"]
    for url in urls:
        fits = [r for r in PATTERN_RULES if re.search(r.regex, url)]
        assert fits and all(set(r.tokens) <= set(re.findall("[a-z0-9]+", url)) for r in fits)
    rows = filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    assert all(r.verdict == "block" for r in rows)


def test_empty_table(spark):
    assert filter_urls(pages(spark).where("false")).count() == 0
