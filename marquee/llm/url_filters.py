"""URL filters: host rules, then pattern rules indexed by their rarest literal token.

A pattern rule is a regular expression with the literal tokens that every match must hold
as whole tokens of the URL (runs of ASCII letters and digits). How often each of these
tokens occurs in all URLs is counted first; a rule is filed under its rarest one. The
tokens of a URL then fetch the few rules worth trying, and only those run their regular
expression. A rule without a token is tried on every URL.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.tables import table

TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str


@dataclass(frozen=True)
class PatternRule:
    """``regex`` is searched in the lower-cased URL; ``tokens`` are in each of its matches."""

    verdict: str
    regex: str
    tokens: tuple[str, ...] = ()


# The host rules of the registered query, fixed values.
HOST_RULES = (
    HostRule("allow", "org", "/"),
    HostRule("block", "example.org", "/es/"),
    HostRule("block", "example.org", "/en/1"),
    HostRule("allow", "com", "/fr/"),
    HostRule("block", "com", "/de/"),
)

EDGE, END = "(?:^|[^a-z0-9])", "(?:[^a-z0-9]|$)"


def _word(verdict: str, *tokens: str) -> list[PatternRule]:
    return [PatternRule(verdict, f"{EDGE}{t}{END}", (t,)) for t in tokens]


# What production runs with: advertising, adult and gambling pages, pages made for
# visitors of one shop or session, files without text.
PATTERN_RULES = (
    *_word("block", "adserver", "doubleclick", "banner", "casino", "poker", "viagra", "porn", "xxx"),
    PatternRule("block", rf"{EDGE}wp-(?:login|admin|cron)\.php", ("wp",)),  # php5 may stand there
    PatternRule("block", r"/(?:cart|checkout|basket)/(?:add|remove|update)", ()),
    PatternRule("block", rf"[?&](?:phpsessid|jsessionid|sid)=[a-z0-9]{{8,}}{END}", ()),
    PatternRule("block", r"[?&]utm_campaign=[^&#]+&utm_content=", ("utm", "campaign", "content")),
    PatternRule("block", r"[?&]page=[0-9]+&ref=[a-z]{2,}", ("page", "ref")),
    PatternRule("block", rf"/tag/[^/?#]+/page/[0-9]+{END}", ("tag", "page")),
    *[PatternRule("block", rf"\.{t}(?:[?#]|$)", (t,)) for t in ("zip", "exe", "dmg", "iso", "mp4", "jpg", "png")],
)


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null and without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]+", lambda m: m[0].lower(), host), path


def token_counts(urls: DataFrame, rules: Sequence[PatternRule]) -> dict[str, int]:
    """How often each literal token of the rules occurs: at most one row per token."""
    wanted = sorted({token for rule in rules for token in rule.tokens})
    rows = (
        urls.select(F.explode(F.expr(f"regexp_extract_all(lower(url), '{TOKEN}', 0)")).alias("token"))
        .where(F.col("token").isin(wanted))
        .groupBy("token")
        .count()
    )
    return {row["token"]: row["count"] for row in rows.collect()} if wanted else {}


def rule_index(
    rules: Sequence[PatternRule], counts: dict[str, int]
) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers by rarest token, and the rules to try always."""
    index, always = defaultdict(list), []
    for number, rule in enumerate(rules):
        if rule.tokens:
            index[min(rule.tokens, key=lambda t: (counts.get(t, 0), t))].append(number)
        else:
            always.append(number)
    return dict(index), always


def filter_urls(
    pages: DataFrame,
    host_rules: Sequence[HostRule] = HOST_RULES,
    pattern_rules: Sequence[PatternRule] = PATTERN_RULES,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, pattern, tried.

    The longest host rule that fits decides. Without one, the first matching pattern rule
    in the order given does (``pattern`` holds its regular expression), and a URL that no
    rule fits is allowed. ``tried`` counts the regular expressions that ran. A null URL
    fits nothing and is allowed. Repeated rows are judged one by one.
    """
    urls = pages.select(pages[page_id].alias("page_id"), pages[url].cast("string").alias("url"))
    index, always = rule_index(pattern_rules, token_counts(urls, pattern_rules))
    by_host = defaultdict(list)
    for rule in sorted(host_rules, key=lambda r: -len(r.path)):
        by_host[rule.host].append(rule)
    by_host = dict(by_host)

    def host_rule(host: str, path: str) -> HostRule | None:
        labels = host.split(".")
        for i in range(len(labels)):  # the longest host first
            for rule in by_host.get(".".join(labels[i:]), ()):
                if path.startswith(rule.path):
                    return rule
        return None

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        regexes = [re.compile(rule.regex, re.ASCII) for rule in pattern_rules]
        tokens = re.compile(TOKEN)
        for batch in batches:
            rows = []
            for key, address in zip(batch["page_id"], batch["url"], strict=True):
                host, path = split_url(address)
                if fit := host_rule(host, path):
                    rows.append((key, host, path, fit.host + fit.path, fit.verdict, None, 0))
                    continue
                lowered = (address or "").lower()
                fetched = {n for t in set(tokens.findall(lowered)) for n in index.get(t, ())}
                verdict, pattern, tried = "allow", None, 0
                for number in sorted(fetched.union(always)):
                    tried += 1
                    if regexes[number].search(lowered):
                        verdict, pattern = pattern_rules[number].verdict, pattern_rules[number].regex
                        break
                rows.append((key, host, path, None, verdict, pattern, tried))
            yield pd.DataFrame(rows, columns=names)

    schema = (
        f"page_id {urls.schema['page_id'].dataType.simpleString()}, host string, path string,"
        " rule string, verdict string, pattern string, tried int"
    )
    names = ["page_id", "host", "path", "rule", "verdict", "pattern", "tried"]
    return urls.mapInPandas(judge, schema)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).drop("tried")


def oracle(
    host_rules: Sequence[HostRule] = HOST_RULES, pattern_rules: Sequence[PatternRule] = PATTERN_RULES
) -> str:
    """The same in SQL, every rule tried on every URL."""

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    longest = sorted(host_rules, key=lambda r: (-len(r.host), -len(r.path)))
    fits = " ".join(
        f"WHEN ('.' || host) LIKE {text('%.' + r.host)} AND starts_with(path, {text(r.path)})"
        f" THEN {text(r.verdict + ' ' + r.host + r.path)}"
        for r in longest
    )
    first = " ".join(
        f"WHEN regexp_matches(lowered, {text(r.regex)}) THEN {text(r.verdict + ' ' + r.regex)}"
        for r in pattern_rules
    )
    return f"""
WITH parts AS (
    SELECT page_id, lower(coalesce(url, '')) AS lowered,
           CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), hosts AS (
    SELECT page_id, lowered, regexp_extract(rest, '^[^/?#]*') AS host, rest FROM parts
), split AS (
    SELECT page_id, lowered,
           translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path
    FROM hosts
), judged AS (
    SELECT *, CASE {fits} END AS fit, CASE {first} END AS hit FROM split
)
SELECT page_id, host, path,
       CASE WHEN fit IS NOT NULL THEN substr(fit, instr(fit, ' ') + 1) END AS rule,
       coalesce(split_part(fit, ' ', 1), split_part(hit, ' ', 1), 'allow') AS verdict,
       CASE WHEN fit IS NULL AND hit IS NOT NULL THEN substr(hit, instr(hit, ' ') + 1) END AS pattern
FROM judged
"""


ORACLE = oracle()
