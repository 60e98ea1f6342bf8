import hashlib
import re

from marquee.llm.exact_dedup import exact_dedup, merge_runs, digests


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    out = []
    for doc_id, text in rows:
        same = [d for d, t in rows if plain(t) == plain(text)]
        keep = min([d for d in same if d is not None], default=None)
        digest = hashlib.sha256(plain(text).encode()).hexdigest()
        out.append((doc_id, keep, len(same), doc_id == keep, digest))
    return sorted(out, key=repr)


def test_odd_rows(make_docs, odd_rows):
    got = sorted(map(tuple, exact_dedup(make_docs(*odd_rows)).collect()), key=repr)
    assert got == expected(odd_rows)


def test_white_space_and_case(make_docs):
    rows = [(3, "a  b"), (2, "a\n\tb"), (1, "A b"), (4, "a b"), (5, " a b"), (6, "a b")]
    got = {r.doc_id: r.keep_id for r in exact_dedup(make_docs(*rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5, 6: 2}


def test_empty_table(make_docs):
    assert exact_dedup(make_docs((1, "x")).where("false")).count() == 0


def test_hot_group_and_number_of_levels(make_docs):
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(600)]
    docs = make_docs(*rows).repartition(24)
    results = [
        sorted(map(tuple, exact_dedup(docs, fan_in=f, levels=n).collect()), key=repr)
        for f, n in ((16, 2), (2, 5), (64, 1))
    ]
    assert results[0] == results[1] == results[2] == expected(rows)
    merged = merge_runs(digests(docs), 2, 5)
    assert merged.count() == 201
