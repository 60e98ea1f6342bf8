import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marquee.llm.lexical_search import Best, Document, Queries, build_index, counted, op13_lexical_search, pieces, search, sketch

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(TERMS.findall((text or "").translate(LOWER)))


def plain(docs, items, k=10):
    """(item_id, rank, doc_id, score) by the contract, every document against every item."""
    counts = [(i, terms(t)) for i, t in docs]
    n_docs, tokens = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            score = 0
            for term, repeats in terms(text).items():
                if tf := c[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 75 + (75 * sum(c.values()) * n_docs) // tokens
                    score += repeats * w * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        best = sorted(scored)[:k]
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(best, 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frames(spark, docs, items):
    other = "row string, n string, terms string, query string, rank string"
    docs = spark.createDataFrame([(*r, *"ooooo") for r in docs], f"doc_id long, text string, {other}").repartition(4)
    items = spark.createDataFrame([(*r, *"ooooo") for r in items], f"item_id long, text string, {other}")
    return docs, items


ODD = [
    (1, None), (2, ""), (3, " ,.;\x7f\n"), (4, "The cat"), (5, "the CAT, the cat!"), (5, "the CAT, the cat!"), (None, "the cat"),
    (6, "É é ÉÉ the_cat 日本語\xa0x 🙂"), (7, "cat " * 300), (8, "cat " * 1_000 + "dog " * 254 + "cow " * 255), (9, "a1 B2 " * 200_000),
    (10, "x" * 3_000_000), (11, "the cat"), (12, "the cat"), (13, "Kelvin K İ"), (14, "nul\x00nul"),
]
ASKED = [
    (1, "the cat"), (1, "the cat"), (2, None), (3, ""), (4, "nothing-like-this"), (None, "CAT cat cat dog"), (5, "cow Dog"), (6, "é 日本語\xa0x nul"),
    (7, "a1 b2 " * 50_000), (8, "x" * 3_000_000 + " K"), (9, "k İ kelvin"),
]


@pytest.mark.parametrize(("k", "batch"), [(10, 1_000), (3, 2), (1, 1)])
def test_odd_rows(spark, k, batch):
    docs, items = frames(spark, ODD, ASKED)
    assert got(search(build_index(docs), items, k=k, batch=batch)) == plain(ODD, ASKED, k)


def test_empty_tables(spark):
    docs, items = frames(spark, ODD, ASKED)
    assert search(build_index(docs.where("false")), items).count() == 0
    assert search(build_index(docs), items.where("false")).count() == 0
    assert search(build_index(docs.where("doc_id < 4")), items).count() == 0
    assert search(build_index(docs), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_query_equals_plain(spark, sf_dir):
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*c).collect()]
    assert got(op13_lexical_search(spark, sf_dir)) == plain(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))


def made(n, words, seed):
    chance = random.Random(seed)
    return [(i, " ".join(chance.choices([f"w{int(chance.paretovariate(0.6)) % 5000}" for _ in range(50)] + ["the", "of"], k=chance.randrange(1, words)))) for i in range(n)]


def test_many_ties_and_hot_terms(spark):
    """A third of all documents is one text; every document holds the same word."""
    docs = [(i, "same text here" if i % 3 == 0 else f"same own{i} text{i % 7}") for i in range(2_000)]
    items = [(1, "same text"), (2, "same"), (3, "text1 own5 own6"), (4, "here here text")]
    docs_frame, items_frame = frames(spark, docs, items)
    assert got(search(build_index(docs_frame), items_frame)) == plain(docs, items)


def test_bounds_and_what_is_scored():
    docs, items = made(1_500, 120, 1), made(12, 30, 2)
    docs += [(5_000 + i, t) for i, (_, t) in enumerate(items)] + [(9_000, "the " * 1_000)]
    asked = Queries(items)
    counts = [counted(t) for _, t in docs]
    asked.weigh(sum(map(bool, counts)), sum(sum(c.values()) for c in counts), {i: sum(t in c for c in counts) for i, t in enumerate(asked.terms)})
    lengths = np.array([asked.measure(sum(c.values())) for c in counts], np.int64)
    times = [np.fromiter(c.values(), np.uint32, len(c)) for c in counts]
    bounds = asked.bounds([sketch(list(c), t) for c, t in zip(counts, times, strict=True)], lengths)
    exact = asked.scores(np.array([[c[t] for t in asked.terms] for c in counts], np.int64), lengths)
    assert (bounds >= exact).all() and (bounds[-1] > exact[-1]).any()
    calls = []

    class Watched(Document):
        def score(self, queries, query):
            calls.append(query)
            return super().score(queries, query)

    rows = [(i, d[0], Watched(pa.scalar(b" ".join(c)), pa.scalar(t.tobytes()), int(m))) for i, (d, c, t, m) in enumerate(zip(docs, counts, times, lengths, strict=True))]
    assert all(row[2].score(asked, q) == exact[i, q] for i, row in enumerate(rows[::97]) for i in [row[0]] for q in range(len(items)))
    calls.clear()
    best = Best(asked, 3)
    for start in range(0, len(rows), 256):
        best.take(rows[start : start + 256], bounds[start : start + 256])
    for q in range(len(items)):
        top = sorted(zip(-exact[:, q], [d[0] for d in docs], strict=True))[:3]
        assert sorted((-s, i) for n, _, i, s in best.rows() if n == items[q][0]) == [(s, i) for s, i in top if s < 0]
    # Of all pairs few are scored exactly.
    assert len(calls) < len(rows) * len(items) / 10


def test_long_texts_are_cut_between_terms():
    text = ("ab-" * 900_000 + "c" * 2_000_000 + " " + "é" * 700_000).encode()
    assert b"".join(pieces(text)) == text
    assert counted(text) == Counter(re.findall(rb"[0-9A-Za-z\x80-\xff]+", text))
