import re

import corpus_pipeline as P
from marquee.llm.quality_classifier import score_documents
from test_exact_dedup import plain
from test_ngram_join import expected as near_expected
from test_secret_scans import plain_spans


def test_stages_against_plain_versions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(P.STAGES)
    assert list(stages) == ["quality classifier", "exact dedup", "n-gram Jaccard join", "secret scans", "packing"]
    text = {r.doc_id: r.text for r in docs.collect()}

    def run(name, frame):
        out = stages[name](spark, frame, sf_dir)
        if name != "packing":
            assert out.columns == docs.columns
        return spark.createDataFrame(out.collect(), out.schema)

    good = run("quality classifier", docs)
    scores = score_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in scores if r.predicted)

    ids = sorted(r.doc_id for r in good.collect())
    first = {}
    for i in ids:
        first.setdefault(plain(text[i]), i)
    single = run("exact dedup", good)
    assert sorted(r.doc_id for r in single.collect()) == sorted(first.values())

    rows = [(i, text[i]) for i in sorted(first.values())]
    apart = run("n-gram Jaccard join", single)
    assert sorted(r.doc_id for r in apart.collect()) == sorted(d for d, _, c in near_expected(rows) if d == c)

    safe = run("secret scans", apart)
    for r in safe.collect():
        if not plain_spans(text[r.doc_id]):
            assert r.text == text[r.doc_id] or "<live>" in r.text
        else:
            assert not plain_spans(re.sub("<(assign|access|hex|live)>", " ", r.text))

    packed = stages["packing"](spark, safe, sf_dir).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in safe.collect()}
    whole = P.run(spark, sf_dir).collect()
    assert sum(r.length for r in whole) == sum(r.length for r in packed)


def test_copies_go_row_by_row(spark, make_docs):
    words = [f"v{i}" for i in range(90)]
    base, close, other = " ".join(words), " ".join(words[1:]), " ".join(f"u{i}" for i in range(90))
    nameless, last = "one text of no identifier at all", "a text that stands in two equal rows"
    rows = [(5, base), (None, base), (None, close), (None, nameless), (None, nameless), (7, base), (7, other), (8, close)]
    rows += [(9, last), (9, last)]
    single = [(5, base), (7, other), (8, close), (9, last), (None, nameless)]

    def left(stage, frame):
        return sorted(((r.doc_id, r.text) for r in stage(spark, frame, "").collect()), key=repr)

    docs = make_docs(*rows).select(*P.COLUMNS)
    assert left(P.exact, docs) == sorted(single, key=repr)
    assert left(P.near, docs) == sorted([r for r in single if r != (8, close)], key=repr)


def test_nulls_and_empty_table(spark, make_docs, odd_rows, sf_dir):
    """Every stage gives what its plain version gives, on odd rows and with clashing columns."""
    docs = make_docs(*odd_rows)
    out = P.quality_classifier(spark, docs, sf_dir)
    assert out.columns == list(P.COLUMNS)
    texts = {t for _, t in odd_rows}
    assert {r.text for r in out.collect()} <= texts
    every = docs.select(*P.COLUMNS)
    single = P.exact(spark, docs, sf_dir)
    assert len(single.collect()) == len({plain(r.text or "") for r in every.collect()})
    apart = P.near(spark, single, sf_dir)
    assert 0 < apart.count() <= single.count()
    safe = P.secrets(spark, apart, sf_dir)
    assert safe.count() == apart.count() and safe.columns == list(P.COLUMNS)
    pieces = {}
    for r in P.packing(spark, safe, sf_dir).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == {r.doc_id for r in safe.collect()}
    for own in pieces.values():
        documents = sum(r.start == 0 for r in own)
        assert sum(r.length for r in own) == sum(r.doc_tokens for r in own if r.start == 0) and documents >= 1
    nothing = docs.where("false")
    for _, stage in P.STAGES:
        nothing = stage(spark, nothing, sf_dir)
    assert nothing.count() == 0
