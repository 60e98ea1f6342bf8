import zlib

import numpy as np

from marquee.llm import quality_classifier as Q
from marquee.llm.registry import QUERIES


def test_held_out_accuracy(spark):
    rows = QUERIES["op9_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    assert len(rows) == 1000
    assert all(rows.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in rows.doc_id])
    assert all(rows.predicted == (rows.score >= 0.5))
    both = rows.merge(labels, on="doc_id")
    both = both[both.held_out]
    assert (both.predicted == both.quality).mean() > 0.95


def test_odd_rows(spark, make_docs, odd_rows):
    good, bad = "plain words in a row of a text ", "x### y$$$ z%%% w&&& "
    rows = [(100 + i, (good if i % 2 else bad) * 20) for i in range(40)]
    labels = spark.createDataFrame([(100 + i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (100, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs(*rows, *odd_rows)
    out = Q.score_documents(docs, labels).collect()
    assert len(out) == len(rows) + len(odd_rows)
    assert all(0 <= r.score <= 1 for r in out)
    assert [r.held_out for r in out if r.doc_id is None] == [False, False]
    found = {r.doc_id: r.predicted for r in out}
    assert np.mean([found[100 + i] == i % 2 for i in range(40)]) > 0.9
    kept = Q.keep_good(docs, Q.train(docs, labels))
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in out)


def test_training_never_sees_what_is_held_out(spark, make_docs):
    rows = [(i, ("good words here " if i % 2 else "$$$ ### ") * 9) for i in range(60)]
    labels = [(i, i % 2) for i in range(60)]
    turned = [(i, 1 - q if Q.is_held_out(i) else q) for i, q in labels]
    docs = make_docs(*rows)
    a, b = (Q.train(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (labels, turned))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_no_label_and_empty_table(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = Q.score_documents(make_docs((1, "x"), (2, None)), labels).collect()
    assert {(r.score, r.predicted) for r in out} == {(0.5, 1)}
    assert Q.score_documents(make_docs((1, "x")).where("false"), labels).count() == 0


def test_slopes_are_right():
    rng = np.random.default_rng(0)
    x, bounds = rng.normal(size=(30, Q.FEATURES)).astype(np.float32), np.array([0, 3, 4, 10, 30])
    model = Q.fit(x, bounds, np.array([0.0, 1.0, 1.0, 0.0]))
    assert (Q.score(model, x, bounds) > 0.5).tolist() == [False, True, True, False]
