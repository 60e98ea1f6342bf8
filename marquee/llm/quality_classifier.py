"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is measured (kinds of
characters, word lengths, repeated words and word triples), encoded by a small layer, and
weighted by learned gated attention: exp(w . (tanh(V h) * sigmoid(U h))), normalised over
the document. The weighted sum of the encodings gives the score. Only the document's label
is known in training; which passages speak for it is learned.

Training takes at most ``MOST_DOCS`` labelled documents (those whose identifier has the
smallest hashes) of at most ``MOST_PASSAGES`` passages, so it fits the driver whatever the
corpus holds. Scoring reads every passage of every document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.shingles import words_of
from marquee.llm.tables import id_and_text, table
from marquee.llm.textbytes import mix, prefix, slices, span_hashes

PASSAGE = 50
MOST_DOCS = 6_000
MOST_PASSAGES = 200
HIDDEN, GATE = 16, 8
STEPS, RATE, DECAY = 300, 0.02, 1e-4
NEAR = 12  # words back in which a repeated word counts as near

_KINDS = np.zeros(256, np.int64)
_KINDS[0x80:] = 1
_KINDS[0x61:0x7B] = 2
_KINDS[0x41:0x5B] = 3
_KINDS[0x30:0x3A] = 4
for _kind, _of in enumerate((b".,;:", b"!?", b"|<>", b"#*$%&", b"\n", b" \t\r\x0b\x0c"), 5):
    _KINDS[list(_of)] = _kind
KINDS = 11
FEATURES = KINDS + 6


def passages(ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Measures of all passages (rows), and how many passages come before each text's end.
    A text without words is one passage of zeros."""
    starts, stops, places = words_of(ends, data)
    n_words = np.diff(places)
    n_parts = np.maximum(-(-n_words // PASSAGE), 1)
    bounds = np.concatenate(([0], np.cumsum(n_parts)))
    out = np.zeros((bounds[-1], FEATURES), np.float32)
    if not len(starts):
        return out, bounds
    whose = np.repeat(np.arange(len(n_words)), n_words)
    rank = np.arange(len(starts)) - places[whose]
    part = bounds[whose] + rank // PASSAGE
    heads = np.flatnonzero(rank % PASSAGE == 0)
    rows = part[heads]
    words = np.bincount(part, minlength=len(out))[rows].astype(np.float32)
    # A passage reaches from its first word to the end of its last.
    low = starts[heads]
    high = stops[np.append(heads[1:], len(starts)) - 1]
    kinds = _KINDS[data]
    size = np.maximum(high - low, 1).astype(np.float32)
    for k in range(KINDS):
        sums = np.concatenate(([0], np.cumsum(kinds == k)))
        out[rows, k] = (sums[high] - sums[low]) / size
    hashes = span_hashes(prefix(data), starts, stops)
    near = np.zeros(len(starts), bool)
    next_to = np.zeros(len(starts), bool)
    for k in range(1, min(NEAR + 1, len(starts))):
        same = (hashes[k:] == hashes[:-k]) & (whose[k:] == whose[:-k])
        near[k:] |= same
        if k == 1:
            next_to[1:] = same
    again = np.zeros(len(starts), bool)
    if len(starts) >= 3:
        triple = mix(hashes[:-2] + hashes[1:-1] * np.uint64(3) + hashes[2:] * np.uint64(7) + whose[2:].astype(np.uint64))
        _, first = np.unique(triple, return_index=True)
        later = np.ones(len(triple), bool)
        later[first] = False
        again[2:] = later & (rank[2:] >= 2)
    lengths = (stops - starts).astype(np.float32)
    total = lambda x: np.bincount(part, x, len(out))[rows] / words
    out[rows, KINDS] = total(near)
    out[rows, KINDS + 1] = total(next_to)
    out[rows, KINDS + 2] = total(again)
    out[rows, KINDS + 3] = total(lengths) / 10
    out[rows, KINDS + 4] = np.sqrt(np.maximum(total(lengths**2) - total(lengths) ** 2, 0)) / 10
    out[rows, KINDS + 5] = np.log1p(words) / 5
    return out, bounds


def _encode(model: dict, x: np.ndarray) -> tuple[np.ndarray, ...]:
    h = np.tanh((x - model["mean"]) / model["std"] @ model["w1"] + model["b1"])
    t = np.tanh(h @ model["v"])
    s = 1 / (1 + np.exp(-(h @ model["u"])))
    return h, t, s, (t * s) @ model["w"]


def _pool(e: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Attention weights: a softmax over each document's passages."""
    at, n = bounds[:-1], np.diff(bounds)
    a = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
    return a / np.repeat(np.add.reduceat(a, at), n)


def score(model: dict, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    if len(bounds) == 1:
        return np.zeros(0)
    h, _, _, e = _encode(model, x.astype(np.float64))
    z = np.add.reduceat(h * _pool(e, bounds)[:, None], bounds[:-1], axis=0)
    return 1 / (1 + np.exp(-np.clip(z @ model["c"] + model["b"], -500, 500)))


def fit(x: np.ndarray, bounds: np.ndarray, y: np.ndarray, seed: int = 11) -> dict:
    """Learn encoder, attention and output together by Adam on the whole sample."""
    rng = np.random.default_rng(seed)
    x = x.astype(np.float64)
    d = x.shape[1]
    model = {
        "w1": rng.normal(0, d**-0.5, (d, HIDDEN)),
        "b1": np.zeros(HIDDEN),
        "v": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "u": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "w": rng.normal(0, GATE**-0.5, GATE),
        "c": rng.normal(0, HIDDEN**-0.5, HIDDEN),
        "b": np.zeros(1),
    }
    names = list(model)
    model["mean"], model["std"] = x.mean(axis=0), x.std(axis=0) + 1e-6
    scaled = (x - model["mean"]) / model["std"]
    at, n = bounds[:-1], np.diff(bounds)
    m, q = ({k: np.zeros_like(model[k]) for k in names} for _ in range(2))
    for step in range(1, STEPS + 1):
        h, t, s, e = _encode(model, x)
        a = _pool(e, bounds)
        z = np.add.reduceat(h * a[:, None], at, axis=0)
        p = 1 / (1 + np.exp(-np.clip(z @ model["c"] + model["b"], -500, 500)))
        off = (p - y) / len(y)
        dz = np.repeat(off[:, None] * model["c"], n, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, at), n))
        dg = de[:, None] * model["w"]
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ model["v"].T + ds @ model["u"].T) * (1 - h * h)
        slope = {
            "w1": scaled.T @ dh, "b1": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ ds,
            "w": (t * s).T @ de, "c": z.T @ off, "b": off.sum(keepdims=True),
        }
        for k in names:
            g = slope[k] + DECAY * model[k]
            m[k] += 0.1 * (g - m[k])
            q[k] += 0.001 * (g * g - q[k])
            model[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(q[k] / (1 - 0.999**step)) + 1e-8)
    return model


def held_out(doc_id: str = "doc_id"):
    """Rows whose label training never sees."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> dict | None:
    """The model, or None when no labelled document may be learned from."""
    sample = (
        labels.select(labels[doc_id].alias("doc_id"), labels[label].cast("double").alias("label"))
        .where("doc_id IS NOT NULL AND label IS NOT NULL")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(MOST_DOCS)
    )
    # The sample has at most MOST_DOCS rows of two numbers.
    rows = id_and_text(docs, doc_id, text).join(F.broadcast(sample), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ends, data in slices(batch.column(2)):
                x, bounds = passages(ends, data)
                n = len(bounds) - 1
                few = np.diff(bounds) <= MOST_PASSAGES
                blobs = [x[s:e].tobytes() if k else None for s, e, k in zip(bounds, bounds[1:], few, strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(blobs, pa.binary())],
                    ["doc_id", "label", "x"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = (
        rows.select("doc_id", "label", "text")
        .mapInArrow(measure, f"doc_id {kind}, label double, x binary")
        .where("x IS NOT NULL")
        .limit(2 * MOST_DOCS)  # repeated identifiers bring more rows than the sample has
        .collect()
    )
    if not found:
        return None
    found.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in found]
    bounds = np.concatenate(([0], np.cumsum([len(b) for b in bags])))
    return fit(np.concatenate(bags), bounds, np.array([r["label"] for r in found]))


def classify(docs: DataFrame, model: dict | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score of every row; a half without a model. Null text counts as empty: it is
    scored as one passage of zeros."""
    rows = id_and_text(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ends, data in slices(batch.column(1)):
                x, bounds = passages(ends, data)
                n = len(bounds) - 1
                values = score(model, x, bounds) if model else np.full(n, 0.5)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(values, pa.float64())], ["doc_id", "score"]
                )

    return rows.mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model does not reject: each is
    judged where it stands, so nothing is joined."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = pc.fill_null(batch.column(place), "")
            good = np.ones(len(column), bool)
            for first, ends, data in slices(column) if model else ():
                x, bounds = passages(ends, data)
                good[first : first + len(bounds) - 1] = score(model, x, bounds) >= 0.5
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    A null identifier is not held out and has no label. Repeated rows are scored one by one.
    Without any labelled document every score is a half and predicts 1.
    """
    model = train(docs, labels, doc_id, text, label)
    return classify(docs, model, doc_id, text).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
