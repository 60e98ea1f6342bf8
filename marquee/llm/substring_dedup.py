"""Removal of byte strings of a fixed length that occur again anywhere in the corpus.

Windows of ``width`` bytes are told apart without sorting all suffixes of the corpus in one
place. Every window owns an anchor: the leftmost of its k-grams with the smallest hash.
Equal windows own equal anchors at the same place, and the windows that own one anchor
follow each other, so a text falls into runs of windows, each with the string it spans.
Runs are dealt by the hash of their anchor; a run whose anchor occurs once in the corpus
holds no repeated window and ends there. Equal runs are counted instead of repeated, which
takes copies and shared passages out before any string is sent.

The strings of the other runs are sent once each, in groups of whole anchors, and a task
finds the repeated windows of a group from a Burrows-Wheeler transform (see ``bwt``):
intervals are expanded backwards, breadth first, and common prefixes come out by increasing
value until the window width is reached. An anchor with more than ``HOT`` different runs
is not held by one task: its windows are counted by hash over all tasks instead, those that
repeat within a task once for all of its strings. An anchor with a single string needs no
comparison: the string occurs twice, and so do all windows in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.bwt import repeated_starts
from marquee.llm.tables import id_and_text, table
from marquee.llm.textbytes import column_bytes, prefix, slices, span_hashes, window_hashes
from marquee.session import written

WIDTH = 200
GRAM = 64
HOT = 2_000  # different runs of an anchor that a task may hold
BATCH_BYTES = 1 << 20  # strings of one transform, beyond whole anchors
COMMON = 16  # runs of a slice with an anchor, from which it is known to be shared
RUN = np.dtype([("h", "<u8"), ("ctx", "<u8"), ("a", "<i8"), ("start", "<u4"), ("size", "<u2"), ("cnt", "<u4")])


def sliding_minima(values: np.ndarray, window: int) -> np.ndarray:
    low, reach = values, 1
    while reach * 2 <= window:
        low = np.minimum(low[: len(low) - reach], low[reach:])
        reach *= 2
    rest = window - reach
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def runs_of(
    ends: np.ndarray, data: np.ndarray, width: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first and last window start (in ``data``) of every run, and the running
    sums of the slice."""
    sums = prefix(data)
    none = np.zeros(0, np.int64)
    if len(data) < width:
        return none.astype(np.uint64), none, none, sums
    grams = window_hashes(sums, gram)
    window = width - gram + 1
    low = sliding_minima(grams, window)
    whole = np.zeros(len(low), bool)
    long = np.diff(ends) >= width
    begins = ends[:-1][long]
    steps = np.zeros(len(low) + 1, np.int64)
    np.add.at(steps, begins, 1)
    np.add.at(steps, ends[1:][long] - width + 1, -1)
    whole = np.cumsum(steps[:-1]) > 0
    change = np.concatenate(([True], low[1:] != low[:-1]))
    change[begins] = True
    firsts = np.flatnonzero(change & whole)
    if not len(firsts):
        return none.astype(np.uint64), none, none, sums
    # A run of equal minima ends before the next one or with its text.
    text_end = ends[1:][np.searchsorted(ends[1:], firsts, "right")] - width
    lasts = np.minimum(np.append(firsts[1:], len(low)) - 1, text_end)
    anchors = np.empty(len(firsts), np.int64)
    for i in range(0, len(firsts), 4096):
        at = firsts[i : i + 4096, None] + np.arange(window)
        anchors[i : i + 4096] = firsts[i : i + 4096] + np.argmin(grams[at], axis=1)
    tied = np.flatnonzero(anchors < lasts)  # the same k-gram again within reach
    if len(tied):
        add_first, add_last, add_anchor = [], [], []
        for t in tied:
            f, last, h = int(firsts[t]), int(lasts[t]), low[firsts[t]]
            places = f + np.flatnonzero(grams[f : last + window] == h)
            # Window i owns the first place at or behind i.
            edges = np.minimum(places, last)
            keep = np.concatenate(([True], edges[1:] > edges[:-1]))
            edges, places = edges[keep], places[keep]
            add_last.append(edges)
            add_first.append(np.concatenate(([f], edges[:-1] + 1)))
            add_anchor.append(places)
        left = np.ones(len(firsts), bool)
        left[tied] = False
        firsts = np.concatenate((firsts[left], *add_first))
        lasts = np.concatenate((lasts[left], *add_last))
        anchors = np.concatenate((anchors[left], *add_anchor))
    return grams[anchors], firsts, lasts, sums


def _runs(docs: DataFrame, width: int, gram: int, buckets: int) -> DataFrame:
    """Rows of documents (bucket null: doc_id, n, a, sha) and of packed runs by bucket."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, ends, data in slices(batch.column(1)):
                raw, rows = data.tobytes(), len(ends) - 1
                digests = [hashlib.sha256(raw[s:e]).digest() for s, e in zip(ends, ends[1:], strict=False)]
                keys = np.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(rows, pa.int32()),
                        ids.slice(first, rows),
                        pa.array(np.diff(ends)),
                        pa.array(keys),
                        pa.array(digests, pa.binary()),
                        pa.nulls(rows, pa.binary()),
                    ],
                    names,
                )
                anchors, firsts, lasts, sums = runs_of(ends, data, width, gram)
                if not len(firsts):
                    continue
                whose = np.searchsorted(ends, firsts, "right") - 1
                # Copies of a text in this slice are one text that counts as often.
                _, one, copy, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
                entries = np.empty(len(firsts), RUN)
                entries["h"], entries["a"] = anchors, keys[whose]
                entries["ctx"] = span_hashes(sums, firsts, lasts + width)
                entries["start"], entries["size"] = firsts - ends[whose], lasts - firsts + width
                entries["cnt"] = times[copy[whose]]
                entries = entries[one[copy[whose]] == whose]
                entries = entries[np.argsort(entries["h"], kind="stable")]
                _, at, count = np.unique(entries["h"], return_index=True, return_counts=True)
                common = np.repeat(count >= COMMON, count)
                # Certainly shared: sent to a bucket of the text, and one mark to that of the
                # anchor so that others with it count as shared.
                told = entries[common]
                marks = entries[at[count >= COMMON]].copy()
                marks["size"], marks["cnt"] = 0, 2
                entries = np.concatenate((entries[~common], marks, told))
                spot = entries["h"] >> np.uint64(13)
                spot[len(entries) - len(told) :] = told["a"].astype(np.uint64)
                goal = (spot % np.uint64(buckets)).astype(np.int64)
                entries["cnt"][len(entries) - len(told) :] |= np.uint32(1 << 31)
                order = np.argsort(goal, kind="stable")
                entries, goal = entries[order], goal[order]
                cut = np.flatnonzero(np.concatenate(([True], goal[1:] != goal[:-1])))
                blobs = [e.tobytes() for e in np.split(entries, cut[1:])]
                rows = len(blobs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(goal[cut], pa.int32()),
                        pa.nulls(rows, ids.type),
                        *[pa.nulls(rows, pa.int64())] * 2,
                        pa.nulls(rows, pa.binary()),
                        pa.array(blobs, pa.binary()),
                    ],
                    names,
                )

    names = ["bucket", "doc_id", "n", "a", "sha", "runs"]
    return docs.mapInArrow(
        run, f"bucket int, doc_id {kind}, n bigint, a bigint, sha binary, runs binary"
    )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of whole buckets whose anchor occurs twice or more, as rows; document rows pass."""

    def keep(blobs: list[bytes]) -> pa.RecordBatch:
        runs = np.frombuffer(b"".join(blobs), RUN)
        sure = runs["cnt"] >= 1 << 31
        told, runs = runs[sure].copy(), runs[~sure]
        told["cnt"] &= np.uint32((1 << 31) - 1)
        _, back = np.unique(runs["h"], return_inverse=True)
        many = np.bincount(back, runs["cnt"])[back] >= 2 if len(runs) else np.zeros(0, bool)
        kept = np.concatenate((runs[many & (runs["size"] > 0)], told))
        columns = [pa.array(kept[c].astype(np.int64)) for c in ("start", "size", "cnt")]
        return pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(kept), kind),
                pa.nulls(len(kept), pa.int64()),
                pa.array(np.ascontiguousarray(kept["a"])),
                pa.nulls(len(kept), pa.binary()),
                pa.array(kept["h"].astype(np.int64)),
                pa.array(kept["ctx"].astype(np.int64)),
                *columns,
            ],
            names,
        )

    names = ["doc_id", "n", "a", "sha", "h", "ctx", "start", "size", "cnt"]
    now, blobs, kind = None, [], None
    for batch in batches:
        kind = batch.schema.field(1).type
        docs = batch.filter(batch.column(0).is_null())
        if len(docs):
            yield pa.RecordBatch.from_arrays(
                [*docs.columns[1:5], *[pa.nulls(len(docs), pa.int64())] * 5], names
            )
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(5), strict=True):
            if bucket is None:
                continue
            if bucket != now and blobs:
                yield keep(blobs)
                blobs = []
            now = bucket
            blobs.append(blob.as_py())
    if blobs:
        yield keep(blobs)


def _bodies(docs: DataFrame) -> DataFrame:
    """a, size and zstd body of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            ends, data = column_bytes(batch.column(0))
            texts = [data[s:e].tobytes() for s, e in zip(ends, ends[1:], strict=False)]
            keys = [int.from_bytes(hashlib.sha256(t).digest()[:8], "little", signed=True) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary()),
                ],
                ["a", "size", "body"],
            )

    return docs.select("text").mapInArrow(run, "a bigint, size bigint, body binary")


def _text(body: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(body, size, asbytes=True) if size else b""


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for body, size, wanted in zip(batch["body"], batch["size"], batch["wanted"], strict=True):
            text = _text(body, size)
            rows += [
                (w["h"], w["ctx"], w["cnt"], w["hot"], text[w["start"] : w["start"] + w["size"]])
                for w in wanted
            ]
        yield pd.DataFrame(rows, columns=["h", "ctx", "cnt", "hot", "string"])


def _ranges(starts: np.ndarray) -> list[int]:
    """First and last of every run of consecutive numbers."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return np.stack((starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)]), axis=1).ravel().tolist()


def _transform(width: int, batch_bytes: int):
    """Groups of whole anchors, in the order of their hash, to (h, ctx, ranges)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(rows: list[tuple]) -> pd.DataFrame:
            starts = repeated_starts(
                [np.frombuffer(r[3], np.uint8) for r in rows], np.array([r[2] for r in rows]), width
            )
            found = [(r[0], r[1], _ranges(s)) for r, s in zip(rows, starts, strict=True) if len(s)]
            return pd.DataFrame(found, columns=["h", "ctx", "ranges"])

        held, size = [], 0
        for batch in batches:
            for row in zip(batch["h"], batch["ctx"], batch["cnt"], batch["string"], strict=True):
                if size >= batch_bytes and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    return run


WINDOW = np.dtype([("w", "<u8"), ("h", "<i8"), ("ctx", "<i8"), ("at", "<u2"), ("cnt", "<u1")])
_PASSED = ["bucket", "h", "ctx", "ats", "windows"]


def _by_string(h: np.ndarray, ctx: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The places of every string (h, ctx) together."""
    order = np.lexsort((at, ctx, h))
    h, ctx, at = h[order], ctx[order], at[order]
    cut = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (ctx[1:] != ctx[:-1])))) if len(h) else np.zeros(0, np.int64)
    return h[cut], ctx[cut], np.split(at.astype(np.int64), cut[1:]) if len(cut) else []


def _windows(width: int, buckets: int):
    """The windows of the strings of hot anchors. One that is repeated among the strings at
    hand is known, and told to its bucket by a mark; the others go there, many in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, ctx, cnt = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("h", "ctx", "cnt"))
            ends, data = column_bytes(batch.column("string"))
            data, ends = data[ends[0] : ends[-1]], ends - ends[0]
            if len(data) < width:
                continue
            sizes = np.maximum(np.diff(ends) - width + 1, 0)
            whose = np.repeat(np.arange(len(sizes)), sizes)
            at = np.arange(len(whose)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hashes = window_hashes(prefix(data), width)[ends[whose] + at]
            names, one, back = np.unique(hashes, return_index=True, return_inverse=True)
            repeated = np.bincount(back, cnt[whose]) >= 2
            hit = repeated[back]
            known = _by_string(h[whose[hit]], ctx[whose[hit]], at[hit])
            n = len(known[0])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int32()), pa.array(known[0]), pa.array(known[1]), pa.array(known[2], pa.list_(pa.int64())), pa.nulls(n, pa.binary())],
                _PASSED,
            )
            sent = np.zeros(len(names), WINDOW)
            sent["w"], sent["cnt"] = names, np.where(repeated, 2, 1)
            sent["h"], sent["ctx"], sent["at"] = h[whose[one]], ctx[whose[one]], at[one]
            goal = (names >> np.uint64(7)) % np.uint64(buckets)
            order = np.argsort(goal, kind="stable")
            sent, goal = sent[order], goal[order]
            cut = np.flatnonzero(np.concatenate(([True], goal[1:] != goal[:-1])))
            n = len(cut)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(goal[cut].astype(np.int32)),
                    *[pa.nulls(n, pa.int64())] * 2,
                    pa.nulls(n, pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in np.split(sent, cut[1:])], pa.binary()),
                ],
                _PASSED,
            )

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of whole buckets the windows that occur twice, by string; what is known passes."""
    names = ["h", "ctx", "ats"]

    def solved(blobs: list[bytes]) -> pa.RecordBatch:
        windows = np.frombuffer(b"".join(blobs), WINDOW)
        _, back = np.unique(windows["w"], return_inverse=True)
        # A mark is of strings that know about the window already.
        hit = windows[(np.bincount(back, windows["cnt"])[back] >= 2) & (windows["cnt"] == 1)]
        h, ctx, ats = _by_string(hit["h"], hit["ctx"], hit["at"])
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(ctx), pa.array(ats, pa.list_(pa.int64()))], names)

    now, blobs = None, []
    for batch in batches:
        passed = batch.filter(batch.column(0).is_null())
        if len(passed):
            yield passed.select(names)
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(4), strict=True):
            if bucket is None:
                continue
            if bucket != now and blobs:
                yield solved(blobs)
                blobs = []
            now = bucket
            blobs.append(blob.as_py())
    if blobs:
        yield solved(blobs)


def _hot_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(
            {"h": batch["h"], "ctx": batch["ctx"], "ranges": [_ranges(np.sort(np.array(x))) for x in batch["ats"]]}
        )


def removed_ranges(found: list[dict], width: int) -> np.ndarray:
    """Maximal runs of bytes (rows of start and end) covered by repeated windows."""
    pairs = np.array(
        [(f["start"] + s, f["start"] + e + width) for f in found for s, e in zip(f["ranges"][::2], f["ranges"][1::2], strict=True)],
        np.int64,
    )
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    fresh = np.concatenate(([True], pairs[1:, 0] > reach[:-1]))
    return np.stack((pairs[fresh, 0], reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(pairs) - 1)]), axis=1)


def _cleaned(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for a, body, size, found in zip(batch["a"], batch["body"], batch["size"], batch["found"], strict=True):
                text, spans = _text(body, size), removed_ranges(found, width)
                left, place = [], 0
                for s, e in spans.tolist():
                    left.append(text[place:s])
                    place = e
                left = b"".join([*left, text[place:]])
                rows.append((a, size - len(left), len(spans), hashlib.sha256(left).digest(), spans.ravel().tolist()))
            yield pd.DataFrame(rows, columns=["key", "n_removed", "n_spans", "kept", "spans"])

    return run


def substring_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    gram: int = GRAM,
    hot: int = HOT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Texts are UTF-8 bytes, null is empty. Every byte covered by a string of ``width`` bytes
    that also starts elsewhere, in the same text or another row, is removed; ``spans`` holds
    start and end of every maximal removed run. Equal rows remove each other whole if they
    are long enough; a text shorter than ``width`` loses nothing. An empty table gives no
    rows.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, doc_id, text)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(64, 4 * tasks)
    kind = rows.schema["doc_id"].dataType.simpleString()
    spot = F.coalesce("bucket", F.pmod(F.xxhash64("a"), F.lit(buckets)).cast("int"))
    table_ = written(
        _runs(rows, width, gram, buckets)
        .repartition(buckets, spot)
        .sortWithinPartitions("bucket")
        .mapInArrow(
            _shared,
            f"doc_id {kind}, n bigint, a bigint, sha binary, h bigint, ctx bigint, start bigint, size bigint, cnt bigint",
        ),
        "runs",
    )
    members = table_.where("h IS NULL").select("doc_id", "n", "a", "sha")
    runs = table_.where("h IS NOT NULL").select("h", "ctx", "a", "start", "size", "cnt")
    contexts = runs.groupBy("h", "ctx").agg(
        F.sum("cnt").alias("cnt"), F.min(F.struct("a", "start", "size")).alias("rep")
    )
    anchors = contexts.groupBy("h").agg(F.count("*").alias("n"))
    compared = written(contexts.join(anchors, "h"), "contexts")
    # The one string of an anchor occurs twice, or the anchor would not be shared: all of its
    # windows are repeated, and there is nothing to compare it with.
    alone = compared.where("n = 1 AND cnt >= 2").select(
        "h", "ctx", F.array(F.lit(0).cast("bigint"), F.col("rep.size") - width).alias("ranges")
    )
    wanted = (
        compared.where("n > 1")
        .select("rep.a", F.struct("h", "ctx", "cnt", (F.col("n") > hot).alias("hot"), "rep.start", "rep.size").alias("w"))
        .groupBy("a")
        .agg(F.collect_list("w").alias("wanted"))
    )
    shared_texts = runs.select("a").distinct()
    bodies = written(
        _bodies(rows).dropDuplicates(["a"]).join(shared_texts, "a", "left_semi"), "bodies"
    )
    strings = written(
        bodies.join(wanted, "a")
        .select("body", "size", "wanted")
        .mapInPandas(_strings, "h bigint, ctx bigint, cnt bigint, hot boolean, string binary"),
        "strings",
    )
    cool = (
        strings.where("NOT hot")
        .drop("hot")
        .repartition(buckets, "h")
        .sortWithinPartitions("h", "ctx")
        .mapInPandas(_transform(width, BATCH_BYTES), "h bigint, ctx bigint, ranges array<bigint>")
    )
    at_home = F.coalesce("bucket", F.pmod(F.xxhash64("h", "ctx"), F.lit(buckets)).cast("int"))
    warm = (
        strings.where("hot")
        .select("h", "ctx", "cnt", "string")
        .mapInArrow(_windows(width, buckets), "bucket int, h bigint, ctx bigint, ats array<bigint>, windows binary")
        .repartition(buckets, at_home)
        .sortWithinPartitions("bucket")
        .mapInArrow(_repeated, "h bigint, ctx bigint, ats array<bigint>")
        .groupBy("h", "ctx")
        .agg(F.flatten(F.collect_list("ats")).alias("ats"))
        .mapInPandas(_hot_ranges, "h bigint, ctx bigint, ranges array<bigint>")
    )
    results = written(cool.union(warm).union(alone), "ranges")
    found = (
        runs.select("h", "ctx", "a", "start").distinct()
        .join(results, ["h", "ctx"])
        .groupBy("a")
        .agg(F.collect_list(F.struct("start", "ranges")).alias("found"))
    )
    cleaned = bodies.join(found, "a").mapInPandas(
        _cleaned(width), "key bigint, n_removed bigint, n_spans bigint, kept binary, spans array<bigint>"
    )
    none = F.lit(0).cast("bigint")
    return members.join(cleaned, members["a"] == cleaned["key"], "left").select(
        "doc_id",
        F.col("n").alias("n_bytes"),
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.lower(F.hex(F.coalesce("kept", "sha"))).alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<bigint>")).alias("spans"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("spans")
