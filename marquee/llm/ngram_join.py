"""Near duplicates by n-gram Jaccard similarity, joined with a count-vector R-tree.

A document is the set of its word shingles. Two sets link when their Jaccard similarity
reaches ``similarity``. The join is exact and runs in three steps.

1. Who can have a partner at all. Every set sends all its shingles, slice by slice, and
   counts how many of them another set sends too; a set with fewer than the least overlap
   has no partner. That removes documents which share a passage, or by chance some phrases,
   however large the corpus. A shingle that many texts of a slice carry is counted in the
   slice and sent on as one entry, so it makes no hot group.
2. Families. Texts of the sets left are read again for their whole sets, and the holders of
   their shingles are counted once more. If two sets overlap in t shingles, the first
   n - t + 1 shingles of each, in any common order, share at least one (prefix principle).
   The order is by number of holders, so a prefix holds the rarest shingles of its set, and
   what chance or passages spread over many sets comes last. A set whose prefix is held by
   no other set has no partner. All other sets with a prefix shingle in common are tied to
   one of them, slice by slice and then over all, and connected components over these ties
   hold every pair that can link.
3. R-tree. In a family every set becomes a point: its shingles hashed into ``GROUPS`` groups
   and counted. Points are packed into leaves of an R-tree by size and position. For a query
   set the sum of coordinate minima with a node's maxima bounds the overlap with all sets
   below it, and with a point the overlap with its set; only pairs whose bound reaches the
   needed overlap are verified on the sets themselves. A family too large for one task is
   dealt into blocks, by size first (sets of distant sizes cannot link), as many of a size as
   its sets need, and every pair of blocks that can hold links is a task of its own. Tasks give spanning links, not all pairs.

Equal sets travel once; their documents are brought back by the digest of the set.
"""

from __future__ import annotations

import hashlib
import math
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.components import connected
from marquee.llm.shingles import WIDTH, set_key, sets_of
from marquee.llm.tables import id_and_text, table
from marquee.session import scratch_path, scratch_scope, shuffles_freed, written

SIMILARITY = (75, 100)  # numerator and denominator, so that comparisons stay whole numbers
GROUPS = 64
LEAF = 16
BLOCK_SHINGLES = 2_000_000  # shingles of the sets of a block
DOCUMENT, SETS, SUPPORT = 0, 1, 2  # kinds of rows between the passes
SEVERAL = 0xFFFF  # stands for the sets of a slice that hold a shingle, where they are several
PIECE = np.dtype([("key", "<u4"), ("set", "<u2")])
SHARE = np.dtype([("set", "<u2"), ("shared", "<u4")])
HELD = np.dtype([("key", "<u4"), ("times", "<u2")])
ENTRY = np.dtype([("key", "<u8"), ("owner", "<i8")])


def least_overlap(n: int, similarity: tuple[int, int]) -> int:
    """Shingles that a partner of a set of n shares at least: J >= s means overlap >= s n."""
    top, bottom = similarity
    return -(-n * top // bottom)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(11)) % np.uint64(buckets)).astype(np.int64)


def slice_number() -> int:
    """Of a slice of sets: another one for every slice of every task."""
    return int.from_bytes(os.urandom(7), "little")


def _pieces(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """Rows of documents (slice null, doc_id, n, a, b, text_key), of the sets of a slice
    (bucket null, packed digests, sizes and numbers of shingles shared inside the slice), and
    of packed shingles by bucket."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def row(number, bucket, blobs: list[list[bytes]], keys: pa.DataType) -> pa.RecordBatch:
        rows = len(bucket)
        blobs = [pa.array(b, pa.binary()) for b in blobs]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(rows, number)),
                pa.array(bucket, pa.int32()),
                pa.nulls(rows, keys),
                *[pa.nulls(rows, pa.int64())] * 4,
                *blobs,
                *[pa.nulls(rows, pa.binary())] * (4 - len(blobs)),
            ],
            names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for first, sets in sets_of(batch.column(1), width):
                digests = [set_key(s) for s in sets]
                rows = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(rows, pa.int64()),
                        pa.nulls(rows, pa.int32()),
                        keys.slice(first, rows),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([d[0] for d in digests], pa.int64()),
                        pa.array([d[1] for d in digests], pa.int64()),
                        batch.column(2).slice(first, rows),
                        *[pa.nulls(rows, pa.binary())] * 4,
                    ],
                    names,
                )
                fresh = {digest: own for own, digest in zip(sets, digests, strict=True) if len(own)}
                every = list(fresh)
                for at in range(0, len(every), SEVERAL):
                    part = every[at : at + SEVERAL]
                    sizes = np.array([len(fresh[d]) for d in part])
                    flat = np.concatenate([fresh[d] for d in part])
                    order = np.argsort(flat, kind="stable")
                    flat, owner = flat[order], np.repeat(np.arange(len(part)), sizes)[order]
                    start = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
                    several = np.diff(np.append(start, len(flat))) > 1
                    # What several sets of the slice hold is shared, whatever others send.
                    inside = np.bincount(owner[np.repeat(several, np.diff(np.append(start, len(flat))))], minlength=len(part))
                    number = slice_number()
                    yield row(number, [None], [[np.array([d[i] for d in part], np.int64).tobytes()] for i in range(2)] + [[sizes.astype(np.int64).tobytes()], [inside.astype(np.int64).tobytes()]], keys.type)
                    flat = flat[start]
                    entries = np.empty(len(flat), PIECE)
                    entries["key"] = flat.astype(np.uint32)
                    entries["set"] = np.where(several, SEVERAL, owner[start])
                    spots, blobs = by_bucket(entries, bucket_of(flat, buckets))
                    yield row(number, spots, [blobs], keys.type)

    names = ["slice", "bucket", "doc_id", "n", "a", "b", "text_key", "first", "second", "sizes", "inside"]
    return docs.mapInArrow(
        run,
        f"slice bigint, bucket int, doc_id {kind}, n bigint, a bigint, b bigint, text_key bigint, "
        "first binary, second binary, sizes binary, inside binary",
    )


def by_bucket(entries: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Buckets and the packed entries of each."""
    order = np.argsort(goal, kind="stable")
    entries, goal = entries[order], goal[order]
    at = np.flatnonzero(np.concatenate(([True], goal[1:] != goal[:-1]))) if len(goal) else goal
    return goal[at], [e.tobytes() for e in np.split(entries, at[1:])] if len(goal) else []


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of whole buckets, bucket after bucket, to the numbers of shingles that sets of
    a slice share with others; rows of documents and of slices pass through."""

    def count(numbers: list[int], blobs: list[bytes]) -> pa.RecordBatch:
        entries = np.frombuffer(b"".join(blobs), PIECE)
        keys = np.sort(entries["key"])
        twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
        own = np.flatnonzero(entries["set"] != SEVERAL)
        if len(twice):
            found = np.minimum(np.searchsorted(twice, entries["key"][own]), len(twice) - 1)
            own = own[twice[found] == entries["key"][own]]
        else:
            own = own[:0]
        # The number of the blob, then the set.
        blob = np.repeat(np.arange(len(blobs)), [len(b) // PIECE.itemsize for b in blobs])[own]
        code, times = np.unique(blob << 16 | entries["set"][own], return_counts=True)
        shares = np.empty(len(code), SHARE)
        shares["set"], shares["shared"] = code & 0xFFFF, times
        at, packed = by_bucket(shares, code >> 16)
        rows = len(packed)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(rows, SUPPORT), pa.int32()),
                pa.array([numbers[i] for i in at], pa.int64()),
                pa.nulls(rows, kind),
                *[pa.nulls(rows, pa.int64())] * 4,
                pa.array(packed, pa.binary()),
                *[pa.nulls(rows, pa.binary())] * 3,
            ],
            names,
        )

    names = ["kind", "slice", "doc_id", "n", "a", "b", "text_key", "first", "second", "sizes", "inside"]
    now, numbers, blobs, kind = None, [], [], None
    for batch in batches:
        kind = batch.schema.field(2).type
        whole = batch.filter(batch.column(1).is_null())
        if len(whole):
            kinds = np.where(whole.column(0).is_null().to_numpy(zero_copy_only=False), DOCUMENT, SETS)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), whole.column(0), *whole.columns[2:]], names)
        for number, bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(7), strict=True):
            if bucket is None:
                continue
            if bucket != now and blobs:
                yield count(numbers, blobs)
                numbers, blobs = [], []
            now = bucket
            numbers.append(number)
            blobs.append(blob.as_py())
    if blobs:
        yield count(numbers, blobs)


def _supported(shared: DataFrame, similarity: tuple[int, int], buckets: int) -> DataFrame:
    """a, b, n of the sets that share their least overlap with others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digests, sizes, total = None, [], None, None

        def left() -> pa.RecordBatch:
            good = total >= [least_overlap(int(n), similarity) for n in sizes]
            return pa.RecordBatch.from_arrays([pa.array(x[good]) for x in (*digests, sizes)], ["a", "b", "n"])

        for batch in batches:
            for number, kind, *blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == SETS:
                    if now is not None:
                        yield left()
                    first, second, sizes, total = (np.frombuffer(x, np.int64) for x in blobs)
                    now, digests, total = number, (first, second), total.copy()
                elif number == now:
                    shares = np.frombuffer(blobs[0], SHARE)
                    total[shares["set"]] += shares["shared"]
        if now is not None:
            yield left()

    return (
        shared.where(F.col("kind") != DOCUMENT)
        .select("slice", "kind", "first", "second", "sizes", "inside")
        .repartition(buckets, "slice")
        .sortWithinPartitions("slice", "kind")
        .mapInArrow(run, "a bigint, b bigint, n bigint")
        .distinct()
    )


def _whole_sets(docs: DataFrame, width: int) -> DataFrame:
    """A row per slice of the rows with a zstd-compressed ``body``: a, b and n of its sets,
    each packed, and the sets one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            texts = pa.array(
                [codec.decompress(body.as_py(), size, asbytes=True) for body, size in zip(batch.column(0), batch.column(1).to_pylist(), strict=True)],
                pa.binary(),
            )
            for _, sets in sets_of(texts, width):
                fresh = {set_key(s): s for s in sets if len(s)}
                if not fresh:
                    continue
                digests = np.array(list(fresh), np.int64)
                packed = [digests[:, 0], digests[:, 1], np.array([len(s) for s in fresh.values()], np.int64), np.concatenate(list(fresh.values()))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([slice_number()]), *[pa.array([p.tobytes()], pa.binary()) for p in packed]],
                    ["slice", "a", "b", "n", "own"],
                )

    return docs.select("body", "size").mapInArrow(run, "slice bigint, a binary, b binary, n binary, own binary")


def _holders(slices: DataFrame, buckets: int) -> DataFrame:
    """slice, bucket, times: how many sets hold each distinct shingle of the slice that falls
    into the bucket, packed in the order of the shingles. Up to 127 sets are counted, more
    are told by size. Shingles that agree in 32 bits of their bucket count as one, for all
    their holders alike."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys, times = np.unique(np.frombuffer(own.as_buffer(), np.uint64), return_counts=True)
                entries = np.empty(len(keys), HELD)
                entries["key"], entries["times"] = keys.astype(np.uint32), np.minimum(times, 0xFFFF)
                at, blobs = by_bucket(entries, bucket_of(keys, buckets))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), number)), pa.array(at, pa.int32()), pa.array(blobs, pa.binary())], names
                )

    def count(numbers: list[int], bucket: int, blobs: list[bytes]) -> pa.RecordBatch:
        entries = np.frombuffer(b"".join(blobs), HELD)
        _, back = np.unique(entries["key"], return_inverse=True)
        total = np.bincount(back, entries["times"])
        told = np.minimum(np.where(total < 128, total, 100 + 4 * np.log2(total)), 255).astype(np.uint8)[back]
        ends = np.cumsum([len(b) // HELD.itemsize for b in blobs])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(numbers, pa.int64()),
                pa.array(np.full(len(blobs), bucket), pa.int32()),
                pa.array([t.tobytes() for t in np.split(told, ends[:-1])], pa.binary()),
            ],
            names,
        )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, numbers, blobs = None, [], []
        for batch in batches:
            for number, bucket, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now and blobs:
                    yield count(numbers, now, blobs)
                    numbers, blobs = [], []
                now = bucket
                numbers.append(number)
                blobs.append(blob)
        if blobs:
            yield count(numbers, now, blobs)

    names = ["slice", "bucket", "times"]
    schema = "slice bigint, bucket int, times binary"
    return (
        slices.select("slice", "own")
        .mapInArrow(send, schema)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(meet, schema)
    )


def rarest(own: np.ndarray, times: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """Of the prefix of a set, by number of holders, the shingles that others hold too."""
    reach = len(own) - least_overlap(len(own), similarity) + 1
    order = np.argsort(times, kind="stable")[:reach]  # sets are sorted: ties go by shingle
    return own[order[times[order] > 1]]


def _with_prefixes(slices: DataFrame, similarity: tuple[int, int], buckets: int) -> DataFrame:
    """a, b, n, own and the packed prefix ``head`` of the sets of which others hold a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, told = None, []
        for batch in batches:
            for number, bucket, times, *blobs in zip(*batch.columns, strict=True):
                if bucket.is_valid:
                    if number != now:
                        now, told = number, []
                    told.append(times.as_py())
                    continue
                # The sets of a slice come behind all that is told about their shingles.
                a, b, n, own = (np.frombuffer(x.as_buffer(), t) for x, t in zip(blobs, (np.int64, np.int64, np.int64, np.uint64), strict=True))
                keys, back = np.unique(own, return_inverse=True)
                held = np.empty(len(keys), np.uint8)
                held[np.argsort(bucket_of(keys, buckets), kind="stable")] = np.frombuffer(b"".join(told), np.uint8)
                ends = np.cumsum(n)[:-1]
                sets = np.split(own, ends)
                heads = [rarest(s, t, similarity) for s, t in zip(sets, np.split(held[back], ends), strict=True)]
                keep = [i for i, head in enumerate(heads) if len(head)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array(x[keep]) for x in (a, b, n)],
                        *[pa.array([x[i].tobytes() for i in keep], pa.binary()) for x in (sets, heads)],
                    ],
                    ["a", "b", "n", "own", "head"],
                )
                told = []

    sets = slices.select("slice", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("times"), "a", "b", "n", "own")
    return (
        sets.unionByName(_holders(slices, buckets), allowMissingColumns=True)
        .repartition(buckets, "slice")
        .sortWithinPartitions("slice", F.col("bucket").asc_nulls_last())
        .mapInArrow(run, "a bigint, b bigint, n bigint, own binary, head binary")
    )


def _compressed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, size and zstd body of the texts: a third of the bytes to shuffle. Of
    equal texts without an identifier a task sends one, so that they make no hot group."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        sent = set()
        for batch in batches:
            nameless = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            if nameless.any():
                keep = ~nameless
                for i in np.flatnonzero(nameless):
                    digest = hashlib.blake2b(batch.column(1)[i].as_buffer(), digest_size=16).digest()
                    keep[i] = digest not in sent
                    sent.add(digest)
                batch = batch.filter(pa.array(keep))
            plain = [t.as_buffer() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(p) for p in plain], pa.int64()),
                    pa.array([codec.compress(p, asbytes=True) for p in plain], pa.binary()),
                ],
                ["doc_id", "text_key", "size", "body"],
            )

    return docs.mapInArrow(run, f"doc_id {kind}, text_key bigint, size bigint, body binary")


class CountTree:
    """An R-tree of two levels over count vectors: leaves of ``LEAF`` points with their
    coordinate maxima and smallest and largest set."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        spread = np.argmax(points.astype(np.int64), axis=1) if len(points) else np.zeros(0, np.int64)
        # Sorted by size, runs of leaves by where the points reach furthest.
        by_size = np.argsort(sizes, kind="stable")
        run = LEAF * 16
        self.order = np.concatenate(
            [part[np.argsort(spread[part], kind="stable")] for part in np.split(by_size, range(run, len(by_size), run))]
        ) if len(points) else by_size
        self.points, self.sizes = points[self.order], sizes[self.order]
        at = np.arange(0, len(points), LEAF)
        self.high = np.maximum.reduceat(self.points, at, axis=0) if len(points) else points
        self.least = np.minimum.reduceat(self.sizes, at) if len(points) else sizes
        self.most = np.maximum.reduceat(self.sizes, at) if len(points) else sizes

    def near(self, point: np.ndarray, n: int, similarity: tuple[int, int]) -> np.ndarray:
        """Numbers of the points whose bound allows the similarity, best bound first."""
        top, bottom = similarity

        def enough(bound: np.ndarray, size: np.ndarray) -> np.ndarray:
            # overlap / (n + size - overlap) >= top / bottom
            return bound * (top + bottom) >= top * (n + size)

        reach = np.minimum(self.high, point).sum(axis=1, dtype=np.int64)
        leaves = np.flatnonzero(
            enough(np.minimum(reach, n), np.maximum(self.least, 1))
            & (self.most * bottom >= n * top)
            & (self.least * top <= n * bottom)
        )
        rows = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
        rows = rows[rows < len(self.order)]
        bound = np.minimum(self.points[rows], point).sum(axis=1, dtype=np.int64)
        good = enough(bound, self.sizes[rows])
        rows, bound = rows[good], bound[good]
        return self.order[rows[np.argsort(-bound, kind="stable")]]


def count_vector(own: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    return np.bincount((mix_group(own, groups)), minlength=groups).astype(np.uint32)


def mix_group(own: np.ndarray, groups: int) -> np.ndarray:
    return ((own >> np.uint64(7)) % np.uint64(groups)).astype(np.int64)


def linked(x: np.ndarray, y: np.ndarray, similarity: tuple[int, int]) -> bool:
    """The exact test on two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    same = int((y[at] == x).sum())
    return same * similarity[1] >= similarity[0] * (len(x) + len(y) - same)


def spanning_links(
    sets: list[np.ndarray], similarity: tuple[int, int], side: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that connect all sets that any links connect. With ``side``, pairs of one side
    are left to other tasks."""
    sizes = np.array([len(s) for s in sets], np.int64)
    points = np.array([count_vector(s) for s in sets], np.uint32).reshape(len(sets), GROUPS)
    tree = CountTree(points, sizes)
    label = np.arange(len(sets))  # sets that links connect have the same
    links = []
    for i in range(len(sets)):
        near = tree.near(points[i], int(sizes[i]), similarity)
        # Bounds are the same both ways, so lower numbers have been tried.
        near = near[(near > i) & (label[near] != label[i])]
        if side is not None:
            near = near[side[near] != side[i]]
        for j in near.tolist():
            a, b = sorted((int(label[i]), int(label[j])))
            if a != b and linked(sets[i], sets[j], similarity):
                label[label == b] = a
                links.append((i, j))
    return links


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: tuple[int, int] = SIMILARITY,
    width: int = WIDTH,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest identifier that links reach. A document without words
    (null, empty or blank text) has no shingles, links with nothing and is its own
    component. Rows with equal sets are linked. A null identifier is larger than any other
    and is the component only of rows without another. An empty table gives no rows.
    """
    spark = docs.sparkSession
    # A text without an identifier is found again by its hash.
    rows = id_and_text(docs, doc_id, text).withColumn(
        "text_key", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(64, 4 * tasks)
    kind = rows.schema["doc_id"].dataType.simpleString()
    with shuffles_freed(spark):
        # Documents only pass by: those of equal sets are dealt out too.
        spot = F.coalesce(
            "bucket", F.pmod(F.coalesce("slice", F.xxhash64("doc_id", "a", "b")), F.lit(buckets)).cast("int")
        )
        shared = written(
            _pieces(rows, width, buckets)
            .repartition(buckets, spot)
            .sortWithinPartitions("bucket")
            .mapInArrow(
                _shared,
                f"kind int, slice bigint, doc_id {kind}, n bigint, a bigint, b bigint, text_key bigint, "
                "first binary, second binary, sizes binary, inside binary",
            ),
            "shared",
        )
        members = shared.where(F.col("kind") == DOCUMENT).select("doc_id", "n", "a", "b", "text_key")
        groups = written(
            members.where("n > 0")
            .groupBy("a", "b", "n")
            .agg(F.min("doc_id").alias("first"), F.min("text_key").alias("text_key"), F.count("*").alias("copies")),
            "sets",
        )
        roots = scratch_path(spark, "roots")
        with scratch_scope(spark):  # the sets go as soon as their links are known
            eligible = groups.join(_supported(shared, similarity, buckets), ["a", "b", "n"]).select(
                F.col("first").alias("wanted"), F.when(F.col("first").isNull(), F.col("text_key")).alias("wanted_key")
            )
            bodies = _compressed(rows).join(
                eligible.distinct(),
                F.col("doc_id").eqNullSafe(F.col("wanted")) & F.col("text_key").eqNullSafe(F.col("wanted_key")),
                "left_semi",
            )
            # A row that repeats the identifier (or the hash) with another text brings a set
            # nobody asked for; it does no harm. Equal sets are left once.
            slices = written(_whole_sets(bodies, width), "whole-sets")
            sets = written(_with_prefixes(slices, similarity, buckets).dropDuplicates(["a", "b"]), "prefixes")
            families = connected(_ties(sets, buckets))
            placed = sets.join(families, sets["a"] == families["node"]).select(
                F.col("root").alias("family"), "a", "n", "own"
            )
            connected(_links(placed, similarity)).write.parquet(roots)
    roots = spark.read.schema("node bigint, root bigint").parquet(roots)
    labelled = groups.join(roots, groups["a"] == roots["node"], "left").withColumn(
        "root", F.coalesce("root", "a")
    )
    lowest = labelled.groupBy("root").agg(F.min("first").alias("component"), F.sum("copies").alias("all"))
    named = (
        labelled.join(lowest.where("all > 1"), "root")
        .select("a", "b", F.col("n").alias("n_set"), "component")
    )
    return members.join(
        named, (members["a"] == named["a"]) & (members["b"] == named["b"]) & (members["n"] == named["n_set"]), "left"
    ).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def _ties(sets: DataFrame, buckets: int) -> DataFrame:
    """u, v: the smallest set that has a prefix shingle, and every other set that has it.

    A task ties the sets of a slice to the smallest of them and sends only that one on, so
    a shingle of very many sets is a few rows by the time they meet.
    """

    def stars(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of the smallest owner of each key, and distinct (smallest, other) pairs."""
        entries = np.unique(entries)  # by key, then by owner
        fresh = np.concatenate(([True], entries["key"][1:] != entries["key"][:-1]))
        low = entries["owner"][fresh][np.cumsum(fresh) - 1]
        pairs = np.stack((low[~fresh], entries["owner"][~fresh]), axis=1)
        return entries[fresh], np.unique(pairs, axis=0)

    def rows(pairs: np.ndarray, at: np.ndarray, blobs: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([pa.array(pairs[:, i]), pa.nulls(len(at), pa.int64())])
                for i in range(2)
            ]
            + [
                pa.concat_arrays([pa.nulls(len(pairs), pa.int32()), pa.array(at, pa.int32())]),
                pa.concat_arrays([pa.nulls(len(pairs), pa.binary()), pa.array(blobs, pa.binary())]),
            ],
            ["u", "v", "bucket", "entries"],
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            heads = [np.frombuffer(o.as_buffer(), np.uint64) for o in batch.column(1)]
            entries = np.empty(sum(map(len, heads)), ENTRY)
            entries["key"] = np.concatenate(heads)
            entries["owner"] = np.repeat(np.array(batch.column(0)), [len(h) for h in heads])
            lowest, pairs = stars(entries)
            yield rows(pairs, *by_bucket(lowest, bucket_of(lowest["key"], buckets)))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(blobs: list[bytes]) -> pa.RecordBatch:
            pairs = stars(np.frombuffer(b"".join(blobs), ENTRY))[1]
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

        now, blobs = None, []
        for batch in batches:
            ready = batch.filter(batch.column(2).is_null())
            yield pa.RecordBatch.from_arrays(ready.columns[:2], ["u", "v"])
            for bucket, blob in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
                if bucket is None:
                    continue
                if bucket != now and blobs:
                    yield solve(blobs)
                    blobs = []
                now = bucket
                blobs.append(blob.as_py())
        if blobs:
            yield solve(blobs)

    spot = F.coalesce("bucket", F.pmod(F.xxhash64("u", "v"), F.lit(buckets)).cast("int"))
    return (
        sets.select("a", "head")
        .mapInArrow(send, "u bigint, v bigint, bucket int, entries binary")
        .repartition(buckets, spot)
        .sortWithinPartitions("bucket")
        .mapInArrow(meet, "u bigint, v bigint")
    )


def _paired(placed: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """family, pair of blocks, block, a and own: every set once for each pair it is tried in."""
    top, bottom = similarity
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(bottom / top)).cast("int")
    placed = placed.withColumn("band", band)
    # Families are numbers of sets tied together; small ones are packed in tasks by hash. Of
    # large ones each band has the blocks it needs.
    bands = placed.groupBy("family", "band").agg(F.sum("n").alias("weight"))
    large = bands.groupBy("family").agg(F.sum("weight").alias("all")).where(F.col("all") > BLOCK_SHINGLES)
    bands = bands.join(large.select("family"), "family").select(
        "family", "band", F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int").alias("parts")
    )
    for name, step in (("below", 1), ("above", -1)):
        beside = bands.select("family", (F.col("band") + step).alias("band"), F.col("parts").alias(name))
        bands = bands.join(beside, ["family", "band"], "left")
    dealt = placed.join(bands, ["family", "band"], "left").withColumn(
        "part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    )

    def named(step: int, part: Column) -> Column:
        return F.concat_ws(":", F.col("band") + step, part)

    def met(count: str, pair: Callable[[Column], Column]) -> Column:
        several = F.transform(F.sequence(F.lit(0), F.col(count) - 1), pair)
        return F.when(F.col(count) > 0, several).otherwise(F.array().cast("array<string>"))

    # A block meets the other blocks of its band, those of the bands beside it, and itself.
    part = F.col("part")
    pairs = F.when(
        F.col("parts") > 0,
        F.concat(
            met("parts", lambda p: F.concat_ws("|", named(0, F.least(part, p)), named(0, F.greatest(part, p)))),
            met("above", lambda p: F.concat_ws("|", named(0, part), named(1, p))),
            met("below", lambda p: F.concat_ws("|", named(-1, p), named(0, part))),
        ),
    ).otherwise(F.array(F.lit("")))
    block = F.when(F.col("parts") > 0, named(0, part)).otherwise("")
    return dealt.select("family", "a", "own", block.alias("block"), F.explode(pairs).alias("pair"))


def _links(placed: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """u, v: spanning links inside each family, block by block where it is large."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(o, np.uint64) for o in group["own"]]
        ids = group["a"].to_numpy()
        first, _, second = key[1].partition("|")
        side = None if first == second else (group["block"] == first).to_numpy()
        links = spanning_links(sets, similarity, side) if len(sets) > 1 else []
        return pd.DataFrame({"u": [ids[i] for i, _ in links], "v": [ids[j] for _, j in links]}, dtype="int64")

    return _paired(placed, similarity).groupBy("family", "pair").applyInPandas(run, "u bigint, v bigint")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), places AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words
), shingles AS (
    SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p || ' '
            || lead(word, 3) OVER p || ' ' || lead(word, 4) OVER p AS s
        FROM places WINDOW p AS (PARTITION BY doc_id ORDER BY i)
    ) WHERE s IS NOT NULL
    UNION ALL
    SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 4
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS same
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * same >= 75 * (p.n + q.n - same)
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM words
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT words.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM words LEFT JOIN sizes USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
"""
