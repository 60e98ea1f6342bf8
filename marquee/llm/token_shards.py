"""Token ids on disk as wavelet matrices, one compressed file per shard.

Documents are dealt by ranges of their identifier and encoded in ascending order. A task
closes a shard when it holds ``shard_ids`` ids, builds its wavelet matrix and writes one
file: a document table, then one bit plane per bit of an id, each with the number of its
zeros and a rank directory, all compressed. The matrix answers access, rank (counting) and
select (occurrence lookup) without the plain ids being stored.

Spark's own writer puts the files down, a record each, so any file system of Spark will do,
and a task that runs again after an executor is lost replaces its own files and nothing else.
The writer closes a record with one byte, which the head of a file does not count.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.tables import id_and_text, table
from marquee.llm.tokens import crc32, default_path, encoded, encoder_of
from marquee.session import scratch_path

MAGIC = b"wavmat02"
HEAD = ">qqqqqqq"  # part, ids of the part before, ids, documents, planes, bytes plain and packed
BLOCK = 512  # bits between two entries of a rank directory
SHARD_IDS = 1 << 21
BEGINNING = 32  # characters of a text by which rows of one identifier are dealt
END_ID = 0


class WaveletMatrix:
    """Bit planes from the highest bit down; plane l holds that bit of all ids in the order
    that stable sorting by the bits above gives them."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], length: int):
        self.planes, self.zeros, self.length = planes, zeros, length
        self.ranks = [self._directory(p) for p in planes]

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        """Ones before every block of the plane."""
        words = np.zeros(-(-len(plane) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
        words[: len(plane)] = plane
        ones = np.bitwise_count(words.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1)
        return np.concatenate(([0], np.cumsum(ones))).astype(np.uint32)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        bits = bits or max(1, int(ids.max()).bit_length() if len(ids) else 1)
        ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        for bit in range(bits - 1, -1, -1):
            ones = ((ids >> bit) & 1).astype(bool)
            planes.append(np.packbits(ones))
            low, high = np.flatnonzero(~ones), np.flatnonzero(ones)
            zeros.append(len(low))
            ids = np.concatenate((ids.take(low), ids.take(high)))
        return cls(planes, zeros, len(ids))

    def decode(self) -> np.ndarray:
        """All ids: the stable sorts undone from the last plane to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        ids = np.zeros(self.length, kind)
        for depth in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[depth], count=self.length).view(bool)
            zeros, above = self.zeros[depth], np.empty_like(ids)
            above[np.flatnonzero(~ones)] = ids[:zeros]
            above[np.flatnonzero(ones)] = ids[zeros:] | kind(1 << (len(self.planes) - 1 - depth))
            ids = above
        return ids

    def _bit(self, depth: int, i: int) -> int:
        return int(self.planes[depth][i >> 3] >> (7 - (i & 7))) & 1

    def _ones(self, depth: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // BLOCK
        part = self.planes[depth][block * (BLOCK // 8) : (i >> 3) + 1].copy()
        if i & 7:
            part[-1] &= 0xFF << (8 - (i & 7)) & 0xFF
        else:
            part = part[: (i >> 3) - block * (BLOCK // 8)]
        return int(self.ranks[depth][block]) + int(np.bitwise_count(part).sum())

    def access(self, i: int) -> int:
        value = 0
        for depth, zeros in enumerate(self.zeros):
            bit = self._bit(depth, i)
            value = value << 1 | bit
            i = zeros + self._ones(depth, i) if bit else i - self._ones(depth, i)
        return value

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        """Where the symbol's copies among the first ``end`` ids lie below the last plane."""
        first = 0
        for depth, zeros in enumerate(self.zeros):
            if symbol >> (len(self.planes) - 1 - depth) & 1:
                first, end = zeros + self._ones(depth, first), zeros + self._ones(depth, end)
            else:
                first, end = first - self._ones(depth, first), end - self._ones(depth, end)
        return first, end

    def rank(self, symbol: int, end: int) -> int:
        """Copies of the symbol among the first ``end`` ids."""
        if symbol >> len(self.planes):
            return 0
        first, last = self._range(symbol, end)
        return last - first

    def select(self, symbol: int, k: int) -> int:
        """Place of the symbol's copy number k, from 0; -1 if there are fewer."""
        if symbol >> len(self.planes):
            return -1
        first, last = self._range(symbol, self.length)
        if not 0 <= k < last - first:
            return -1
        i = first + k
        for depth in range(len(self.planes) - 1, -1, -1):
            one = symbol >> (len(self.planes) - 1 - depth) & 1
            i = self._place(depth, i - self.zeros[depth] if one else i, one)
        return i

    def _place(self, depth: int, k: int, one: int) -> int:
        """Place of bit number k (from 0) of a kind: its block by the directory, then inside."""
        ranks = self.ranks[depth].astype(np.int64)
        before = ranks if one else np.minimum(np.arange(len(ranks)) * BLOCK, self.length) - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.planes[depth][block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)])
        bits = bits[: self.length - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - int(before[block])])

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.rank(symbol, self.length))]


def pack_shard(
    ids: np.ndarray, doc_ids: list[int | None], counts: list[int], part: int, before: int, bits: int
) -> bytes:
    """A shard file: its part, the ids of the part before it, document table and planes."""
    matrix = WaveletMatrix.build(ids, bits)
    body = [
        np.array([d if d is not None else 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        np.array(counts, "<u8").tobytes(),
        np.array(matrix.zeros, "<u8").tobytes(),
    ]
    for plane, ranks in zip(matrix.planes, matrix.ranks, strict=True):
        body += [plane.tobytes(), ranks.astype("<u4").tobytes()]
    plain = b"".join(body)
    packed = pa.compress(plain, codec="zstd", asbytes=True)
    sizes = (len(ids), len(doc_ids), len(matrix.planes), len(plain), len(packed))
    return MAGIC + struct.pack(HEAD, part, before, *sizes) + packed


def unpack_shard(
    content: bytes,
) -> tuple[int, int, list[int | None], np.ndarray, WaveletMatrix]:
    """Part, ids before, document identifiers, their numbers of ids, and the matrix."""
    if content[: len(MAGIC)] != MAGIC:
        raise ValueError("not a shard file")
    at = len(MAGIC) + struct.calcsize(HEAD)
    part, before, length, docs, bits, size, packed = struct.unpack(HEAD, content[len(MAGIC) : at])
    plain = pa.decompress(content[at : at + packed], decompressed_size=size, codec="zstd", asbytes=True)
    place = 0

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal place
        values = np.frombuffer(plain, kind, n, place)
        place += values.nbytes
        return values

    numbers, valid = take("<i8", docs), take("u1", docs)
    counts, zeros = take("<u8", docs).astype(np.int64), take("<u8", bits)
    matrix = WaveletMatrix.__new__(WaveletMatrix)
    matrix.length, matrix.zeros, matrix.planes, matrix.ranks = length, [int(z) for z in zeros], [], []
    for _ in range(bits):
        matrix.planes.append(take("u1", -(-length // 8)))
        matrix.ranks.append(take("<u4", -(-(-(-length // 8)) // (BLOCK // 8)) + 1))
    doc_ids = [int(n) if v else None for n, v in zip(numbers, valid, strict=True)]
    return part, before, doc_ids, counts, matrix


def write_shards(
    docs: DataFrame,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Writes the shard files of all texts to ``folder``, in place of what is there.

    Documents are dealt by ranges of identifier and beginning of the text, so rows without
    an identifier, or with the same one, lie in several tasks too.
    """
    path = tokenizer or default_path()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        bits = (len(encoder.blank_first) - 1).bit_length()
        part = TaskContext.get().partitionId()
        held, doc_ids, counts = [], [], []
        before = full = 0

        def close() -> pa.RecordBatch:
            nonlocal before, full
            ids = np.concatenate(held)
            content = pack_shard(ids, doc_ids, counts, part, before, bits)
            before, full = before + len(ids), 0
            held.clear(), doc_ids.clear(), counts.clear()
            return pa.RecordBatch.from_pydict({"content": pa.array([content], pa.binary())})

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, ids, places in encoded(batch.column(1), encoder):
                for i in range(len(places) - 1):
                    held += [ids[places[i] : places[i + 1]], end]
                    doc_ids.append(keys[first + i])
                    counts.append(int(places[i + 1] - places[i]) + 1)
                    full += counts[-1]
                    if full >= shard_ids:
                        yield close()
        if doc_ids:
            yield close()

    end = np.array([end_id], np.uint32)
    rows = id_and_text(docs, doc_id, text)
    ordered = (
        rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.substring("text", 1, BEGINNING))
        .sortWithinPartitions("doc_id", "text")
    )
    (
        ordered.mapInArrow(pack, "content binary")
        .select(F.col("content").cast("string").alias("value"))
        .write.mode("overwrite")
        .option("lineSep", "\n")
        .option("compression", "none")
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )


def _head(place: int) -> Column:
    """A number of the head of a file."""
    return F.conv(F.hex(F.substring("content", len(MAGIC) + 8 * place + 1, 8)), 16, 10).cast("bigint")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files in ``folder``: doc_id, start, n_tokens, ids_crc32.

    Where a part begins follows from the heads of the files: the table of the parts' sums has
    one row per partition of the write, whatever the number of documents.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                part, before, doc_ids, counts, matrix = unpack_shard(content.as_py())
                ids = matrix.decode()
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": [part] * len(doc_ids),
                        "doc_id": doc_ids,
                        "local": ends - counts + before,
                        "n_tokens": counts,
                        "ids_crc32": [crc32(ids[e - n : e]) for e, n in zip(ends, counts, strict=True)],
                    },
                    schema=out,
                )

    out = pa.schema([(n, pa.int64()) for n in ("part", "doc_id", "local", "n_tokens", "ids_crc32")])
    # An empty table leaves at most a file without a record.
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("content")
    docs = files.mapInArrow(
        read, "part bigint, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"
    )
    sums = files.select(_head(0).alias("part"), _head(2).alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    bases = sums.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")
    )
    return docs.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_shards(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    folder: str | None = None,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Write all texts as shards and describe every document as read back from them.

    Documents are in ascending order of their identifier (null first), rows with the same
    identifier in the order of their text. Identifiers are whole numbers; others fail the
    cast. A null text counts as empty: its document is the end id alone. An empty table
    leaves no shard and gives no rows. Other columns are left out.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-shards")
    write_shards(docs, folder, doc_id, text, tokenizer, end_id, shard_ids)
    return read_shards(spark, folder)


def op3_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(table(spark, sf_dir, "documents"))
