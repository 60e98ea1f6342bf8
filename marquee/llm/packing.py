"""Packing into windows of a fixed length by non-negative least squares.

Every task encodes its documents and packs them block by block, so nothing is shuffled. A
document longer than a window gives its full windows away as they are; what is left over
of each document is packed. For a block, the histogram of these lengths is taken, shallow
combinations of lengths that fill a window exactly are enumerated (two lengths, three
lengths, several copies of one length and a filler), and the repeat counts x of the
combinations are solved from min |A x - h| with x >= 0. Rounded and held to what the
histogram has, they pack most documents uncut. The rest is packed greedily: the longest
piece that fits, and if none fits, a piece is cut to fill the window. What fills no window
waits for the next block; at the end of the task it is cut into sequences whose lengths
are powers of two, which need no padding.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from marquee.llm.tables import id_and_text, table
from marquee.llm.tokens import crc32, default_path, encoded, encoder_of

WINDOW = 2048
END_ID = 1
BLOCK_IDS = 4 << 20  # ids held by a task at once
TRIPLES = 4  # combinations of three lengths tried for each largest length
COPIES = 7  # copies of one length in a combination at most
STEPS = 200


def combinations(histogram: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths (columns of up to three) and how often each is used, of combinations that
    fill the window from lengths that occur."""
    present = np.flatnonzero(histogram)
    found: dict[tuple, None] = {}

    def have(n: np.ndarray) -> np.ndarray:
        return (n > 0) & (n < window) & (histogram[np.clip(n, 0, window - 1)] > 0)

    for a in present[have(window - present)]:
        if 2 * a <= window:
            found[(int(a), int(window - a)) if 2 * a < window else (int(a), int(a))] = None
    for i in range(0, len(present), 256):
        largest = present[i : i + 256, None]
        third = window - largest - present[None, :]
        fits = have(third) & (present[None, :] <= largest) & (third <= present[None, :])
        worth = np.where(fits, histogram[present][None, :] * histogram[np.clip(third, 0, window - 1)], 0)
        for row, best in enumerate(np.argsort(-worth, axis=1, kind="stable")[:, :TRIPLES]):
            for j in best[worth[row, best] > 0]:
                found[(int(largest[row, 0]), int(present[j]), int(third[row, j]))] = None
    for copies in range(2, COPIES + 1):
        filler = window - copies * present
        for a, f in zip(present[have(filler)], filler[have(filler)], strict=True):
            found[(*[int(a)] * copies, int(f))] = None
    lengths, uses = np.zeros((len(found), 3), np.int64), np.zeros((len(found), 3))
    for c, members in enumerate(found):
        for k, a in enumerate(dict.fromkeys(members)):
            lengths[c, k], uses[c, k] = a, members.count(a)
    return lengths, uses


def repeat_counts(histogram: np.ndarray, lengths: np.ndarray, uses: np.ndarray) -> np.ndarray:
    """Non-negative least squares by multiplicative steps, which never leave x >= 0."""
    def spread(x: np.ndarray) -> np.ndarray:
        return np.bincount(lengths.ravel(), (uses * x[:, None]).ravel(), len(histogram))

    goal = (uses * histogram[lengths]).sum(axis=1)
    x = np.full(len(lengths), 1.0)
    for _ in range(STEPS):
        x *= goal / np.maximum((uses * spread(x)[lengths]).sum(axis=1), 1e-12)
    return x


def plan_windows(pieces: list[int], window: int) -> tuple[list[list[int]], list[int]]:
    """Windows as lists of piece numbers that fill them exactly, and the pieces left."""
    histogram = np.bincount(np.array(pieces, np.int64), minlength=window).astype(float)
    lengths, uses = combinations(histogram, window)
    waiting: dict[int, list[int]] = {}
    for number in range(len(pieces) - 1, -1, -1):
        waiting.setdefault(pieces[number], []).append(number)
    windows: list[list[int]] = []
    if len(lengths):
        x = repeat_counts(histogram, lengths, uses)
        for c in np.argsort(-x, kind="stable"):
            members = [(int(a), int(u)) for a, u in zip(lengths[c], uses[c], strict=True) if u]
            times = min([int(round(x[c])), *(len(waiting[a]) // u for a, u in members)])
            for _ in range(times):
                windows.append([waiting[a].pop() for a, u in members for _ in range(u)])
    return windows, sorted(n for group in waiting.values() for n in group)


class _Packer:
    """Packs one task's documents; gives rows (doc_id, start, length, crc, doc_tokens,
    sequence_id, offset, ids)."""

    def __init__(self, part: int, window: int):
        self.sequence, self.window = part << 32, window
        self.left: list[tuple[int, int, np.ndarray, tuple]] = []
        self.rows: list[tuple] = []

    def _put(self, placed: list[tuple[np.ndarray, tuple, int]]) -> None:
        offset = 0
        for ids, (doc_id, tokens), start in placed:
            self.rows.append((doc_id, start, len(ids), crc32(ids), tokens, self.sequence, offset, ids))
            offset += len(ids)
        self.sequence += 1

    def add(self, docs: list[tuple[np.ndarray, tuple]]) -> None:
        """Pack a block of documents: ids, and (doc_id, number of ids)."""
        pieces = [(len(p[2]), *p[1:]) for p in self.left]
        pieces = [(ids, doc, start) for _, start, ids, doc in pieces]
        for ids, doc in docs:
            whole = len(ids) // self.window * self.window
            for start in range(0, whole, self.window):
                self._put([(ids[start : start + self.window], doc, start)])
            if whole < len(ids):
                pieces.append((ids[whole:], doc, whole))
        windows, rest = plan_windows([len(p[0]) for p in pieces], self.window)
        for members in windows:
            self._put([pieces[n] for n in members])
        order = [(len(pieces[n][0]), n) for n in rest]
        order.sort()
        total = sum(n for n, _ in order)
        while total >= self.window:
            total -= self.window
            room, placed = self.window, []
            while room:
                i = bisect_right(order, (room, len(pieces)))
                if i:
                    size, n = order.pop(i - 1)
                    placed.append(pieces[n])
                    room -= size
                else:
                    _, n = order.pop()
                    ids, doc, start = pieces[n]
                    placed.append((ids[:room], doc, start))
                    pieces.append((ids[room:], doc, start + room))
                    insort(order, (len(ids) - room, len(pieces) - 1))
                    room = 0
            self._put(placed)
        self.left = [(n, pieces[i][2], pieces[i][0].copy(), pieces[i][1]) for n, i in order]

    def finish(self) -> None:
        total = sum(p[0] for p in self.left)
        pieces = [(ids, doc, start) for _, start, ids, doc in reversed(self.left)]
        while total:
            room, placed = 1 << (total.bit_length() - 1), []
            total -= room
            while room:
                ids, doc, start = pieces.pop()
                placed.append((ids[:room], doc, start))
                if len(ids) > room:
                    pieces.append((ids[room:], doc, start + room))
                room -= len(placed[-1][0])
            self._put(placed)
        self.left = []


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
BATCH_IDS = 1 << 20  # ids of the pieces given out at once, beyond whole pieces


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    window: int = WINDOW,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    ids.

    ``ids`` are the token ids of the piece: the pieces of a sequence in the order of their
    offsets are the sequence, and those of a document in the order of their starts are the
    document. Every id of every document lies in one piece. A null text counts as empty: the document
    is its end id. Repeated rows are packed one by one; a null identifier is kept. Sequence
    numbers are unique, not consecutive: each task counts in a range of its own. An empty
    table gives no rows.
    """
    path = tokenizer or default_path()
    rows = id_and_text(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ", ".join(f"{c} {kind if c == 'doc_id' else 'bigint'}" for c in COLUMNS) + ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = encoder_of(path), _Packer(TaskContext.get().partitionId(), window)
        block, held, key_type = [], 0, None

        def rows_so_far() -> Iterator[pa.RecordBatch]:
            rows, packer.rows = packer.rows, []
            kinds = [key_type, *[pa.int64()] * (len(COLUMNS) - 1)]
            groups = np.cumsum([len(row[-1]) for row in rows]) // BATCH_IDS
            for part in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(groups)) + 1):
                *columns, ids = zip(*rows[part[0] : part[-1] + 1], strict=True)
                places = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = pa.array(np.concatenate(ids).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                    + [pa.ListArray.from_arrays(pa.array(places), flat)],
                    [*COLUMNS, "ids"],
                )

        for batch in batches:
            key_type, keys = batch.schema.field(0).type, batch.column(0).to_pylist()
            for first, ids, places in encoded(batch.column(1), encoder):
                for i in range(len(places) - 1):
                    own = np.append(ids[places[i] : places[i + 1]], ids.dtype.type(end_id))
                    block.append((own, (keys[first + i], len(own))))
                held += len(ids)
                if held >= BLOCK_IDS:
                    packer.add(block)
                    block, held = [], 0
                    if packer.rows:
                        yield from rows_so_far()
        packer.add(block)
        packer.finish()
        if packer.rows:
            yield from rows_so_far()

    return rows.mapInArrow(run, names)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces without their ids, which their checksums stand for."""
    return pack(table(spark, sf_dir, "documents")).select(*COLUMNS)
