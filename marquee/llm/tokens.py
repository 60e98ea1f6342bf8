"""Token ids of whole texts with a public byte-level BPE tokenizer.

Such a tokenizer never joins what stands before a blank with what follows it, if a visible
character comes next, nor a letter with a full stop after it, nor a line end with what
stands around it: texts are cut there. The ids of a piece are the same wherever it
stands, so every piece that is new to a worker is encoded once, by the tokenizers library,
and remembered in a table of fixed size by its hash; a text's ids are put together from
there. Added tokens that stand in a text, such as ``<|endoftext|>``, get their own id, as
the library gives them; no text is cut in them or right before the white space they follow.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from marquee.llm.textbytes import prefix, slices, span_hashes

VOCABULARY = "byte_bpe_50k.json"
SLOTS = 1 << 21
POOL = 16 << 20  # ids remembered at most
LONGEST = 256  # bytes of a piece that is remembered
AT_ONCE = 1 << 19  # bytes of text encoded at once, beyond whole texts
TOGETHER = 256  # pieces encoded as one string

# Bytes that surely are or begin a visible character (_VISIBLE), and bytes that surely
# belong to no white space (_PLAIN).
_ASCII = np.zeros(256, bool)
_ASCII[0x21:0x7F] = True
_VISIBLE = _ASCII.copy()
_VISIBLE[0xC3:] = True
_VISIBLE[0xE1:0xE4] = False
_PLAIN = _VISIBLE.copy()
_PLAIN[0x80:0xC0] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_POINT = np.zeros(256, bool)
_POINT[list(b".,;:!?()")] = True


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class PieceTable:
    """Ids of pieces of text, remembered by hash; subclasses say where texts may be cut and
    give the ids of pieces not met before. Made once per worker."""

    def __init__(self, kind: type = np.uint16):
        self.kind = kind
        self.clear()

    def cuts(self, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
        """For every byte (and one more) whether a piece may begin there."""
        raise NotImplementedError

    def _new(
        self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Places in the pool and numbers of ids of pieces not met before."""
        raise NotImplementedError

    def clear(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.firsts = np.zeros(SLOTS, np.int32)
        self.counts = np.zeros(SLOTS, np.int16)
        self.sizes = np.zeros(SLOTS, np.int16)  # 0: nothing here
        self.pool = np.zeros(1 << 16, self.kind)
        self.used = 0

    def _store(self, ids: np.ndarray) -> int:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def encode(self, ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the place of each text's first id (one more at the end)."""
        if self.used > POOL:
            self.clear()
        cut = self.cuts(ends, data)
        # The last blank of a text and the first character of the next are no neighbours.
        cut[np.maximum(ends - 1, 0)] = False
        cut[ends] = True
        cut[len(data)] = False
        ones = ends[1:][(np.diff(ends) == 1)] - 1  # texts of one byte begin at their last
        cut[ones] = True
        starts = np.flatnonzero(cut)
        stops = np.append(starts[1:], len(data))[: len(starts)]
        hashes = span_hashes(prefix(data), starts, stops, data)
        sizes = stops - starts
        slots = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        other = (hashes >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)
        hit = (self.keys[slots] == hashes) & (self.sizes[slots] == sizes)
        second = ~hit & (self.keys[other] == hashes) & (self.sizes[other] == sizes)
        places = np.where(second, other, slots)
        firsts, counts = self.firsts[places], self.counts[places].astype(np.int32)
        missed = np.flatnonzero(~(hit | second))
        if len(missed):
            _, one, back = np.unique(hashes[missed], return_index=True, return_inverse=True)
            at = missed[one]
            new_firsts, new_counts = self._new(data, starts[at], stops[at])
            firsts[missed], counts[missed] = new_firsts[back], new_counts[back]
            keep = sizes[at] <= LONGEST
            at, new_firsts, new_counts = at[keep], new_firsts[keep], new_counts[keep]
            into = np.where(self.sizes[slots[at]] == 0, slots[at], other[at])
            # Two new pieces may want one place; all four arrays then hold the last of them.
            self.keys[into], self.sizes[into] = hashes[at], sizes[at]
            self.firsts[into], self.counts[into] = new_firsts, new_counts
        places = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(counts, out=places[1:])
        ids = self.pool[np.repeat(firsts - places[:-1], counts) + np.arange(places[-1])]
        return ids, places[np.searchsorted(starts, ends)]


class Encoder(PieceTable):
    """Encodes slices of text bytes with a byte-level BPE of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.blank_first = np.zeros(max(vocabulary.values()) + 1, bool)
        self.blank_first[[i for t, i in vocabulary.items() if t[0] == "Ġ"]] = True
        super().__init__(np.uint16 if len(self.blank_first) <= 1 << 16 else np.uint32)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(
        self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        # Bytes before each place that may be or begin white space other than a blank.
        odd = np.zeros(len(data) + 1, np.int32)
        np.cumsum(~_PLAIN[data], out=odd[1:])
        firsts, counts = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int32)
        # Pieces of one blank and visible characters can be encoded in one string: each
        # begins with the only id in it that starts with a blank.
        plain = (data[starts] == 0x20) & (odd[stops] == odd[starts + 1])
        joined = np.flatnonzero(plain)
        if len(joined):
            sizes = stops[joined] - starts[joined]
            ends = np.cumsum(sizes)
            raw = data[np.repeat(starts[joined] - (ends - sizes), sizes) + np.arange(ends[-1])].tobytes()
            cuts = [0, *ends[TOGETHER - 1 :: TOGETHER].tolist(), int(ends[-1])]
            texts = [raw[i:j].decode("utf-8") for i, j in zip(cuts, cuts[1:]) if i < j]
            ids = np.concatenate([np.array(x, np.uint32) for x in self._ids(texts)])
            at = np.flatnonzero(self.blank_first[ids])
            if len(at) != len(joined):
                raise AssertionError("a piece was not cut where it begins")
            firsts[joined] = self._store(ids) + at
            counts[joined] = np.diff(np.append(at, len(ids)))
        rest = np.flatnonzero(~plain)
        texts = [data[starts[i] : stops[i]].tobytes().decode("utf-8") for i in rest]
        for i, ids in zip(rest, self._ids(texts), strict=True):
            counts[i] = len(ids)
            firsts[i] = self._store(np.array(ids, np.uint32))
        return firsts, counts

    def cuts(self, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(data) + 1, bool)
        before, here = data[:-1], data[1:]
        cut[1:-1] |= (_LETTER[before] & _POINT[here]) | (_ASCII[before] & (here == 0x0A))
        line = (before == 0x0A) & _VISIBLE[here]  # a piece of its own
        cut[1:-1] |= line
        cut[:-2] |= line | ((before == 0x20) & _VISIBLE[here])
        # The library takes added tokens out first. A mark is never cut, and white space
        # before it ends a text of its own: the last of it goes with the rest.
        raw = data.tobytes() if self.marks else b""
        for mark in self.marks:
            at = raw.find(mark)
            while at >= 0:
                cut[max(at - 1, 0) : at + len(mark)] = False
                at = raw.find(mark, at + 1)
        return cut


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of this worker: a task finds the pieces that tasks before it have met.
    It remembers as much as one of a single task, and gives the same ids."""
    return Encoder(path)


def crc32(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def encoded(column: pa.Array, encoder: Encoder) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, ids and places of ids for each slice of a string column without nulls."""
    for first, ends, data in slices(column, AT_ONCE):
        yield first, *encoder.encode(ends, data)
