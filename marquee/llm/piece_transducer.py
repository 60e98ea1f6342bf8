"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model is compiled into one transducer. Its states are the last piece that was put out;
its arcs read the characters of a piece (blanks normalised to the piece mark first) and put
out the piece, or read a character that no piece holds and put out its bytes. Arc weights
live in the tropical semiring: paths add weights, the smallest sum wins, and infinity means
no arc. Composed with an input, the transducer gives a lattice over positions and last
pieces, and the shortest path through it is the encoding.

For a unigram model an arc weighs minus the piece's score. For a BPE model an arc from
piece x to piece y weighs one if merging the characters of x and y alone, best pair first,
gives x and y back, and infinity if not. Merges inside two neighbouring pieces never wait
for anything outside them, so a path of finite weight is what merging the whole text gives,
and there is exactly one. Whether two pieces may stand side by side is worked out once and
remembered.

No piece spans two characters that stand side by side in no piece, so texts are cut there
and every part is composed once per worker.

Many parts are composed at once, as arrays. For a BPE model the finite path to a place is
what merging the text before it gives, so there is one state at every place, and a place is
settled by one test of an arc for every piece that ends there (``Composer``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marquee.llm.tables import id_and_text, table
from marquee.llm.textbytes import mix, slices
from marquee.llm.tokens import PieceTable, crc32

MODEL = "piece_bpe_32k.model"
MARK = "▁"
INFINITY = float("inf")
MOST_ARCS = 1_000_000  # remembered by a task
BPE, UNIGRAM = 2, 1


class Transducer:
    """Normaliser, pieces and byte fallback of a model, compiled."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models with the identity normaliser are compiled")
        if model.trainer_spec.model_type not in (BPE, UNIGRAM):
            raise ValueError("only BPE and unigram models are compiled")
        self.bpe = model.trainer_spec.model_type == BPE
        self.prefix = rules.add_dummy_prefix
        kinds = proto.ModelProto.SentencePiece
        self.size = len(model.pieces)
        self.surface: list[bytes] = []  # what each piece decodes to
        self.pieces: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.unknown = 0
        for number, piece in enumerate(model.pieces):
            surface = b""
            if piece.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.pieces[piece.piece], self.scores[piece.piece] = number, piece.score
                surface = piece.piece.replace(MARK, " ").encode()
            elif piece.type == kinds.BYTE:
                value = int(piece.piece[3:5], 16)
                self.bytes[value], surface = number, bytes([value])
            elif piece.type == kinds.UNKNOWN:
                self.unknown = number
            self.surface.append(surface)
        self.names = {number: piece for piece, number in self.pieces.items()}
        self.longest = max(map(len, self.pieces), default=1)
        self.together = {pair for piece in self.pieces for pair in zip(piece, piece[1:], strict=False)}
        self.heads = {piece[:n] for piece in self.pieces for n in range(1, len(piece) + 1)}
        self.arcs: dict[tuple[str, str], float] = {}

    def merged(self, text: str) -> list[str]:
        """The characters of a short text merged, best score first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -INFINITY, -1
            for i in range(len(parts) - 1):
                value = self.scores.get(parts[i] + parts[i + 1], -INFINITY)
                if value > best:
                    best, at = value, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def weight(self, last: str, piece: str) -> float:
        """Of the arc from the state ``last`` (empty: the start) that puts out ``piece``."""
        known = self.arcs.get((last, piece))
        if known is not None:
            return known
        if not self.bpe:
            weight = -self.scores[piece]
        elif last and (last[-1], piece[0]) in self.together:
            weight = 1.0 if self.merged(last + piece) == [last, piece] else INFINITY
        elif last:  # no piece joins the two: as at the start
            weight = self.weight("", piece)
        else:
            weight = 1.0 if self.merged(piece) == [piece] else INFINITY
        if len(self.arcs) >= MOST_ARCS:
            self.arcs.clear()
        self.arcs[last, piece] = weight
        return weight

    def fallback(self, character: str) -> list[int]:
        ids = [self.bytes.get(b) for b in (" " if character == MARK else character).encode()]
        return [self.unknown] if None in ids else ids

    def encode(self, text: str) -> list[int]:
        """Ids of a normalised text (marks for blanks) on the shortest path."""
        n, pieces, heads, arcs = len(text), self.pieces, self.heads, self.arcs
        # For each position the states there: last piece -> (weight so far, way back).
        states: list[dict[str, tuple[float, tuple | None]]] = [{} for _ in range(n + 1)]
        states[0][""] = (0.0, None)
        for i in range(n):
            here = states[i]
            if not here:
                continue
            found = text[i] in pieces
            for j in range(i + 1, min(n, i + self.longest) + 1):
                piece = text[i:j]
                if piece not in heads:
                    break
                if piece not in pieces:
                    continue
                there = states[j]
                for last, (so_far, _) in here.items():
                    weight = arcs.get((last, piece))
                    total = so_far + (self.weight(last, piece) if weight is None else weight)
                    if total < INFINITY and (piece not in there or total < there[piece][0]):
                        there[piece] = (total, (i, last))
            if not found:  # no piece holds this character: its bytes
                last = min(here, key=lambda k: here[k][0])
                cost = here[last][0] + (10.0 if not self.bpe else 1.0)
                key = text[i]
                if key not in states[i + 1] or cost < states[i + 1][key][0]:
                    states[i + 1][key] = (cost, (i, last))
        if not states[n]:
            raise AssertionError(f"no path through {text[:40]!r}")
        i, piece = n, min(states[n], key=lambda k: states[n][k][0])
        parts = []
        while i:
            parts.append(piece)
            i, piece = states[i][piece][1]
        ids: list[int] = []
        for part in reversed(parts):
            number = self.pieces.get(part)
            ids += [number] if number is not None else self.fallback(part)
        return ids

    def decode(self, ids: list[int]) -> str:
        text = b"".join(self.surface[i] for i in ids).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


class Composer:
    """A BPE transducer as tables of integers, composed with many parts side by side."""

    DENSE = 128  # symbols with a column of their own in the table of arcs between heads
    MEMORY = 1 << 21  # arcs remembered
    LONG = 64  # characters; longer parts are composed one by one

    def __init__(self, transducer: Transducer):
        self.transducer = transducer
        names = transducer.pieces
        count: dict[str, int] = {}
        for piece in names:
            for c in piece:
                count[c] = count.get(c, 0) + 1
        # A character that is in pieces but no piece itself could be reached in two ways.
        self.able = transducer.bpe and set(count) <= set(names) and len(count) < 1 << 13
        if not self.able:
            return
        alphabet = sorted(count, key=lambda c: (-count[c], c))
        self.symbol = {c: i for i, c in enumerate(alphabet)}
        order = np.argsort([ord(c) for c in alphabet])
        self.codes = np.array([ord(c) for c in alphabet], np.int64)[order]
        self.symbols = order.astype(np.int32)
        heads = {"": 0}
        for piece in names:
            for n in range(1, len(piece) + 1):
                heads.setdefault(piece[:n], len(heads))
        self.dense = np.full((len(heads), self.DENSE), -1, np.int32)
        rare: dict[int, int] = {}
        for head, number in heads.items():
            if head:
                above, symbol = heads[head[:-1]], self.symbol[head[-1]]
                if symbol < self.DENSE:
                    self.dense[above, symbol] = number
                else:
                    rare[above << 13 | symbol] = number
        self.rare_keys = np.array(sorted(rare), np.int64)
        self.rare = np.array([rare[k] for k in self.rare_keys.tolist()], np.int32)
        self.piece_of = np.full(len(heads), -1, np.int32)  # the piece a head is, if it is one
        for piece, number in names.items():
            self.piece_of[heads[piece]] = number
        size = transducer.size
        self.first, self.last = np.zeros(size, np.int32), np.zeros(size, np.int32)
        for piece, number in names.items():
            self.first[number], self.last[number] = self.symbol[piece[0]], self.symbol[piece[-1]]
        self.beside = np.zeros((len(alphabet), len(alphabet)), bool)
        for a, b in transducer.together:
            self.beside[self.symbol[a], self.symbol[b]] = True
        self.alone = np.zeros(size, bool)  # pieces that merging their own characters gives
        for piece, number in names.items():
            self.alone[number] = transducer.weight("", piece) < INFINITY
        self.keys = np.full(self.MEMORY, -1, np.int64)
        self.known = np.zeros(self.MEMORY, bool)

    def _arcs(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether there is an arc from each state to each piece; state -1 is the start."""
        good = self.alone[piece]
        ask = np.flatnonzero(good & (last >= 0) & self.beside[self.last[last], self.first[piece]])
        if not len(ask):
            return good
        keys = last[ask].astype(np.int64) << 20 | piece[ask]
        slots = (mix(keys.astype(np.uint64)) & np.uint64(self.MEMORY - 1)).astype(np.int64)
        good[ask] = self.known[slots]
        missed = np.flatnonzero(self.keys[slots] != keys)
        if len(missed):
            new, back = np.unique(keys[missed], return_inverse=True)
            name, weight = self.transducer.names, self.transducer.weight
            fits = np.array([weight(name[k >> 20], name[k & 0xFFFFF]) < INFINITY for k in new.tolist()])
            good[ask[missed]] = fits[back]
            into = slots[missed]
            self.keys[into], self.known[into] = keys[missed], fits[back]
            # Two new arcs may want one place; it holds the key and the answer of the last.
        return good

    def _children(self, heads: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        found = self.dense[heads, np.minimum(symbols, self.DENSE - 1)]
        rare = np.flatnonzero(symbols >= self.DENSE)
        if len(rare):
            keys = heads[rare].astype(np.int64) << 13 | symbols[rare]
            at = np.minimum(np.searchsorted(self.rare_keys, keys), max(len(self.rare_keys) - 1, 0))
            hit = self.rare_keys[at] == keys if len(self.rare_keys) else np.zeros(len(keys), bool)
            found[rare] = np.where(hit, self.rare[at] if len(self.rare) else -1, -1)
        return found

    def symbols_of(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of characters, -1 for those no piece holds."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.symbols[at], -1)

    def compose(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, one after the other, and how many each part has. ``symbols`` are
        their characters, ``ends`` the places (from 0) where parts begin and end."""
        n, sizes = len(symbols), np.diff(ends)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        stop = ends[1:][owner]
        # Every piece that matches somewhere: where it begins and ends, and which it is.
        at, heads = np.arange(n), np.zeros(n, np.int32)
        begins, finishes, found = [], [], []
        for length in range(1, self.transducer.longest + 1):
            heads = self._children(heads, symbols[at + length - 1])
            live = heads >= 0
            at, heads = at[live], heads[live]
            pieces = self.piece_of[heads]
            whole = pieces >= 0
            begins.append(at[whole])
            finishes.append(at[whole] + length)
            found.append(pieces[whole])
            more = at + length < stop[at]
            at, heads = at[more], heads[more]
            if not len(at):
                break
        begin, finish, piece = (np.concatenate(x) for x in (begins, finishes, found))
        # Place by place, all parts at once.
        offset = begin - ends[:-1][owner[begin]]
        order = np.argsort(offset, kind="stable")
        begin, finish, piece = begin[order], finish[order], piece[order]
        borders = np.searchsorted(offset[order], np.arange(int(sizes.max(initial=0)) + 1))
        state = np.full(n + 1, -1, np.int32)  # of the part that ends there
        way = np.zeros(n + 1, np.int32)  # how long the last piece before a place is
        inner = np.full(n + 1, -1, np.int32)  # the same state, for the part that goes on there
        for i, j in zip(borders[:-1].tolist(), borders[1:].tolist()):
            b, f, p = begin[i:j], finish[i:j], piece[i:j]
            good = self._arcs(inner[b], p)
            b, f, p = b[good], f[good], p[good]
            state[f], way[f] = p, f - b
            inside = f < stop[b]
            inner[f[inside]] = p[inside]
        # The ways back, all parts at once.
        now, parts = ends[1:].copy(), np.arange(len(sizes))
        steps = []
        while len(parts):
            if (state[now] < 0).any():
                raise AssertionError("no path through a part")
            steps.append((parts, state[now]))
            now = now - way[now]
            more = now > ends[:-1][parts]
            now, parts = now[more], parts[more]
        who = np.concatenate([p for p, _ in steps]) if steps else np.zeros(0, np.int64)
        ids = np.concatenate([i for _, i in steps]) if steps else np.zeros(0, np.int32)
        back = np.concatenate([np.full(len(p), k) for k, (p, _) in enumerate(steps)]) if steps else who
        order = np.lexsort((-back, who))
        return ids[order].astype(np.uint32), np.bincount(who, minlength=len(sizes))


class PieceEncoder(PieceTable):
    """Composes parts of texts with the transducer; made once per worker. Texts come with the
    blank of the model's prefix in front."""

    def __init__(self, transducer: Transducer):
        self.transducer = transducer
        # ASCII characters that stand side by side in no piece.
        self.apart = np.zeros((256, 256), bool)
        together = {(" " if a == MARK else a, " " if b == MARK else b) for a, b in transducer.together}
        for a in range(128):
            for b in range(128):
                self.apart[a, b] = (chr(a), chr(b)) not in together
        surfaces = [np.frombuffer(s, np.uint8) for s in transducer.surface]
        self.lengths = np.array([len(s) for s in surfaces])
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths)))
        self.letters = np.concatenate(surfaces)
        self.fallback = np.zeros(transducer.size, bool)
        self.fallback[list(transducer.bytes.values())] = True
        self.composer = Composer(transducer)
        super().__init__(np.uint16 if transducer.size <= 1 << 16 else np.uint32)

    def cuts(self, ends: np.ndarray, data: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = self.apart[data[:-1], data[1:]]
        # Behind a character of several bytes too, where a word begins.
        cut[1:-1] |= (data[:-1] >= 0x80) & (data[1:] == 0x20) & (data[:-1] != 0x81)
        return cut

    def _new(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        firsts, counts = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int32)
        one_by_one = np.ones(len(starts), bool)
        if self.composer.able:
            sizes = stops - starts
            places = np.cumsum(sizes)
            raw = data[np.repeat(starts - (places - sizes), sizes) + np.arange(places[-1])]
            begins = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            ends = begins[np.concatenate(([0], places))]
            codes = np.frombuffer(raw.tobytes().decode("utf-8").replace(" ", MARK).encode("utf-32-le"), "<u4")
            symbols = self.composer.symbols_of(codes.astype(np.int64))
            strange = np.concatenate(([0], np.cumsum(symbols < 0)))
            one_by_one = (strange[ends[1:]] > strange[ends[:-1]]) | (np.diff(ends) > self.composer.LONG)
            at = np.flatnonzero(~one_by_one)
            if len(at):
                own = np.repeat(~one_by_one, np.diff(ends))
                ids, n = self.composer.compose(symbols[own], np.concatenate(([0], np.cumsum(np.diff(ends)[at]))))
                counts[at] = n
                firsts[at] = self._store(ids) + np.cumsum(n) - n
        raw = data.tobytes() if one_by_one.any() else b""
        for i in np.flatnonzero(one_by_one).tolist():
            ids = self.transducer.encode(raw[starts[i] : stops[i]].decode("utf-8").replace(" ", MARK))
            counts[i] = len(ids)
            firsts[i] = self._store(np.array(ids, np.uint32))
        return firsts, counts

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, one piece after the other."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        return self.letters[np.repeat(self.offsets[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> PieceEncoder:
    """The compiled transducer of this worker, with the parts and arcs that tasks before have
    met."""
    return PieceEncoder(Transducer(path))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def encode_and_decode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str | None = None, ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_pieces, n_bytes (pieces of the byte fallback),
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers), round_trip (decoding
    gives the text back) and, if asked, ids.

    A null text counts as empty; an empty text has no pieces. A text that holds the piece
    mark itself decodes to blanks there and does not come back. Repeated rows are encoded
    one by one.
    """
    path = model or default_path()
    rows = id_and_text(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            for first, ends, data in slices(batch.column(1)):
                rows = len(ends) - 1
                full = np.diff(ends) > 0
                if encoder.transducer.prefix:
                    data = np.insert(data, ends[:-1][full], 0x20)
                    ends = ends + np.concatenate(([0], np.cumsum(full)))
                found, places = encoder.encode(ends, data)
                texts = [found[s:e] for s, e in zip(places, places[1:], strict=False)]
                columns = [
                    batch.column(0).slice(first, rows),
                    pa.array(np.diff(places)),
                    pa.array([int(encoder.fallback[t].sum()) for t in texts], pa.int64()),
                    pa.array([crc32(t) for t in texts], pa.int64()),
                    pa.array([np.array_equal(encoder.decoded(t), data[s:e]) for t, s, e in zip(texts, ends, ends[1:], strict=False)]),
                ]
                if ids:
                    columns.append(pa.array([t.astype(np.int32) for t in texts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "round_trip"] + ["ids"] * ids
    schema = f"doc_id {kind}, n_pieces bigint, n_bytes bigint, ids_crc32 bigint, round_trip boolean"
    return rows.mapInArrow(run, schema + ", ids array<int>" * ids)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(table(spark, sf_dir, "documents"))
