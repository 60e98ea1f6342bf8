import random
import zlib

import numpy as np
import pytest

from marquee.llm.packing import _Packer, combinations, pack, plan_windows, repeat_counts
from marquee.llm.tokens import Encoder, default_path


def check(rows, ids_of, window):
    """Every id in one piece, no gap in a sequence, padding only where allowed: nowhere."""
    pieces = {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (doc_id, tokens), found in pieces.items():
        texts = ids_of[doc_id]
        for ids in [t for t in texts if len(t) == tokens]:
            for start, length, crc in {(r.start, r.length, r.ids_crc32) for r in found if len(texts) == 1}:
                assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4"))
        same = sum(len(t) == tokens for t in texts)
        assert sum(r.length for r in found) == same * tokens
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place and length > 0
            place += length
        assert place == window or place < window and place & (place - 1) == 0


@pytest.mark.parametrize("window", [64, 2048])
def test_odd_rows(make_docs, odd_rows, window):
    encoder = Encoder(default_path()).tokenizer
    ids_of = {}
    for doc_id, text in odd_rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids
        ids_of.setdefault(doc_id, []).append([*ids, 1])
    rows = pack(make_docs(*odd_rows), window=window).collect()
    assert sum(r.length for r in rows) == sum(len(t) for ts in ids_of.values() for t in ts)
    check(rows, ids_of, window)


def test_texts_come_back_from_the_pieces(make_docs, odd_rows):
    library = Encoder(default_path()).tokenizer
    docs = [(i, t) for i, (_, t) in enumerate(odd_rows)] + [(50, "a b <|endoftext|> c")]
    rows = pack(make_docs(*docs), window=64).collect()
    assert all(r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) for r in rows)
    for doc_id, text in docs:
        pieces = sorted((r.start, r.ids) for r in rows if r.doc_id == doc_id)
        ids = [i for _, piece in pieces for i in piece]
        assert ids == [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_empty_table(make_docs):
    assert pack(make_docs((1, "x")).where("false")).count() == 0


def test_plan_fills_windows_and_cuts_few():
    rng = random.Random(2)
    lengths = [rng.randint(1, 99) for _ in range(3000)]
    windows, rest = plan_windows(lengths, 100)
    assert all(sum(lengths[n] for n in w) == 100 for w in windows)
    assert sorted([n for w in windows for n in w] + rest) == list(range(3000))
    assert len(rest) < 600


def test_least_squares():
    histogram = np.zeros(10)
    histogram[[3, 7, 5]] = 40, 40, 20
    lengths, uses = combinations(histogram, 10)
    x = repeat_counts(histogram, lengths, uses)
    solved = {tuple(sorted(a for a, u in zip(c, n) for _ in range(int(u)))): v for c, n, v in zip(lengths, uses, x)}
    assert (x >= 0).all() and solved[3, 7] == pytest.approx(40, abs=0.5) and solved[5, 5] == pytest.approx(10, abs=0.5)


def test_blocks_hand_on_what_fills_no_window():
    packer, rng = _Packer(1, 50), random.Random(4)
    docs = [(np.arange(rng.randint(1, 140), dtype=np.uint16), (i, 0)) for i in range(200)]
    for i in range(0, 200, 7):
        packer.add(docs[i : i + 7])
        assert sum(n for n, *_ in packer.left) < 50
    packer.finish()
    assert sum(r[2] for r in packer.rows) == sum(len(d[0]) for d in docs)
