import random
import zlib

import numpy as np
import pytest
import sentencepiece

from marquee.llm.piece_transducer import Transducer, default_path, encode_and_decode


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=default_path())


@pytest.fixture(scope="module")
def texts(odd_rows):
    rng = random.Random(3)
    parts = list("    \n\t\r'.,;-_#$sabctehi13AéüßñÇ日本𝔘▁ ½²\x00") + ["the", "ing", "  ", "http://", "École"]
    return [t for _, t in odd_rows] + ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(1500)]


def test_equals_the_library(make_docs, library, texts):
    rows = encode_and_decode(make_docs(*enumerate(texts)), ids=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        ids = library.encode(text)
        assert r.ids == ids
        assert r.n_pieces == len(ids) and r.n_bytes == sum(library.is_byte(i) for i in ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4"))
        assert r.round_trip == ("▁" not in text)


def test_decoding(library):
    transducer = Transducer(default_path())
    for text in ("a  b", " x", "日本 𝔘\n", ""):
        ids = transducer.encode(("▁" + text.replace(" ", "▁")) if text else "")
        assert transducer.decode(ids) == text == library.decode(ids)


def test_unigram_weights_are_added():
    """Without the BPE constraint the smallest sum of weights wins."""
    transducer = Transducer(default_path())
    transducer.bpe = False
    transducer.pieces = {"a": 5, "b": 6, "ab": 7, "abb": 8, "bb": 9}
    transducer.scores = {"a": -1.0, "b": -1.0, "ab": -4.0, "abb": -2.5, "bb": -3.0}
    transducer.heads, transducer.arcs = {p[:n] for p in transducer.pieces for n in (1, 2, 3)}, {}
    assert transducer.encode("abb") == [8]
    assert transducer.encode("ab") == [5, 6]


def test_empty_table(make_docs):
    assert encode_and_decode(make_docs((1, "x")).where("false")).count() == 0
