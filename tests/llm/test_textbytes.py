import numpy as np
import pytest

from marquee.llm.shingles import sets_of
from marquee.llm.textbytes import prefix, span_hashes
import pyarrow as pa


def two_of_a_kind(n, letters="ab"):
    """A string of n letters in which every letter is that of its place's number of ones,
    and the same with the letters exchanged: equal under any polynomial modulo 2 to the 64
    with an odd base, if n is large."""
    first = "".join(letters[i.bit_count() & 1] for i in range(n))
    return first, first.translate(str.maketrans(letters, letters[::-1]))


SIZES = (64, 128, 256, 512, 1024, 2048, 4096)


@pytest.mark.parametrize("n", SIZES)
def test_regular_strings_are_told_apart(n):
    for letters in ("ab", "az", "xy", "01"):
        text = "".join(two_of_a_kind(n, letters)).encode()
        data = np.frombuffer(text, np.uint8)
        one, other = span_hashes(prefix(data), np.array([0, n]), np.array([n, 2 * n]), data)
        assert one != other


def test_documents_of_regular_words_share_no_shingle():
    texts = [t for n in SIZES for t in two_of_a_kind(n)]
    ((_, sets),) = sets_of(pa.array(texts))
    assert len({s.tobytes() for s in sets}) == len(texts)


def test_equal_spans_have_equal_hashes():
    word = b"w" * 700 + b"x"
    data = np.frombuffer(word + b" " + word + word[:300], np.uint8)
    starts, ends = np.array([0, 702, 0, 1403]), np.array([701, 1403, 300, 1703])
    a, b, c, d = span_hashes(prefix(data), starts, ends, data)
    assert a == b and c == d and a != c


def test_regular_texts_have_the_ids_of_the_library(make_docs):
    """Texts of one slice that a weak hash takes for each other."""
    import sentencepiece
    from tokenizers import Tokenizer

    from marquee.llm.piece_transducer import default_path as model, encode_and_decode
    from marquee.llm.tokens import Encoder, default_path, encoded

    texts = [t for n in SIZES for t in two_of_a_kind(n)]
    library = Tokenizer.from_file(default_path())
    for first, ids, places in encoded(pa.array(texts), Encoder(default_path())):
        for i in range(len(places) - 1):
            assert ids[places[i] : places[i + 1]].tolist() == library.encode(texts[first + i], add_special_tokens=False).ids
    pieces = sentencepiece.SentencePieceProcessor(model_file=model())
    for row in encode_and_decode(make_docs(*enumerate(texts)), ids=True).collect():
        assert row.ids == pieces.encode(texts[row.doc_id])
