import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from marquee.llm import substring_dedup as S
from marquee.llm.bwt import repeated_starts


def expected(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        covered = np.zeros(len(t) + 1, int)
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                covered[i] += 1
                covered[i + width] -= 1
        gone = np.cumsum(covered)[: len(t)] > 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(frame):
    rows = frame.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    return sorted(map(tuple, rows), key=repr)


def test_odd_rows(make_docs, odd_rows):
    assert got(S.substring_dedup(make_docs(*odd_rows))) == expected(odd_rows, 200)


@pytest.mark.parametrize("hot", [S.HOT, 2])
def test_against_brute_force(make_docs, hot):
    rng = random.Random(3)
    passages = ["".join(rng.choices("abcd é", k=rng.randint(30, 300))) for _ in range(8)]
    rows = []
    for i in range(120):
        parts = ["".join(rng.choices("abcdefgh ", k=rng.randint(0, 150)))]
        parts += [rng.choice(passages) for _ in range(rng.randint(0, 3))]
        parts += ["x" * rng.randint(0, 300), "yz" * rng.randint(0, 150)][: rng.randint(0, 2)]
        rows.append((i, "".join(parts)))
    rows += [(500 + i, rows[0][1]) for i in range(40)]
    docs = make_docs(*rows)
    assert got(S.substring_dedup(docs, width=100, gram=40, hot=hot)) == expected(rows, 100)


def test_empty_table(make_docs):
    assert S.substring_dedup(make_docs((1, "x")).where("false")).count() == 0


def test_transform_alone():
    rng = random.Random(4)
    for _ in range(30):
        strings = [bytes(rng.choices(b"ab", k=rng.randint(0, 40))) for _ in range(rng.randint(1, 12))]
        counts = np.array([rng.randint(1, 2) for _ in strings])
        seen = Counter()
        for s, c in zip(strings, counts):
            for i in range(len(s) - 7):
                seen[s[i : i + 8]] += int(c)
        found = repeated_starts([np.frombuffer(s, np.uint8) for s in strings], counts, 8)
        want = [[i for i in range(len(s) - 7) if seen[s[i : i + 8]] > 1] for s in strings]
        assert [f.tolist() for f in found] == want
