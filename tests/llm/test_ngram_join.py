import random
import re

import pytest

from marquee.llm import ngram_join as N


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def variants(seed=5):
    """Families of near copies around the limit, shared passages, short texts, copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for family in range(12):
        base = rng.choices(vocabulary, k=rng.choice([4, 6, 30, 120, 300]))
        for _ in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                words += passage
            rows.append((len(rows) * 3 % 1000, (" " if rng.random() < 0.5 else "\n").join(words).upper()))
    for i in range(25):
        rows.append((2000 + i, " ".join(passage + rng.choices(vocabulary, k=40))))
    rows += [(3000 + i, rows[0][1]) for i in range(20)]
    return rows


def test_odd_rows(make_docs, odd_rows):
    assert got(N.near_duplicates(make_docs(*odd_rows))) == expected(odd_rows)


@pytest.mark.parametrize("seed", [5, 6])
def test_against_brute_force(make_docs, seed):
    rows = variants(seed)
    assert got(N.near_duplicates(make_docs(*rows))) == expected(rows)


def test_small_blocks(make_docs, monkeypatch):
    """Families dealt into many blocks give the same components."""
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 150)
    rows = variants(7)
    assert got(N.near_duplicates(make_docs(*rows))) == expected(rows)


def test_chain_is_one_component(make_docs):
    words = [f"v{i}" for i in range(200)]
    rows = [(i, " ".join(words[i * 8 : i * 8 + 80])) for i in range(15)]
    found = {r.component_id for r in N.near_duplicates(make_docs(*rows)).collect()}
    assert found == {e[2] for e in expected(rows)} == {0}


def test_many_near_copies_in_one_slice(make_docs):
    """Every common shingle of the first copy is held in its own slice alone."""
    words = [f"v{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    rows += [(i, " ".join([*words[: 4 * i], "other", *words[4 * i + 1 :]])) for i in range(1, 30)]
    assert got(N.near_duplicates(make_docs(*rows).orderBy("doc_id").coalesce(1))) == expected(rows)
    assert {e[2] for e in expected(rows)} == {0}


def test_null_identifier_is_a_near_copy_and_a_bridge(make_docs):
    words = [f"v{i}" for i in range(400)]
    rows = [(1, " ".join(words[:80])), (None, " ".join(words[8:88])), (2, " ".join(words[16:96]))]
    rows += [(3, " ".join(words[200:280])), *[(None, " ".join(words[202:282]))] * 3]
    rows += [(None, " ".join(words[300:360])), (None, " ".join(words[301:361]))]
    assert got(N.near_duplicates(make_docs(*rows))) == expected(rows)
    assert (2, 76, 1) in expected(rows) and (None, 76, 3) in expected(rows) and (None, 56, None) in expected(rows)


def test_empty_table(make_docs):
    assert N.near_duplicates(make_docs((1, "x")).where("false")).count() == 0


def test_chance_phrases_tie_nothing(make_docs, monkeypatch):
    """Texts that share a fifth of their shingles, a phrase with each neighbour, come no
    further: else chance ties the whole of a large corpus into one family."""
    rows, own = [], iter(range(10**6))
    for i in range(40):
        phrases = [f"p{i}x{k}" for k in range(10)] + [f"p{i + 1}x{k}" for k in range(10)]
        rows.append((i, " ".join([f"own{next(own)}" for _ in range(40)] + phrases)))
    rows += [(100 + i, rows[i][1] + " end") for i in range(3)]
    tied = []

    def counted(edges):
        tied.append(edges.count())
        return connected(edges)

    connected = N.connected
    monkeypatch.setattr(N, "connected", counted)
    assert got(N.near_duplicates(make_docs(*rows))) == expected(rows)
    assert tied == [3, 3]


def test_blocks_of_a_family_are_those_of_its_sizes(spark, monkeypatch):
    """A set goes to the blocks of its band and of the bands beside it, not to those that the
    whole family would fill; sets that can link meet."""
    rows = [(1, size * 100 + i, n, b"") for size, n in enumerate(range(10, 2000, 30)) for i in range(20)]
    rows += [(2, -n, n, b"") for n in (48, 64, 2000)]
    placed = spark.createDataFrame(rows, "family bigint, a bigint, n bigint, own binary")
    monkeypatch.setattr(N, "BLOCK_SHINGLES", 10_000)
    paired = N._paired(placed, N.SIMILARITY).collect()
    met = {}
    for r in paired:
        met.setdefault((r.family, r.pair), set()).add(r.a)
    together = {(x, y) for sets in met.values() for x in sets for y in sets}
    assert all((a, b) in together for f, a, n, _ in rows for g, b, m, _ in rows if f == g and 4 * min(n, m) >= 3 * max(n, m))
    assert met[2, ""] == {-48, -64, -2000}
    # The family fills 134 blocks: some 400 pairs for every set.
    assert len(paired) < 100 * len(rows)
