import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from marquee.llm.conversation_repair import BLANK, CLEAN, CUT, DROP, INITIALS, NOTHING, REPEATED, advanced, damaged, op12_conversation_repair, repair, repaired_turns, solve

WHOLE = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, part string, symbols string, audit string"


def cheapest(rows):
    """Cost, audit and repaired rows by search over all edits; ``rows``: role, text, fault."""
    todo, seen = [(0, "", 0, "", ())], set()
    while todo:
        cost, audit, at, made, out = heapq.heappop(todo)
        if at == len(rows) and WHOLE.fullmatch(made):
            return cost, audit, out
        # All that matters of what was made: nothing, or which initial comes last.
        if (at, made[-1:]) in seen:
            continue
        seen.add((at, made[-1:]))
        steps = [(3, "I", at, r, "") for r in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            steps.append((4, "D", at + 1, None, None))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                steps += [(3 + more, "R", at + 1, r, text) for r in ("user", "assistant")]
                steps.append((more, "K", at + 1, role, text))
        for more, edit, then, role, text in steps:
            grown = made + ("" if role is None else role[:1] or "?")
            if WHOLE.fullmatch(grown) or WHOLE.fullmatch(grown + "a") or WHOLE.fullmatch(grown + "ua"):
                heapq.heappush(todo, (cost + more, audit + edit, then, grown, out if role is None else (*out, (role, text))))
    raise AssertionError


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def plain(table, damage=False):
    """conv_id to report, by hand; ``table``: conv_id, turn, role, text in any order."""
    out = {}
    blank = lambda x: " " if x is None else x
    for conv, turn, role, text in table:
        rows, role, text = out.setdefault(conv, []), blank(role), blank(text)
        fate = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20 if damage else 9
        if fate == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        rows += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    for conv, rows in out.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        marked = faults([r[1:] for r in rows])
        cost, audit, made = cheapest(marked)
        turns = [r[0] for r in rows if r[0] is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        )
    return out


def got(df):
    rows = df.collect()
    found = {r.conv_id: tuple(r[c] for c in NOTHING) for r in rows}
    assert len(found) == len(rows)
    return found


def as_symbols(rows):
    faults = {None: CLEAN, "truncated": CUT, "duplicate": REPEATED, "blank": BLANK}
    return bytes(max(INITIALS.find(role[:1]), 0) + 4 * faults[f] if role[:1] in "sua" else 3 + 4 * faults[f] for role, _, f in rows)


def test_solve_equals_search():
    chance = random.Random(3)
    for size in (0, 1, 2, 3, 4, 5, 6, 9):
        for _ in range(120):
            rows = [(chance.choice(["user", "assistant", "system", "user", "assistant", "x"]), "", chance.choice([None, None, None, "truncated", "blank"])) for _ in range(size)]
            cost, audit, _ = cheapest(rows)
            assert solve(as_symbols(rows)) == (cost, audit)


def test_long_runs():
    for run in ("u", "a", "s", "x", "ua", "uua", "suuuaaa"):
        rows = [("user" if c == "u" else "assistant" if c == "a" else "system" if c == "s" else "x", "", None) for c in (run * 60)[:60]]
        assert solve(as_symbols(rows)) == cheapest(rows)[:2]
    # Blocks of a run change nothing: every second user row is given away, all in one run.
    cost, audit = solve(bytes([1]) * 30_000)
    assert cost == 3 * 15_000 and len(audit) == 30_000
    assert solve(bytes([DROP]) * 100_000) == (400_000, "D" * 100_000)
    assert advanced(DROP, 10**9, (0, 1, 2, 3)) == (4 * 10**9, 4 * 10**9 + 1, 4 * 10**9 + 2, 4 * 10**9 + 3)


ODD = [
    (1, 0, "system", "S."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes?"),
    (2, 5, "user", "Hi"), (2, 9, "user", " \t\x0b"), (2, 10, "assistant", "Ok.\n\n"), (2, 10, "assistant", "Ok.\n\n"),
    (3, None, None, None), (3, None, "user", "x."), (4, 0, "", "empty role."), (4, 3, "tool", "t!"), (4, 4, "user", "日本 🙂\xa0"),
    (None, 1, "user", "null id."), (None, 2, "assistant", "null id."), (5, 0, "assistant", "a."), (6, 0, "user", "long. " * 200_000),
    (6, 1, "assistant", "w " * 100_000), (7, -3, "user", "u."), (7, 4, "user", "u."), (7, 8, "user", "u."), (8, 0, "uncle", "kept."), (8, 1, "aunt", "kept."),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "o", "o", "o") for r in rows], SCHEMA).repartition(3)


def test_odd_rows(spark):
    assert got(repair(frame(spark, ODD))) == plain(ODD)


def test_empty_table(spark):
    assert repair(frame(spark, ODD).where("false")).count() == 0
    assert repaired_turns(frame(spark, ODD).where("false")).count() == 0


def test_damage(spark):
    rows = [(c, t, chance, f"text {c} {t}. No?") for c in range(60) for t, chance in enumerate(["system", "user", "assistant", "user", "assistant"] * 2)]
    rows += [(None, None, None, None), (None, 3, "user", "y."), (61, None, "user", "z.")]
    live = [r for r in plain(rows, damage=True).items() if r[1] != tuple(NOTHING.values())]
    assert got(repair(damaged(frame(spark, rows)))) == dict(live)


def test_query_equals_plain(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op12_conversation_repair(spark, sf_dir)) == plain(rows, damage=True)


def test_query_keeps_conversations_without_rows(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows = [(gone, 1, "user", "u."), (None, 7, "user", "u.")]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op12_conversation_repair(spark, str(tmp_path))) == plain(rows, damage=True)


@pytest.mark.parametrize("share", [3, 1])
def test_one_conversation_in_many_tasks(spark, share):
    """A third of all rows, then all of them, are one conversation: its parts lie in several
    tasks and are put together in order."""
    roles = ["user", "assistant", "assistant", "system", "user"]
    rows = [(0 if i % share == 0 else i, i // 2, roles[i * i % 5], f"t{i % 700}" + ".?! "[i % 4]) for i in range(2_500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = got(repair(frame(spark, rows)))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # Equal turns go by role, then by a hash of the text; this table repeats a turn in one conversation only with share 1.
    if share == 3:
        assert found == plain(rows)
    else:
        assert found[0][0] == 0 and set(found) == {0}


def test_repaired_turns_are_whole(spark):
    rows = frame(spark, ODD)
    turns = {}
    for r in sorted(repaired_turns(rows).collect(), key=lambda r: (str(r.conv_id), r.place)):
        turns.setdefault(r.conv_id, []).append(r)
    for conv, report in got(repair(rows)).items():
        own = turns.get(conv, [])
        assert "".join(r.edit for r in own) == report[6]
        kept = [r for r in own if r.edit != "D"]
        assert all(r.role is None and r.text is None for r in own if r.edit == "D")
        assert WHOLE.fullmatch("".join(r.role[0] for r in kept)) and all(r.text == "" for r in kept if r.edit == "I")
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == report[7]
