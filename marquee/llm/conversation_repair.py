"""Repair of the structure of conversations by a run-length dynamic program.

A conversation is whole if the initials of its roles read ``(s?(ua)+)?``: at most one system
turn, then user and assistant in turn. Rows are kept (0), given another role (3), deleted
(4) or joined by inserted empty ones (3); blank and duplicate rows must be deleted, and a
truncated row that stays costs 3 more. Wanted is the cheapest way, and among the cheapest
the one whose edits, by their initials D, I, K, R, come first in ASCII.

What a row costs depends on its symbol alone, the role's initial and the fault. The rows of
a conversation become a string of symbols, one byte a row, and equal neighbours become runs.
A symbol is a matrix of the cheapest costs between the states of the pattern; a run of n
rows is the n-th power of that matrix in the min-plus algebra, had from the cached powers of
two. From the last run to the first they give the cost to go at every run's border; then
the choices are unrolled from the first row on, a block of rows at a time.

Three steps, none of which holds the texts of a conversation:

1. rows without their texts are told apart by digest (first occurrence or duplicate), dealt
   by ranges of (conversation, turn), so that one large conversation lies in many tasks, and
   each task writes its part of every conversation as a string of symbols;
2. parts and texts of a conversation meet in one task, parts first: symbols are solved;
3. the task then runs along the texts in order, applies one edit after the other and keeps
   nothing but the running digest. A digest of a whole conversation can only be computed in
   order, and an audit is one value of a row, so this is the one place where a conversation
   is not split; memory is a byte or two for every row of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.tables import table
from marquee.session import written

# Fixed values of the contract: what edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# States of the pattern: nothing yet, after s, after u, after a. By initial, the next state.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
ACCEPTING = (START, ASSISTANT)
# An inserted or a given role: there is one for every state.
GIVEN = [USER, USER, ASSISTANT, USER]

# A symbol: initial of the role (place in INITIALS), and fault in the bits above.
INITIALS = "sua?"
CLEAN, CUT, REPEATED, BLANK = range(4)
DROP = 255  # a row to be deleted, whatever its role

_FAR = 1 << 60
_BLOCK = 1 << 12

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def _plus(m: Matrix, v: Vector) -> Vector:
    """The matrix applied to costs to go, in the min-plus algebra."""
    return tuple(min(cost + to_go for cost, to_go in zip(row, v, strict=True)) for row in m)


def _product(a: Matrix, b: Matrix) -> Matrix:
    columns = list(zip(*b, strict=True))
    return tuple(tuple(min(min(x + y for x, y in zip(row, c, strict=True)), _FAR) for c in columns) for row in a)


def _inserting() -> Matrix:
    """Cheapest inserts from every state to every other."""
    rows = []
    for state in STATES:
        costs, at, cost = [_FAR] * 4, state, 0
        while costs[at] == _FAR:
            costs[at] = cost
            at, cost = GIVEN[at], cost + INSERT
        rows.append(tuple(costs))
    return tuple(rows)


INSERTING = _inserting()
LAST = _plus(INSERTING, tuple(0 if state in ACCEPTING else _FAR for state in STATES))


def _kept(symbol: int, state: int) -> int | None:
    """State after the row was kept, if it may be."""
    return None if symbol == DROP else NEXT.get(INITIALS[symbol & 3], {}).get(state)


def _extra(symbol: int) -> int:
    return TRUNCATED if symbol >> 2 == CUT else 0


@lru_cache(maxsize=None)
def power(symbol: int, exponent: int) -> Matrix:
    """Costs of 2 to the ``exponent`` rows of one symbol, inserts before each included."""
    if exponent:
        half = power(symbol, exponent - 1)
        return _product(half, half)
    rows = []
    for state in STATES:
        costs = [_FAR] * 4
        costs[state] = DELETE
        if symbol != DROP:
            costs[GIVEN[state]] = min(costs[GIVEN[state]], REROLE + _extra(symbol))
        if (kept := _kept(symbol, state)) is not None:
            costs[kept] = min(costs[kept], _extra(symbol))
        rows.append(tuple(costs))
    return _product(INSERTING, tuple(rows))


def advanced(symbol: int, rows: int, v: Vector) -> Vector:
    """Costs to go before a run, from those behind it."""
    exponent = 0
    while rows:
        if rows & 1:
            v = _plus(power(symbol, exponent), v)
        rows, exponent = rows >> 1, exponent + 1
    return v


def _unrolled(symbol: int, rows: int, v: Vector) -> list[Vector]:
    """Costs to go 0, 1, ... ``rows`` rows before the end of a run."""
    steps, exponent = [v], 0
    while len(steps) <= rows:
        m = power(symbol, exponent)
        steps += [_plus(m, s) for s in steps[: rows + 1 - len(steps)]]
        exponent += 1
    return steps


def _choose(symbol: int, state: int, here: Vector, behind: Vector) -> tuple[str, int]:
    """The first of D, I, K, R that is on a cheapest way, and the state it leads to."""
    given, kept, to_go = GIVEN[state], _kept(symbol, state), here[state]
    if DELETE + behind[state] == to_go:
        return "D", state
    if INSERT + here[given] == to_go:
        return "I", given
    if kept is not None and _extra(symbol) + behind[kept] == to_go:
        return "K", kept
    return "R", given


def solve(symbols: bytes) -> tuple[int, str]:
    """Cheapest cost and first of the cheapest audits of rows with these symbols."""
    needed = bytes(DROP if s >> 2 >= REPEATED else s for s in symbols)
    runs = [(symbol, sum(1 for _ in run)) for symbol, run in groupby(needed)]
    behind = [LAST]
    for symbol, rows in reversed(runs):
        behind.append(advanced(symbol, rows, behind[-1]))
    cost = behind.pop()[START]
    audit, state = [], START
    for (symbol, rows), after in zip(runs, reversed(behind), strict=True):
        while rows:
            block = min(rows, _BLOCK)
            rows -= block
            steps = _unrolled(symbol, block, advanced(symbol, rows, after))
            edits = []
            for place in range(block, 0, -1):
                edit = "I"
                while edit == "I":
                    edit, state = _choose(symbol, state, steps[place], steps[place - 1])
                    edits.append(edit)
            audit.append("".join(edits))
    while state not in ACCEPTING:
        audit.append("I")
        state = GIVEN[state]
    return cost, "".join(audit)


@lru_cache(maxsize=1 << 15)
def solved_before(symbols: bytes) -> tuple[int, str]:
    """``solve`` for short conversations, most of which look alike."""
    return solve(symbols)


_LEGAL = {(INITIALS.index(a), INITIALS.index(b)) for a, b in ("su", "ua", "au")}
_INITIAL = bytes(s & 3 for s in range(256))
_FAULT = bytes(s >> 2 for s in range(256))


def facts(symbols: bytes) -> tuple[int, int, int, int]:
    """Rows that are blank, duplicate and truncated, and neighbours that may not be."""
    faults, initials = symbols.translate(_FAULT), symbols.translate(_INITIAL)
    wrong = sum(pair not in _LEGAL for pair in zip(initials, initials[1:]))
    return faults.count(BLANK), faults.count(REPEATED), faults.count(CUT), wrong


def _marked(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The four columns, a number for every row and the order of equal turns, written."""
    one_blank = F.lit(" ")
    return written(
        rows.select(
            rows[conv_id].alias("conv_id"),
            rows[turn].alias("turn"),
            F.coalesce(rows[role].cast("string"), one_blank).alias("role"),
            F.coalesce(rows[text].cast("string"), one_blank).alias("text"),
        ).select("*", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row")),
        "conversations",
    )


ORDER = ("turn", "role", "tie", "row")  # within a conversation


def _symbols(rows: DataFrame) -> DataFrame:
    """``rows`` without texts but with their symbols."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r")), -1, 1)
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = rows.select(
        "conv_id", *ORDER,
        place.alias("initial"),
        (last == "").alias("blank"),
        last.isin(".", "!", "?").alias("ended"),
        # Lengths keep the parts of the digest apart.
        F.sha2(
            F.concat_ws(
                ":", F.col("conv_id").isNull().cast("string"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")),
                F.octet_length("role").cast("string"), "role", "text",
            ),
            256,
        ).alias("digest"),
    )
    place_of = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "row")
    firsts = (
        narrow.where("NOT blank")
        .groupBy("digest")
        .agg(F.min(place_of).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(place_of > F.col("first"), REPEATED)
        .when(~F.col("ended"), CUT)
        .otherwise(CLEAN)
    )
    return narrow.join(firsts, "digest", "left").select(
        "conv_id", *ORDER, (F.col("initial") + 4 * fault).cast("int").alias("symbol")
    )


def _ordered(frame: DataFrame, first: Column | str) -> list[Column]:
    return [F.col(first).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ORDER]]


PART = "conv_id {kind}, part int, symbols binary, low {turn}, high {turn}, turns bigint"


def _parts(rows: DataFrame) -> DataFrame:
    """Each task's part of every conversation: symbols in order, and its turns."""
    kinds = [rows.schema[c].dataType for c in ("conv_id", "turn")]
    ordered = rows.repartitionByRange(*_ordered(rows, "conv_id")).sortWithinPartitions(*_ordered(rows, "conv_id"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, open_, schema = TaskContext.get().partitionId(), None, None
        for batch in batches:
            schema = schema or pa.schema(
                [("conv_id", batch.schema.field("conv_id").type), ("part", pa.int32()), ("symbols", pa.binary())]
                + [(n, batch.schema.field("turn").type) for n in ("low", "high")] + [("turns", pa.int64())]
            )
            done = []
            for conv, turn, symbol in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "symbol")], strict=True):
                if open_ is None or open_[0] != conv:
                    if open_ is not None:
                        done.append(open_)
                    open_ = [conv, part, bytearray(), None, None, 0]
                open_[2].append(symbol)
                if turn is not None:
                    if open_[3] is None:
                        open_[3] = turn
                    open_[5] += turn != open_[4]
                    open_[4] = turn
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, [*d[:2], bytes(d[2]), *d[3:]], strict=True)) for d in done], schema=schema)
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, [*open_[:2], bytes(open_[2]), *open_[3:]], strict=True))], schema=schema)

    return ordered.mapInArrow(cut, PART.format(kind=kinds[0].simpleString(), turn=kinds[1].simpleString()))


class Conversation:
    """What is known of a conversation while its rows go by."""

    def __init__(self, conv_id):
        self.conv_id, self.symbols = conv_id, bytearray()
        self.low = self.high = None
        self.turns, self.audit = 0, None

    def add(self, symbols: bytes, low, high, turns: int) -> None:
        """The next part; a turn that goes on from the part before counts once."""
        self.symbols += symbols
        if low is not None:
            self.turns += turns - (self.high == low)
            self.low, self.high = low if self.low is None else self.low, high

    def begin(self) -> None:
        symbols = bytes(self.symbols)
        self.facts = facts(symbols)
        self.cost, self.audit = solved_before(symbols) if len(symbols) <= 64 else solve(symbols)
        self.gaps = 0 if self.low is None else int(self.high) - int(self.low) + 1 - self.turns
        self.symbols = bytearray()
        self.place = self.given_out = self.lines = 0
        self.state, self.digest = START, hashlib.sha256()

    def _line(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.lines += 1

    def _given(self) -> str:
        self.state = GIVEN[self.state]
        return "user" if self.state == USER else "assistant"

    def inserts(self) -> Iterator[tuple[str, str | None, str | None]]:
        """The inserted rows that come next: edit, role, text."""
        while self.place < len(self.audit) and self.audit[self.place] == "I":
            self.place += 1
            role = self._given()
            self._line(role, "")
            yield "I", role, ""

    def row(self, role: str, text: str) -> tuple[str, str | None, str | None]:
        """What becomes of the next row."""
        edit = self.audit[self.place]
        self.place += 1
        if edit == "D":
            return edit, None, None
        if edit == "R":
            role = self._given()
        else:
            self.state = NEXT[role[0]][self.state]
        self._line(role, text)
        return edit, role, text


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
TURNS = "place bigint, edit string, role string, text string"


def _streamed(rows: DataFrame, turns: bool) -> DataFrame:
    """Parts and rows of every conversation in one task and in order, and what follows."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    parts = _parts(_symbols(rows))
    met = (
        parts.select("*", F.lit(False).alias("is_row"))
        .unionByName(rows.select("*", F.lit(True).alias("is_row")), allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "is_row", "part", *_ordered(rows, "turn")[1:])
        .select("conv_id", "is_row", "symbols", "low", "high", "turns", "role", "text")
    )

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, schema, size = None, [], None, 0
        shape = [("place", pa.int64())] + [(n, pa.string()) for n in ("edit", "role", "text")]
        if not turns:
            shape = [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
            shape += [("audit", pa.string()), ("repaired_sha256", pa.string())]

        def put(edits) -> None:
            nonlocal size
            for edit, role, text in edits:
                if turns:
                    out.append((now.conv_id, now.given_out, edit, role, text))
                    size += len(text or "")
                now.given_out += 1

        def end() -> None:
            put(now.inserts())
            if not turns:
                out.append((now.conv_id, now.gaps, *now.facts, now.cost, now.audit, now.digest.hexdigest()))

        def batch() -> pa.RecordBatch:
            nonlocal out, size
            made = pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)
            out, size = [], 0
            return made

        for b in batches:
            schema = schema or pa.schema([("conv_id", b.schema.field("conv_id").type), *shape])
            for conv, is_row, symbols, low, high, n, role, text in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if not is_row:
                    if now is None or now.conv_id != conv:
                        if now is not None:
                            end()
                        now = Conversation(conv)
                    now.add(symbols, low, high, n)
                    continue
                if now.audit is None:
                    now.begin()
                put(now.inserts())
                put([now.row(role, text)])
                if len(out) >= 2_000 or size > 4 << 20:
                    yield batch()
            if out:
                yield batch()
        if now is not None:
            end()
        if out:
            yield batch()

    return met.mapInArrow(repair, f"conv_id {kind}, {TURNS if turns else REPORT}")


def repaired_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place, edit, role, text: every row of the audits in order, inserted ones with
    an empty text, deleted ones (edit ``D``) with null role and text. Rows as in ``repair``."""
    return _streamed(_marked(rows, conv_id, turn, role, text), True)


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation of ``rows``: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    A null role or text is one blank. A null conversation is a conversation like others. Null
    turns come first and are no gaps; rows of equal turns go by role, then by a hash of the
    text. Rows that repeat are duplicates. A role that begins with neither s, u nor a, and an
    empty one, can not be kept. An empty table gives no rows. Other columns are left out.
    """
    return _streamed(_marked(rows, conv_id, turn, role, text), False)


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with known faults: a checksum of conversation and turn (a null one
    is a blank) drops a row, empties its text, takes its ends of sentences, repeats it or
    makes it the user's."""
    blank = F.lit(" ")
    conv, turn = [F.coalesce(rows[c].cast("string"), blank) for c in ("conv_id", "turn")]
    key = F.concat(conv, F.lit(":"), turn)
    return (
        rows.select(
            rows["conv_id"].alias("conv_id"),
            rows["turn"].alias("turn"),
            F.coalesce(rows["role"], blank).alias("role"),
            F.coalesce(rows["text"], blank).alias("text"),
            (F.crc32(key.cast("binary")) % 20).alias("fate"),
        )
        .where("fate <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(True), F.when(F.col("fate") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


NOTHING = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    reports = repair(damaged(conversations)).withColumnRenamed("conv_id", "known")
    every = conversations.select("conv_id").distinct()
    return every.join(reports, every["conv_id"].eqNullSafe(reports["known"]), "left").drop("known").select(
        "conv_id", *[F.coalesce(c, F.lit(v).cast(reports.schema[c].dataType)).alias(c) for c, v in NOTHING.items()]
    )
