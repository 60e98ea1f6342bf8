"""Secret scans with corpus-wide ownership frequency.

Three plain patterns give the base spans of a text. Beside them, tokens that look random
are candidates. The hash of every candidate and every base value is counted over the whole
corpus by the owners and repositories it occurs in: a value that several owners carry is a
copied example; a candidate that one owner alone carries looks live and is added as a span
of kind ``live``. Only hashes are shuffled, and a widely copied one is counted in part
before it is sent.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.tables import id_and_text, table
from marquee.session import written

# The patterns and smallest lengths of the base spans, fixed values.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "live")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
LEAST_BITS = 3.5
_ROW, _SPANS, _FINAL = "__row", "__spans", "__final"


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the three base kinds, in code points."""
    found = [
        (m.start(), m.end(), "assign", m[2])
        for m in ASSIGN.finditer(text)
        if len(m[2]) >= ASSIGN_LEAST
    ]
    found += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def looks_random(token: str) -> bool:
    """Upper case, lower case and digits together, and at least 3.5 bits a character."""
    if not (re.search("[A-Z]", token) and re.search("[a-z]", token) and re.search("[0-9]", token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= LEAST_BITS


def candidates(text: str, taken: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Tokens that look random and touch no base span."""
    found, i = [], 0
    by_start = sorted((s[0], s[1]) for s in taken)
    reach = 0  # the largest end of the base spans that begin before the token ends
    for m in CANDIDATE.finditer(text):
        while i < len(by_start) and by_start[i][0] < m.end():
            reach = max(reach, by_start[i][1])
            i += 1
        if reach <= m.start() and looks_random(m[0]):
            found.append((m.start(), m.end(), "live", m[0]))
    return found


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


SPAN = "struct<start:int,end:int,kind:string,value:bigint>"


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        spans = []
        for text in batch["text"]:
            base = base_spans(text)
            spans.append(
                [(s, e, k, _hash(v)) for s, e, k, v in base + candidates(text, base)]
            )
        yield pd.DataFrame(
            {c: batch[c] for c in ("doc_id", "owner", "repo")} | {"spans": spans}
        )


def found_spans(
    docs: DataFrame, doc_id: str, text: str, owner: str, repo: str
) -> DataFrame:
    """doc_id, owner, repo, spans of each row, and a row number that stays as it is."""
    rows = id_and_text(
        docs.select(
            docs[doc_id].alias("doc_id"),
            docs[text].alias("text"),
            F.coalesce(docs[owner].cast("string"), F.lit("")).alias("owner"),
            F.coalesce(docs[repo].cast("string"), F.lit("")).alias("repo"),
        ),
        "doc_id", "text", "owner", "repo",
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInPandas(
        _find, f"doc_id {kind}, owner string, repo string, spans array<{SPAN}>"
    )
    return written(found.withColumn("row", F.monotonically_increasing_id()), "spans")


def ownership(found: DataFrame) -> DataFrame:
    """value, owners, repos: how many owners and repositories carry each hash."""
    return (
        found.select(F.explode("spans.value").alias("value"), "owner", "repo")
        .distinct()
        .groupBy("value", "owner")
        .agg(F.count("*").alias("repos"))
        .groupBy("value")
        .agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
    )


def scan_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repo: str = "lang",
    example_owners: int = 2,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, found (array of start, end, kind, owners, repos).

    Base spans are all there; a candidate is there as ``live`` only if fewer than
    ``example_owners`` owners carry it. A repository is a pair of owner and ``repo``. Null
    text is empty, a null owner or repository is one of its own (the empty name). Rows are
    never merged, so repeated rows and repeated identifiers each give their own row.
    """
    found = found_spans(docs, doc_id, text, owner, repo)
    told = (
        found.select("row", F.explode("spans").alias("span"))
        .select("row", "span.*")
        .join(ownership(found), "value")
        .where((F.col("kind") != "live") | (F.col("owners") < example_owners))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "owners", "repos"))).alias("found"))
    )
    # The spans of one row are bounded by its text, and rows are dealt by their number.
    return found.select("row", "doc_id").join(told, "row", "left").select(
        "doc_id",
        F.coalesce(
            "found",
            F.array().cast("array<struct<start:int,end:int,kind:string,owners:bigint,repos:bigint>>"),
        ).alias("found"),
    )


def redact(
    docs: DataFrame,
    text: str = "text",
    owner: str = "source",
    repo: str = "lang",
    example_owners: int = 2,
) -> DataFrame:
    """``docs`` with every secret in the text replaced by its kind in angle brackets.

    Base spans are replaced whatever their owners; of the candidates only those that fewer
    than ``example_owners`` owners carry. Overlapping spans become one, named by the first.
    A text without candidates is done where it stands. Only the few texts with candidates
    are numbered and written, and only the hashes of these travel to the ownership counts.
    All other columns, null texts and repeated rows stay.
    """
    owners = ownership(
        found_spans(docs.select(F.lit(0).alias("doc_id"), docs[text].alias("text"), docs[owner].alias("owner"), docs[repo].alias("repo")), "doc_id", "text", "owner", "repo")
    )
    place = docs.columns.index(text)
    span = T.StructType.fromDDL("start int, end int, kind string, value bigint")
    with_spans = T.StructType([*docs.schema.fields, T.StructField(_SPANS, T.ArrayType(span))])

    def replaced(batch: pa.RecordBatch, texts: list) -> pa.RecordBatch:
        return batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            texts, waiting = batch.column(place).to_pylist(), []
            for i, plain in enumerate(texts):
                base = base_spans(plain or "")
                more = candidates(plain or "", base)
                if more:
                    waiting.append([dict(zip(span.names, (*s[:3], _hash(s[3])), strict=True)) for s in base + more])
                else:
                    waiting.append(None)
                    texts[i] = masked(plain, [dict(zip(span.names, s, strict=True)) for s in base]) if base else plain
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64()]
            kind = pa.list_(pa.struct(list(zip(span.names, kinds, strict=True))))
            batch = replaced(batch, texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(waiting, kind)], [*batch.schema.names, _SPANS]
            )

    scanned = docs.mapInArrow(first, with_spans)
    clean = scanned.where(F.col(_SPANS).isNull()).select(*docs.columns)
    hit = written(
        scanned.where(F.col(_SPANS).isNotNull()).withColumn(_ROW, F.monotonically_increasing_id()),
        "candidates",
    )
    spans = hit.select(_ROW, F.explode(_SPANS).alias("s")).select(_ROW, "s.*")
    live = spans.where("kind = 'live'").join(owners.where(F.col("owners") < example_owners), "value")
    final = (
        spans.where("kind <> 'live'").select(_ROW, "start", "end", "kind")
        .union(live.select(_ROW, "start", "end", "kind"))
        .groupBy(_ROW)
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias(_FINAL))
    )

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            texts, found = batch.column(place).to_pylist(), batch.column(len(batch.columns) - 1).to_pylist()
            done = [masked(t, s) if s else t for t, s in zip(texts, found, strict=True)]
            yield replaced(batch, done).select(list(range(len(batch.columns) - 1)))

    waiting = hit.join(final, _ROW, "left").select(*docs.columns, _FINAL)
    return clean.unionByName(waiting.mapInArrow(second, docs.schema))


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 250) -> Iterator[pa.RecordBatch]:
    """Batches in small parts: their texts are held several times over while they change."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)
        pa.default_memory_pool().release_unused()


def masked(text: str, spans: list[dict]) -> str:
    parts, place = [], 0
    for span in spans:  # by start
        if span["start"] >= place:
            parts += [text[place : span["start"]], f"<{span['kind']}>"]
        place = max(place, span["end"])
    return "".join([*parts, text[place:]])


def report(scanned: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and text of all spans of each row."""
    order = "array_position(array('assign', 'access', 'hex', 'live'), kind)"
    ranked = F.expr(
        f"array_sort(transform(found, s -> struct(s.start AS start, "
        f"{order.replace('kind', 's.kind')} AS rank, s.end AS end, s.kind AS kind)))"
    )
    rows = scanned.select("doc_id", ranked.alias("spans"))

    def joined(spans: str) -> F.Column:
        return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")

    def count(kind: str) -> F.Column:
        return F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) AS bigint)").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(joined("filter(spans, s -> s.kind <> 'live')"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        count("live"),
    )


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source plays the owner, its documents of one language a repository."""
    return report(scan_secrets(table(spark, sf_dir, "documents")))
