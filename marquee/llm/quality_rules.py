"""Quality rules with cross-document line frequency.

Each text is measured inside its own row with array functions. Its lines, with white space
normalised and hashed, are then counted over all documents of the same host: a line in more
than ``share`` of a host's documents (and in ``least`` documents at least) is page furniture
and is removed. A document that keeps less than ``remain`` of the words of its distinct
lines is depleted and rejected. Lines are counted in part before they are shuffled, so a
line that a third of all documents carry sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.tables import BLANKS, id_and_text, table
from marquee.session import written

WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
LEAST_WORDS = 10


def _long(column: Column) -> Column:
    return column.cast("bigint")


def _neighbours(array: str, pair) -> Column:
    """``pair`` over each element and the next one; the array is read twice, not per element."""
    steps = F.greatest(F.size(array) - 1, F.lit(0))
    return F.zip_with(F.slice(array, 1, steps), F.slice(array, 2, steps), pair)


def plain(line: Column) -> Column:
    """A line as it is counted: white space normalised."""
    return F.trim(F.regexp_replace(line, BLANKS + "+", " "))


def measured(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and lines to rows
    with a text. Every array is a column of its own before it is used in a
    function over elements, so nothing is computed once per element."""
    words = docs.select(
        "*",
        F.array_remove(F.split("text", BLANKS + "+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)).alias("full_lines"),
    )
    hashed = words.select(
        "*",
        F.size("words").alias("n"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    windows = F.greatest(F.col("n") - (WINDOW - 1), F.lit(0))
    shifted = F.arrays_zip(*[F.slice("hashes", i + 1, windows).alias(f"h{i}") for i in range(WINDOW)])
    grams = hashed.select(
        "*",
        F.transform(
            shifted,
            lambda x, i: F.struct(F.xxhash64(*[x[f"h{k}"] for k in range(WINDOW)]).alias("h"), i.alias("i")),
        ).alias("grams"),
    )
    ordered = grams.select(
        "*",
        # Most texts repeat no window; only the others are sorted.
        F.when(
            F.size(F.array_distinct("grams.h")) < F.size("grams"), F.array_sort("grams")
        ).otherwise(F.slice("grams", 1, 0)).alias("ordered"),
    )
    repeated = ordered.select(
        "*",
        F.array_sort(
            F.array_distinct(
                F.flatten(
                    F.array_compact(
                        _neighbours("ordered", lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
                    )
                )
            )
        ).alias("starts"),
    )
    covered = F.when(F.size("starts") == 0, F.lit(0)).otherwise(
        F.aggregate(
            _neighbours("starts", lambda a, b: F.least(b - a, F.lit(WINDOW))),
            F.lit(WINDOW),
            lambda total, step: total + step,
        )
    )
    lines = F.array_distinct(
        F.transform(
            "full_lines",
            lambda line: F.struct(
                F.xxhash64(plain(line)).alias("line"), F.size(F.split(plain(line), " ")).alias("n")
            ),
        )
    )
    return repeated.select(
        *docs.columns,
        _long(F.col("n")).alias("n_words"),
        _long(F.length(F.regexp_replace("text", BLANKS + "+", ""))).alias("word_chars"),
        _long(F.length(F.regexp_replace("text", "[^#*$%&|<>]+", ""))).alias("n_symbols"),
        _long(F.size("full_lines") - F.size(F.array_distinct("full_lines"))).alias("n_dup_lines"),
        _long(covered).alias("n_repeat_words"),
        lines.alias("lines"),
    )


COUNTED = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    "line_words", "removed_words",
)


def _judged(
    docs: DataFrame, doc_id: str, text: str, host: str, share: float, least: int, remain: float, texts: bool
) -> tuple[DataFrame, DataFrame]:
    """One row per row of ``docs`` with ``row``, the counted columns and, if asked, the
    text; and the lines over the limit as (row, line)."""
    rows = docs.select(
        docs[doc_id].alias("doc_id"),
        docs[text].alias("text"),
        F.coalesce(docs[host].cast("string"), F.lit("")).alias("host"),
    )
    counted = measured(id_and_text(rows, "doc_id", "text", "host")).withColumn("row", F.monotonically_increasing_id())
    base = written(counted if texts else counted.drop("text"), "measured")
    lines = base.select("row", "host", F.explode("lines").alias("l")).select("row", "host", "l.line", "l.n")
    hosts = base.groupBy("host").agg(F.count("*").alias("host_docs"))
    common = (
        lines.groupBy("host", "line")
        .agg(F.count("*").alias("line_docs"))
        .where(F.col("line_docs") >= least)
        .join(hosts, "host")
        .where(F.col("line_docs") > F.col("host_docs") * share)
        .select("host", "line")
    )
    over = lines.join(common, ["host", "line"]).select("row", "line", "n")
    removed = over.groupBy("row").agg(F.sum("n").alias("removed_words"))
    line_words = F.aggregate("lines", F.lit(0).cast("bigint"), lambda t, x: t + x["n"])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("line_words") - F.col("removed_words")
    judged = (
        base.select("*", line_words.alias("line_words"), failed.alias("base_failed"))
        .join(removed, "row", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("bigint")))
        .withColumn("kept", ~F.col("base_failed") & (left >= F.col("line_words") * remain))
    )
    return judged.select("row", *COUNTED, *(["text"] if texts else [])), over.select("row", "line")


def cleaned(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    share: float = 0.2,
    least: int = 10,
    remain: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, line_words, removed_words, text.

    ``text`` is the text without its lines over the limit, wherever in it they stand; its
    other lines, blank ones too, are as they were. A null text comes back empty. Only texts
    with such lines are taken apart, line by line, and put together again; other columns of
    ``docs``, whatever their names, are left out.
    ``base_failed``: fewer than ten words, or over 20 of 100 words lie in five-word windows
    that the text repeats. ``line_words`` are the words of the distinct lines,
    ``removed_words`` those of lines over the limit. A null text counts as empty and fails,
    a null host is a host of its own. Repeated rows are documents of their own.
    """
    judged, over = _judged(docs, doc_id, text, host, share, least, remain, True)
    judged, over = written(judged, "judged"), written(over, "common-lines")
    own = (
        judged.select("row", "text")
        .join(over.select("row").distinct(), "row", "left_semi")
        .select("row", F.posexplode(F.split("text", "\n")).alias("place", "own"))
        .withColumn("line", F.xxhash64(plain(F.col("own"))))
        .join(over, ["row", "line"], "left_anti")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("place", "own"))).alias("left"))
    )
    touched = over.groupBy("row").agg(F.lit(True).alias("touched"))
    rest = F.coalesce(F.array_join(F.col("left.own"), "\n"), F.lit(""))
    return (
        judged.join(touched, "row", "left")
        .join(own, "row", "left")
        .select(*COUNTED, F.when(F.col("touched"), rest).otherwise(F.col("text")).alias("text"))
    )


def quality_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    share: float = 0.2,
    least: int = 10,
    remain: float = 0.5,
) -> DataFrame:
    """The counted columns of ``cleaned``; no text is written or taken apart for them."""
    return _judged(docs, doc_id, text, host, share, least, remain, False)[0].drop("row")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source plays its host."""
    return quality_rules(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host
    FROM documents
), words AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
           [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
    FROM docs
), places AS (
    SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words
), grams AS (
    SELECT * FROM (
        SELECT r, i, word || ' ' || lead(word, 1) OVER s || ' ' || lead(word, 2) OVER s || ' '
            || lead(word, 3) OVER s || ' ' || lead(word, 4) OVER s AS gram
        FROM places WINDOW s AS (PARTITION BY r ORDER BY i)
    ) WHERE gram IS NOT NULL
), counted AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams
), covered AS (
    SELECT r, sum(least(5, coalesce(next - i, 5))) AS n
    FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM counted WHERE n > 1)
    GROUP BY r
), lines AS (
    SELECT DISTINCT r, host, trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g')) AS line
    FROM (SELECT r, host, unnest(l) AS x FROM words)
), sized AS (
    SELECT *, len(string_split(line, ' ')) AS n, count(*) OVER (PARTITION BY host, line) AS line_docs FROM lines
), hosts AS (
    SELECT host, count(*) AS host_docs FROM docs GROUP BY host
), depleted AS (
    SELECT r, sum(n) AS line_words,
           sum(CASE WHEN line_docs >= 10 AND line_docs > host_docs * 0.2::DOUBLE THEN n ELSE 0 END) AS removed
    FROM sized JOIN hosts USING (host) GROUP BY r
), base AS (
    SELECT r, doc_id, len(w)::BIGINT AS n_words,
           length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM words LEFT JOIN covered USING (r)
), verdict AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(line_words - removed >= line_words * 0.5::DOUBLE, true) AS kept,
       coalesce(line_words, 0)::BIGINT AS line_words, coalesce(removed, 0)::BIGINT AS removed_words
FROM verdict LEFT JOIN depleted USING (r)
"""
