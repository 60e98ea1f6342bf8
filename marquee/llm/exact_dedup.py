"""Exact duplicates by a tree merge of sorted digest runs.

Every input partition is a run: its digests, sorted, each with the smallest identifier that
carries it. Runs meet in ``levels`` rounds. In a round, groups of ``fan_in`` runs exchange
their entries so that the member of the group that owns a digest (one digit of the
digest's address) receives all of the group's entries for it and merges them: one row per
digest with the smallest identifier and the number of rows so far. After the last round
the address of every entry is that of its digest, so each digest is held once, and no run
ever holds more than its share of the digests. A group of copies shrinks to one entry per
run before anything is sent, and again in every round.

Two entries count as the same only if SHA-256, length and a second hash of the normalised
text agree; that check is part of the key in every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.tables import BLANKS, id_and_text, table
from marquee.session import written

PROOF = ("digest", "n_bytes", "proof")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the digest, length and second hash of each normalised text."""
    plain = F.regexp_replace("text", BLANKS + "+", " ")
    return id_and_text(docs, doc_id, text).select(
        "doc_id",
        F.unhex(F.sha2(plain, 256)).alias("digest"),
        F.octet_length(plain).alias("n_bytes"),
        F.xxhash64(plain).alias("proof"),
    )


def merge_runs(entries: DataFrame, fan_in: int = 16, levels: int = 2) -> DataFrame:
    """One row per digest of ``entries``: ``first`` (missing, doc_id) and ``copies``."""
    runs = fan_in**levels
    address = F.pmod(F.xxhash64("digest"), F.lit(runs))
    merged = entries.select(
        *PROOF,
        F.pmod(F.spark_partition_id(), F.lit(runs)).cast("bigint").alias("run"),
        # A missing identifier is larger than any other.
        F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id").alias("first"),
        F.lit(1).cast("bigint").alias("copies"),
    )
    for level in range(levels):
        weight = fan_in**level
        own = F.floor(F.col("run") / weight) % fan_in
        goal = F.floor(address / weight) % fan_in
        merged = (
            merged.withColumn("run", (F.col("run") + (goal - own) * weight).cast("bigint"))
            .groupBy("run", *PROOF)
            .agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
        )
    return merged.drop("run")


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fan_in: int = 16, levels: int = 2
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after every run of ASCII white space became one blank; a
    null text counts as empty. Of equal texts the smallest identifier is kept. A null
    identifier is larger than all others; rows that repeat the kept identifier with the
    same text are all marked as kept. An empty table gives no rows.
    """
    entries = written(digests(docs, doc_id, text), "digests")
    several = merge_runs(entries, fan_in, levels).where("copies > 1")
    # Only digests that occur twice travel back; for all others the row itself is kept.
    return entries.join(several, list(PROOF), "left").select(
        "doc_id",
        F.when(F.col("copies").isNull(), F.col("doc_id"))
        .otherwise(F.col("first.doc_id"))
        .alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("bigint")).alias("group_size"),
        (F.col("copies").isNull() | F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).alias(
            "kept"
        ),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH plain AS (
    SELECT doc_id,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM plain
"""
