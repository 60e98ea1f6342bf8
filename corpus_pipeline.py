"""The corpus pipeline: five stages over the documents.

    quality classifier   documents predicted to be of low quality go
    exact dedup          of equal texts the row with the smallest identifier stays
    n-gram Jaccard join  of near duplicates the row with the smallest identifier stays
    secret scans         every secret found is replaced in the text by its kind
    packing              the texts as pieces of sequences of 2048 tokens

Every stage takes what its predecessor kept, as a table with the columns of documents, and
returns such a table, but for the last, which returns the pieces with their token ids. The
two stages that remove copies number their rows first and decide by row: rows without an
identifier or with a repeated one are rows like any other. Of copies the row with the
smallest identifier stays, a missing one being the largest, and of equal identifiers any one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.exact_dedup import exact_dedup
from marquee.llm.ngram_join import near_duplicates
from marquee.llm.packing import pack
from marquee.llm.quality_classifier import keep_good, train
from marquee.llm.secret_scans import redact
from marquee.session import written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, trained on the labels that may be learnt from, predicts
    to be good. A null text is scored as an empty one; a null identifier has no label but a
    score like others. Every stage drops columns that documents do not have."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, train(docs, labels)).select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """Adds ``key``, the identifier with a number of the row: never null, never twice, in the
    order of the identifiers. Written, so that every pass meets the same numbers."""
    key = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", F.monotonically_increasing_id().alias("row"))
    return written(docs.select(*COLUMNS, key.alias("key")), "numbered")


def _without(numbered: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows whose number is not in ``dropped(row)``, a table of any size."""
    return numbered.withColumn("row", F.col("key.row")).join(dropped, "row", "left_anti").select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts, null counting as empty; an empty table stays empty."""
    rows = _numbered(docs)
    return _without(rows, exact_dedup(rows, "key").where("NOT kept").select("doc_id.row"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near duplicates. Texts without words are near nothing and stay."""
    rows = _numbered(docs)
    return _without(rows, near_duplicates(rows, "key").where("doc_id <> component_id").select("doc_id.row"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets in their texts replaced; a null text comes back empty or null."""
    return redact(docs).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their token ids; an empty text is the end id alone."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("secret scans", secrets),
    ("packing", packing),
]

# A learned classifier and a tokenizer have no SQL form: tests/llm hold a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage-{number}")
    return docs
