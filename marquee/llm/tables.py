"""Reading the corpus tables, and the few columns an operator works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space as the operators understand it: blank, tab, line feeds, form feed, return.
BLANKS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null as empty) and ``more``; all other columns, whatever their
    names, are left out before anything is added."""
    return docs.select(
        docs[doc_id].alias("doc_id"),
        F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
        *[docs[name] for name in more],
    )
