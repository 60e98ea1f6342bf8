"""Landed response pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schemas import PAGE, PAGE_OUTLINE, PAGE_RANGE


BROKEN = "_broken"
FILE = "_file"


def read_pages(
    spark: SparkSession, path: str, multi_line: bool = True, titles: bool = True, broken: bool = False
) -> DataFrame:
    """Pages below ``path/min=<year>/max=<year>/``.

    ``multi_line=True``: one document per file, in any layout. Such a file is one page and
    so one small task input. ``multi_line=False``: one document per line; large files are
    split. ``titles=False`` skips the titles inside the edges, which saves most of the
    parsing.

    A document that does not fit the schema fails the read. With ``broken`` it does not:
    it is a row whose ``_broken`` holds the document as it was landed, and every row tells
    its file as ``_file``. Its other columns may be null or partly read.
    """
    fields = [*(PAGE if titles else PAGE_OUTLINE).fields, *PAGE_RANGE.fields]
    if broken:
        fields.append(T.StructField(BROKEN, T.StringType()))
    rows = (
        spark.read.schema(T.StructType(fields))
        .option("basePath", path)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE" if broken else "FAILFAST")
        .option("columnNameOfCorruptRecord", BROKEN)
        .json(path)
    )
    return rows.select("*", F.col("_metadata.file_path").alias(FILE)) if broken else rows


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """The files below ``path/min=<year>/max=<year>/``, none of them opened: path, size,
    modified, min, max."""
    listed = spark.read.schema("min int, max int, " + FILE_LISTING).format("binaryFile").option("basePath", path).load(path)
    return listed.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "min", "max")


FILE_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
