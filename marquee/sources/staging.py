"""Staging tables and the legacy staging text files."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schemas import STAGING, STAGING_RANGE
from marquee.sinks import snapshots
from marquee.sources.pages import BROKEN, FILE

_WHOLE = (T.ShortType, T.IntegerType, T.LongType)


def _parsed(schema: T.StructType) -> T.StructType:
    """Schema to parse JSON staging with.

    Such files may come from nullable number columns, which turn whole numbers into
    ``90.0``. Whole-number columns are therefore parsed as exact decimals.
    """
    return T.StructType(
        [
            T.StructField(f.name, T.DecimalType(38, 10) if isinstance(f.dataType, _WHOLE) else f.dataType)
            for f in schema
        ]
    )


def _restored(schema: T.StructType, parent: str = "") -> list[Column]:
    """The parsed columns with their proper types; a broken number fails."""
    columns = []
    for field in schema:
        value = F.col(parent + field.name)
        if isinstance(field.dataType, _WHOLE):
            fits = value.isNull() | (value % 1 == 0)
            message = F.concat(F.lit(f"{field.name} is not a whole number: "), value.cast("string"))
            value = F.when(fits, value.cast(field.dataType)).otherwise(F.raise_error(message))
        columns.append(value.alias(field.name))
    return columns


def _load(spark: SparkSession, schema: T.StructType, source: str, fmt: str) -> DataFrame:
    """The folders of the present snapshot; without one, all there is below ``source``."""
    reader = lambda: spark.read.schema(schema).format(fmt).option("mode", "FAILFAST")
    found = snapshots.current(spark, source)
    if found is None:
        return reader().load(source).select(*schema.names)
    of_runs = [f for f in found.folders() if f.startswith(f"{snapshots.RUN}=")]
    plain = [f for f in found.folders() if f not in of_runs]
    parts = [
        reader().option("basePath", source).load(snapshots.paths(source, folders)).select(*schema.names)
        for folders in (of_runs, plain)
        if folders
    ]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)


def read_staging(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A staging directory as one table: ``parquet``, ``json`` (one object per line) or
    ``legacy`` (indented objects, all files there are). With ``fmt="table"`` a catalogue
    table. What is read is the snapshot that is current when this is called.

    Parquet is the format to keep staging in: each job then reads only the columns and
    nested fields it uses.
    """
    if fmt == "table":
        return spark.table(source)
    if fmt == "legacy":
        return read_concatenated_json(spark, source)
    if fmt == "json":
        schema = T.StructType([*_parsed(STAGING).fields, *STAGING_RANGE.fields])
        return _load(spark, schema, source, fmt).select(*_restored(STAGING), *STAGING_RANGE.names)
    return _load(spark, T.StructType([*STAGING.fields, *STAGING_RANGE.fields]), source, fmt)


def _year_of_name(place: int) -> Column:
    """First or second year of a file name like ``titles_1991_2000.json``; null without."""
    year = F.regexp_extract("_metadata.file_name", r"_(\d{4})_(\d{4})\.json$", place)
    return F.when(year != "", year.cast("int"))


def read_concatenated_json(
    spark: SparkSession, path: str, schema: T.StructType = STAGING, requested: bool = False, broken: bool = False
) -> DataFrame:
    """Legacy staging files: indented JSON objects one after another.

    JSON escapes line breaks inside strings, so a line holding just four blanks and a
    closing brace ends a record and nothing else does. It serves as the record separator
    of the text reader, which splits large files at it. Each record then lacks its closing
    brace, except the last one of a file without a final line break. With ``requested`` the
    year range in the name of the file is added as ``min`` and ``max``.

    A record that can not be read fails. With ``broken`` it does not: its text is in
    ``_broken``, its columns are null, and every row tells its file as ``_file``.
    """
    # Predicates may be evaluated in any order, so the parser itself must not see blank rows.
    # The search ends at the first character that is not blank.
    filled = F.col("value").rlike(r"[^ \r\n\t]")
    body = F.concat(F.regexp_replace("value", r"\n    \}\s*$", ""), F.lit("}"))
    kind = _parsed(schema)
    if broken:
        kind = T.StructType([*kind.fields, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE" if broken else "FAILFAST", "columnNameOfCorruptRecord": BROKEN}
    record = F.from_json(F.when(filled, body), kind, options)
    names = [_year_of_name(1).alias("min"), _year_of_name(2).alias("max")] if requested else []
    added = ["min", "max"] if requested else []
    rows = spark.read.option("lineSep", "\n    }\n").text(path).where(filled)
    if not broken:
        return rows.select(record.alias("r"), *names).select(*_restored(schema, "r."), *added)
    read = rows.select(record.alias("r"), *names, "value", F.col("_metadata.file_path").alias(FILE))
    wrong = F.col(f"r.{BROKEN}").isNotNull() | F.coalesce(~_whole_numbers(schema, "r."), F.lit(False))
    return (
        read.select("*", F.when(wrong, F.col("value")).alias(BROKEN))
        .withColumn("r", F.when(F.col(BROKEN).isNull(), F.col("r")))
        .select(*_restored(schema, "r."), *added, FILE, BROKEN)
    )


def _whole_numbers(schema: T.StructType, parent: str) -> Column:
    """Whether every whole-number column holds one, or null."""
    tests = [F.coalesce(F.col(parent + f.name) % 1 == 0, F.lit(True)) for f in schema if isinstance(f.dataType, _WHOLE)]
    return reduce(and_, tests, F.lit(True))
