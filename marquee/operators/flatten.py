"""Nested records to staging columns."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.constants import SHOW


def flatten(df: DataFrame, sep: str = "_", max_level: int = 5, whole: Collection[str] = ()) -> DataFrame:
    """Replace nested structs by columns named after their path; arrays stay whole, and so
    do the columns named in ``whole``.

    The walk goes over the schema on the driver and yields one ``select``, so column
    pruning reaches the scan through it. ``max_level`` counts the struct levels that are
    opened: what lies deeper stays a struct.
    """
    leaves: list[tuple[str, str]] = []

    def walk(schema: T.StructType, path: list[str]) -> None:
        for field in schema:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType) and len(path) < max_level and (path or field.name not in whole):
                walk(field.dataType, here)
            else:
                quoted = ".".join("`" + part.replace("`", "``") + "`" for part in here)
                leaves.append((sep.join(here), quoted))

    walk(df.schema, [])
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    names = [name if exact else name.lower() for name, _ in leaves]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"flattened column names clash: {', '.join(clashes)}")
    return df.select([F.col(path).alias(name) for name, path in leaves])


def seasons_of_shows(df: DataFrame) -> DataFrame:
    """Keep ``totalSeasonCount`` for shows only; other object types get null."""
    return df.withColumn(
        "totalSeasonCount", F.when(F.col("objectType") == SHOW, F.col("totalSeasonCount"))
    )
