"""Service lists supplied by the user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.filters import MOST_NAMES, service_dictionary
from marquee.schemas import SERVICE_CATALOGUE, SERVICE_SELECTION


def read_service_selection(spark: SparkSession, path: str) -> DataFrame:
    """Selected services as JSON Lines: ``code``, ``clear_name``."""
    return spark.read.schema(SERVICE_SELECTION).option("mode", "FAILFAST").json(path)


def read_service_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """All known services as CSV with header: ``code``, ``streaming_name``, ``lcase_name``.

    ``lcase_name`` is stored, not computed from the name.
    """
    return (
        spark.read.schema(SERVICE_CATALOGUE)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def services_by_code(catalogue: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Selection (``code``, ``clear_name``) of the catalogue's services with these codes."""
    return catalogue.where(F.col("code").isin(*codes)).select(
        "code", F.col("streaming_name").alias("clear_name")
    )


def service_names(selection: DataFrame, most: int = MOST_NAMES) -> tuple[str, ...]:
    """Clear names of a short selection, for use inside filter expressions.

    A selection of more than ``most`` names is refused; it is better left a table:
    ``operators.filters.titles_on_services`` and ``filter_offers`` take one of any size.
    """
    names = service_dictionary(selection, most=most)
    if names is None:
        raise ValueError(f"more than {most} services: pass the selection as a table")
    return names
