"""Database, external tables and the country table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.constants import FLAG_PATTERN
from marquee.schemas import DIM_COUNTRIES, STAGING, STAGING_RANGE, TITLE_TABLES, TableContract
from marquee.sinks import snapshots
from marquee.sinks.files import published_path, staging_units, unit_years


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(contract: TableContract) -> str:
    return ", ".join(f"{_quote(f.name)} {f.dataType.simpleString()}" for f in contract.schema)


def qualified(db: str, contract: TableContract) -> str:
    return f"{_quote(db)}.{_quote(contract.name)}"


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(db)}{where}")


def register_tables(
    spark: SparkSession,
    db: str,
    root: str,
    contracts: tuple[TableContract, ...] = TITLE_TABLES,
) -> None:
    """Expose published Parquet folders as external tables with declared columns: those of
    the root's present snapshot.

    Registering again is harmless: files written since are picked up, and a table that
    points elsewhere is moved to the new folder. A table of that name with other columns
    is left alone and refused, before any table is touched.
    """
    places = {c.name: _text(published_path(spark, c, root)) for c in contracts}
    known = [c for c in contracts if spark.catalog.tableExists(qualified(db, c))]
    for contract in known:
        found = [(f.name, f.dataType) for f in spark.table(qualified(db, contract)).schema]
        if found != [(f.name, f.dataType) for f in contract.schema]:
            raise ValueError(f"table {qualified(db, contract)} has other columns: {found}")
    for contract in contracts:
        table, place = qualified(db, contract), places[contract.name]
        if contract in known:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {place}")
        else:
            spark.sql(f"CREATE TABLE {table} ({_columns(contract)}) USING PARQUET LOCATION {place}")
        spark.sql(f"REFRESH TABLE {table}")


def register_staging(spark: SparkSession, db: str, path: str, name: str = "staging") -> str:
    """Staging as an external table, a partition for every year range of the present
    snapshot. Registering again follows a newer snapshot."""
    table = f"{_quote(db)}.{_quote(name)}"
    columns = ", ".join(f"{_quote(f.name)} {f.dataType.simpleString()}" for f in [*STAGING, *STAGING_RANGE])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET "
        f"PARTITIONED BY ({', '.join(STAGING_RANGE.names)}) LOCATION {_text(path)}"
    )
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        spec = ", ".join(row.partition.split("/"))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    for key, unit in staging_units(spark, path).items():
        if unit["folder"]:
            spec = ", ".join(f"{n}={y}" for n, y in zip(STAGING_RANGE.names, unit_years(key), strict=True))
            place = _text(snapshots.paths(path, [unit["folder"]])[0])
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({spec}) LOCATION {place}")
    spark.sql(f"REFRESH TABLE {table}")
    return table


def create_country_table(spark: SparkSession, db: str) -> str:
    """Managed country table, four VARCHAR(256) columns; longer text fails on write."""
    table = qualified(db, DIM_COUNTRIES)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_columns(DIM_COUNTRIES)}) USING PARQUET")
    return table


def load_countries(
    spark: SparkSession, countries: DataFrame, db: str, overwrite: bool = False
) -> None:
    """Insert ``name, alpha2_code, alpha3_code`` rows. ``flag`` is computed from the
    alpha-3 code when the frame does not bring it."""
    if "flag" not in countries.columns:
        countries = countries.withColumn(
            "flag", F.format_string(FLAG_PATTERN, F.col("alpha3_code"))
        )
    rows = countries.select(*DIM_COUNTRIES.columns)
    rows.write.insertInto(qualified(db, DIM_COUNTRIES), overwrite=overwrite)
