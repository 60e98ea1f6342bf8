"""Staging and table files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.years import YearRange, show
from marquee.schemas import TableContract
from marquee.session import unsorted_writes
from marquee.sinks import snapshots
from marquee.sinks.snapshots import Units

KIND, TITLES, ASIDE = "kind", "titles", "aside"
UNIT = ("year_min", "year_max")


def table_path(contract: TableContract, root: str) -> str:
    return f"{root.rstrip('/')}/{contract.folder}"


def published_path(spark: SparkSession, contract: TableContract, root: str) -> str:
    """Where a published table lies now: in the generation the root's snapshot names, or
    plainly below the root if nothing was ever published there in one."""
    found = snapshots.current(spark, root)
    if found is None:
        return table_path(contract, root)
    if contract.name not in found.units:
        raise FileNotFoundError(f"{contract.name} was never published below {root}")
    return f"{root.rstrip('/')}/{found.units[contract.name]['folder']}"


def refuse_overlap(source: str, target: str) -> None:
    """A job must not overwrite the files it reads."""
    a, b = source.rstrip("/") + "/", target.rstrip("/") + "/"
    if a.startswith(b) or b.startswith(a):
        raise ValueError(f"source {source} and target {target} overlap")


def unit_key(years: YearRange) -> str:
    return f"{years[0]}_{years[1]}"


def unit_years(key: str) -> YearRange:
    low, _, high = key.rpartition("_")
    return int(low), int(high)


def staging_units(spark: SparkSession, path: str) -> Units:
    """The year ranges staged below ``path``. A folder that was partitioned by year range
    without a snapshot counts as what it holds."""
    found = snapshots.current(spark, path)
    return found.units if found else _plain_units(spark, path)


def _plain_units(spark: SparkSession, path: str) -> Units:
    return {unit_key(_years_of(n)): {"folder": n} for n in snapshots.names_below(spark, path, "year_min=*/year_max=*")}


def _years_of(folder: str) -> YearRange:
    low, high = folder.split("/")[-2:]
    return int(low.partition("=")[2]), int(high.partition("=")[2])


def write_run(df: DataFrame, path: str, fmt: str = "parquet", rebalance: bool = False) -> tuple[str, dict[YearRange, str]]:
    """Writes rows by kind and year range to a run folder below ``path`` that nobody reads
    yet: its name, and the folder of each year range that has titles. JSON is packed. Titles
    are wide and a task can have many, so they are not sorted for it."""
    run = snapshots.new_run()
    out = df.hint("rebalance", *[F.col(k) for k in UNIT]) if rebalance else df
    packed = {"compression": "gzip"} if fmt == "json" else {}
    with unsorted_writes(df.sparkSession):
        out.write.partitionBy(KIND, *UNIT).format(fmt).options(**packed).save(f"{path.rstrip('/')}/{run}")
    folders = snapshots.names_below(df.sparkSession, f"{path.rstrip('/')}/{run}/{KIND}={TITLES}", "year_min=*/year_max=*")
    return run, {_years_of(f): f"{run}/{KIND}={TITLES}/{f}" for f in folders}


def publish_units(
    spark: SparkSession, path: str, folders: dict[YearRange, str], ranges: Sequence[YearRange] = (), notes: dict[YearRange, dict] | None = None
) -> None:
    """Makes ``folders`` what staging holds for their year ranges. One of ``ranges`` that has
    no folder becomes empty. Year ranges that overlap others already staged are refused, as
    their titles would be staged twice."""
    given = {years: folders.get(years) for years in (*ranges, *folders)}
    notes = notes or {}

    def change(units: Units) -> Units:
        units = units or _plain_units(spark, path)
        for low, high in given:
            for key in units:
                a, b = unit_years(key)
                if (a, b) != (low, high) and a <= high and b >= low:
                    raise ValueError(f"year range {show((low, high))} overlaps {show((a, b))}, which is staged")
        return units | {unit_key(y): {"folder": f, **notes.get(y, {})} for y, f in given.items()}

    snapshots.commit(spark, path, change)


def write_staging(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    ranges: Sequence[YearRange] = (),
    rebalance: bool = False,
) -> None:
    """Replace the year ranges present in ``df`` and leave all others alone, in one step: a
    run that ends before its last file leaves staging as it was.

    ``ranges`` names the ranges this run stands for. One that turns out to have no title is
    empty afterwards, whatever an earlier run left for it. Rows without a year range are
    refused: there is no partition for them.

    There is no shuffle unless ``rebalance`` asks for one: titles arrive range by range,
    so a task touches few ranges. Ask for it when many small input splits would leave many
    small files; it lets AQE split a large range over many files of even size.
    """
    nowhere = F.col(UNIT[0]).isNull() | F.col(UNIT[1]).isNull()
    refused = F.raise_error(F.lit("a title without year range can not be staged")).cast("int")
    placed = df.withColumn(UNIT[0], F.when(nowhere, refused).otherwise(F.col(UNIT[0])))
    _, folders = write_run(placed.withColumn(KIND, F.lit(TITLES)), path, fmt, rebalance)
    publish_units(df.sparkSession, path, folders, ranges)


def write_table(df: DataFrame, contract: TableContract, root: str) -> str:
    """Overwrite one table's folder with contract columns and types; returns its path."""
    path = table_path(contract, root)
    contract.conform(df).write.mode("overwrite").parquet(path)
    return path


def publish_tables(spark: SparkSession, root: str, run: str, contracts: Sequence[TableContract]) -> None:
    """Makes the tables written to the run folder ``run`` the ones that are read. Older
    generations stay: a catalogue may still point at them."""
    snapshots.commit(spark, root, snapshots.replaced({c.name: f"{run}/{c.folder}" for c in contracts}), keep=None)
