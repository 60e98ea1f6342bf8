"""Staging to published tables, and the whole run."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from marquee.plans.normalize import JOBS, OF_TITLES, without_repeats
from marquee.plans.stage import stage_pages
from marquee.sinks import (
    create_country_table,
    create_database,
    load_countries,
    register_tables,
    snapshots,
    write_table,
)
from marquee.sinks.files import publish_tables, refuse_overlap, table_path
from marquee.sources import read_staging


def run_jobs(
    spark: SparkSession,
    staging: str,
    root: str,
    fmt: str = "parquet",
    only: Sequence[str] = (),
    at_once: int = len(JOBS),
) -> list[str]:
    """Write the published tables (all, or those named in ``only``); returns their names.

    They are written to a generation of their own below ``root``. When all are written, the
    root's snapshot points at them in one step; a job that fails leaves every table as it
    was. Older generations are deleted by ``publish``, which moves the registered tables.

    Each job is one action over one pruned scan of the staging files, which are listed
    once for all; a pass over the ids ahead tells whether rows of titles can repeat. The jobs do not depend on each other; up to ``at_once`` are submitted
    together, so the small last stages of one leave the cluster to the others.
    """
    unknown = set(only) - {contract.name for contract, _ in JOBS}
    if unknown:
        raise ValueError(f"unknown table(s): {', '.join(sorted(unknown))}")
    chosen = [(c, job) for c, job in JOBS if not only or c.name in only]
    if fmt != "table":
        for contract, _ in chosen:
            refuse_overlap(staging, table_path(contract, root))
    rows = read_staging(spark, staging, fmt)
    generation = snapshots.new_run()
    place = f"{root.rstrip('/')}/{generation}"
    once = without_repeats(rows) if any(job in OF_TITLES for _, job in chosen) else []
    made = [(contract, job(rows, once=True) if job in once else job(rows)) for contract, job in chosen]
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(write_table, table, contract, place) for contract, table in made]
    failed = [error for done in running if (error := done.exception()) is not None]
    if failed:
        snapshots.delete(spark, place)
        raise failed[0]
    publish_tables(spark, root, generation, [contract for contract, _ in chosen])
    return [contract.name for contract, _ in chosen]


def publish(
    spark: SparkSession,
    db: str,
    root: str,
    countries: DataFrame | None = None,
    db_location: str | None = None,
) -> None:
    """Make the published tables and the country table readable by name. Countries given
    replace those there; an empty country table is reported by a warning. Generations below
    ``root`` that neither the present snapshot nor the one before names are then deleted."""
    create_database(spark, db, db_location)
    table = create_country_table(spark, db)
    if countries is not None:
        load_countries(spark, countries, db, overwrite=True)
    if spark.table(table).isEmpty():
        warnings.warn(f"{table} has no rows: publish was given no countries", stacklevel=2)
    register_tables(spark, db, root)
    if snapshots.current(spark, root) is not None:
        snapshots.expire(spark, root)


def run_all(
    spark: SparkSession,
    pages_path: str,
    staging_path: str,
    root: str,
    db: str,
    countries: DataFrame | None = None,
    db_location: str | None = None,
    **stage_options,
) -> None:
    """Pages, staging, tables, catalogue, in that order.

    Each step is published as a whole or not at all: staging, then the six tables together,
    then the registered tables, which are pointed at the new generation.
    """
    stage_pages(spark, pages_path, staging_path, **stage_options)
    run_jobs(spark, staging_path, root, stage_options.get("fmt", "parquet"))
    publish(spark, db, root, countries, db_location)
