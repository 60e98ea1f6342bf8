"""What runs leave beside staging: errors, refused records, parsed files, audit slots.

Each is a table with a snapshot of its own (see ``marquee.sinks.snapshots``) whose units are
requested year ranges: what a run notes for a range replaces what earlier runs noted for
it, and leaves all other ranges alone. A range a run looked at and found nothing for is a
unit without a folder.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sinks import snapshots

RANGE_KEY = "requested"
Request = tuple[int | None, int | None]

ERRORS = "min int, max int, page_no int, status int, answered boolean, error_text string"
REFUSED = "min int, max int, file string, reason string, record string"
FILES = "min int, max int, path string, size bigint, modified timestamp"
SLOTS = (
    "min int, max int, slot int, copies bigint, failed bigint, asked string, asked_high string, promised string, "
    "promised_high string, is_last boolean, edges bigint, total bigint, total_high bigint"
)


def request_of(key: str) -> Request:
    low, _, high = key.rpartition("_")
    return None if low == "none" else int(low), None if high == "none" else int(high)


def request_key(request: Request) -> str:
    return "_".join("none" if end is None else str(end) for end in request)


def _key() -> Column:
    ends = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in ("min", "max")]
    return F.concat(F.lit("y"), F.concat_ws("_", *ends))


def write(rows: DataFrame, path: str) -> dict[str, str]:
    """Writes rows of requested ranges below ``path``; nobody reads them before they are
    noted. The folder of each range."""
    run = snapshots.new_run()
    rows.withColumn(RANGE_KEY, _key()).write.partitionBy(RANGE_KEY).parquet(f"{path}/{run}")
    found = snapshots.names_below(rows.sparkSession, f"{path}/{run}", f"{RANGE_KEY}=*")
    return {f.partition("=")[2][1:]: f"{run}/{f}" for f in found}


def note(spark: SparkSession, path: str, requests: Iterable[Request], folders: dict[str, str] | None = None, **facts) -> None:
    """Makes ``folders`` what the table at ``path`` holds for ``requests``; ranges without a
    folder become empty. ``facts`` are noted in the units. Nothing is published if nothing
    was there and nothing comes."""
    given = {key: (folders or {}).get(key) for key in map(request_key, requests)}
    if not any(given.values()) and not facts:
        found = snapshots.current(spark, path)
        if found is None or not any(found.units.get(key, {}).get("folder") for key in given):
            return
    snapshots.commit(spark, path, snapshots.replaced(given, lambda _: facts))


def read(spark: SparkSession, path: str, schema: str, folders: Iterable[str]) -> DataFrame:
    kind, folders = T.StructType.fromDDL(schema), list(folders)
    if not folders:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).option("basePath", path).parquet(*snapshots.paths(path, folders)).select(*kind.names)


def noted(spark: SparkSession, path: str, schema: str, **facts) -> DataFrame:
    """What the table holds now, of units noted with these ``facts``."""
    found = snapshots.current(spark, path)
    units = found.units.values() if found else ()
    of = [u["folder"] for u in units if u["folder"] and all(u.get(k) == v for k, v in facts.items())]
    return read(spark, path, schema, of)


def errors_path(staging_path: str) -> str:
    return staging_path.rstrip("/") + "-errors"


def refused_path(staging_path: str) -> str:
    return staging_path.rstrip("/") + "-refused"


def files_path(staging_path: str) -> str:
    return staging_path.rstrip("/") + "-files"


def slots_path(staging_path: str) -> str:
    return staging_path.rstrip("/") + "-slots"


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """All errors of the last run over each requested range, from the table at ``path``."""
    return noted(spark, path, ERRORS)


def read_refused(spark: SparkSession, staging_path: str) -> DataFrame:
    """Records the last run over each requested range could not stage: where they were
    landed, why, and as they were landed."""
    return noted(spark, refused_path(staging_path), REFUSED)
