"""Session set-up and scratch tables in the shared folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the plans rely on. Partition counts and memory stay with the
# cluster; AQE sizes the shuffles from what the map side really wrote.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "marquee", master: str | None = None, **settings) -> SparkSession:
    """Start a session. Extra settings use ``__`` for dots: ``spark__ui__enabled="false"``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch tables that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back
    to a temporary folder of this machine.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="marquee-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


# Of this thread (or task): scopes that run side by side do not see each other's tables.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the scratch tables made inside it.

    Use it around work whose results are written or collected inside. A frame that is only
    read later must be made outside: it may stand on such a table.
    """
    made: list[str] = []
    outer = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(outer)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in map(hadoop.Path, made):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created yet. The innermost
    ``scratch_scope`` owns it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    made = _SCOPE.get()
    if made is not None:
        made.append(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` fixed as a scratch table, and its lineage cut there.

    Every later use reads the same rows, also when executors get lost in between. Parquet
    instead of a plain checkpoint lets each use read only the columns it needs.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Of an execution the shuffle files go when it has ended, not when the driver happens to
# collect its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A write by folder sorts its rows by folder, unless a task may keep the files of several
# open. With more folders in a task than this, it sorts the rest.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
FILES_OPEN = 64

_set_lock = threading.Lock()
_set: dict[object, list] = {}


@contextmanager
def _setting(spark: SparkSession, name: str, value) -> Iterator[None]:
    """The setting is as before when the last of those that run side by side has ended."""
    key = (spark._jsparkSession.hashCode(), name)
    with _set_lock:
        before = _set.setdefault(key, [0, spark.conf.get(name, None)])
        before[0] += 1
        spark.conf.set(name, value)
    try:
        yield
    finally:
        with _set_lock:
            before[0] -= 1
            if not before[0]:
                del _set[key]
                if before[1] is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, before[1])


def unsorted_writes(spark: SparkSession):
    """Writes by folder made inside it sort nothing: for wide rows that fall into few folders."""
    return _setting(spark, WRITERS, FILES_OPEN)


def shuffles_freed(spark: SparkSession):
    """What executions inside it shuffle goes when they end; frames read later shuffle anew."""
    return _setting(spark, FREED, "true")
