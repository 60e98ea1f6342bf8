"""Snapshots of a data set: which folders it is made of, switched in one step.

A data set is a root folder. What a run writes goes to a folder of its own, ``run=<name>``,
below the root, and readers do not look there by themselves: they look up the newest
manifest, ``_manifests/<number>.json``, which names a folder for every unit of the data set
(a year range of staging, a published table, a requested range of the error log). A run that
is killed anywhere before its manifest appears has changed nothing that is read. Units a run
does not name stay what they were.

A manifest appears under its name by one rename. Two runs that finish at once get numbers
one after the other, the later one on top of the earlier one's units. Manifests hold a few
hundred bytes for every unit, whatever the units hold.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import SparkSession

MANIFESTS = "_manifests"
RUN = "run"
KEEP = 2  # manifests: readers that began before the last one still find their folders
ABANDONED = 7 * 24 * 3600  # seconds after which a run that never published is deleted

Units = dict[str, dict]


@dataclass(frozen=True)
class Snapshot:
    """``units``: by key, the ``folder`` below the root (none if the unit is empty) and
    whatever else the writer noted."""

    number: int = 0
    units: Units = field(default_factory=dict)

    def folders(self) -> list[str]:
        return [u["folder"] for u in self.units.values() if u.get("folder")]


def new_run() -> str:
    """A folder name for a run; never taken for a number."""
    return f"{RUN}=r-{uuid.uuid4().hex}"


@lru_cache(maxsize=4)
def _hadoop(sc: SparkContext):
    """The class of paths and the settings of file systems; looked up once, as every look
    into the JVM's packages is a round trip."""
    return sc._jvm.org.apache.hadoop.fs.Path, sc._jsc.hadoopConfiguration()


def _at(spark: SparkSession, path: str):
    kind, settings = _hadoop(spark.sparkContext)
    place = kind(path)
    return place.getFileSystem(settings), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def names_below(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """Paths below ``path`` that match, relative to it."""
    fs, root = _at(spark, path)
    found = fs.globStatus(_at(spark, f"{path.rstrip('/')}/{pattern}")[1])
    depth = pattern.count("/") + 1
    if found is None:
        return []
    return sorted("/".join(s.getPath().toString().split("/")[-depth:]) for s in found)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = names_below(spark, f"{root.rstrip('/')}/{MANIFESTS}", "*.json")
    return sorted(int(n.removesuffix(".json")) for n in names if not n.startswith("."))


def _file(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}/{number:012d}.json"


def _load(spark: SparkSession, root: str, number: int) -> Snapshot:
    fs, place = _at(spark, _file(root, number))
    stream = fs.open(place)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Snapshot(number, json.loads(text)["units"])


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest snapshot below ``root``; none if nothing was ever published there."""
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else None


def commit(spark: SparkSession, root: str, change: Callable[[Units], Units], keep: int | None = KEEP) -> Snapshot:
    """Publishes what ``change`` makes of the present units, then deletes the folders that
    only manifests older than the last ``keep`` named (none: all stay)."""
    while True:
        before = current(spark, root) or Snapshot()
        after = Snapshot(before.number + 1, change(dict(before.units)))
        fs, draft = _at(spark, f"{root.rstrip('/')}/{MANIFESTS}/.{uuid.uuid4().hex}")
        final = _at(spark, _file(root, after.number))[1]
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps({"units": after.units}, indent=1).encode()))
        finally:
            stream.close()
        # Another run may have published in between: then this one goes on top of it.
        if not fs.exists(final) and fs.rename(draft, final):
            if keep is not None:
                expire(spark, root, keep)
            return after
        fs.delete(draft, False)


def expire(spark: SparkSession, root: str, keep: int = KEEP, abandoned: int = ABANDONED) -> None:
    """Deletes all but the last ``keep`` manifests, the runs nobody points at any more, and
    runs that were never published and have not changed for ``abandoned`` seconds."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    if len(numbers) <= keep and abandoned == ABANDONED:
        return
    kept = [_load(spark, root, n) for n in numbers[-keep:]]
    live = {_run_of(folder) for snapshot in kept for folder in snapshot.folders()}
    gone = {_run_of(folder) for n in numbers[:-keep] for folder in _load(spark, root, n).folders()}
    oldest = (time.time() - abandoned) * 1000
    for name in set(names_below(spark, root, f"{RUN}=*")) - live:
        fs, place = _at(spark, f"{root}/{name}")
        if name in gone or fs.getFileStatus(place).getModificationTime() < oldest:
            fs.delete(place, True)
    for number in numbers[:-keep]:
        delete(spark, _file(root, number))


def _run_of(folder: str) -> str:
    return folder.split("/", 1)[0]


def replaced(folders: dict[str, str | None], note: Callable[[str], dict] = lambda _: {}) -> Callable[[Units], Units]:
    """A change that points the keys of ``folders`` at new folders and leaves all others."""
    return lambda units: {**units, **{key: {"folder": folder, **note(key)} for key, folder in folders.items()}}


def paths(root: str, folders: Iterable[str]) -> list[str]:
    return [f"{root.rstrip('/')}/{folder}" for folder in folders]
