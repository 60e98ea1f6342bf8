"""Landed pages to the staging table.

A run parses every landed document once. That one pass writes the titles, by year range, to
a run folder of the staging root, and beside them one row per page with what the audit and
the error log need, and every record that can not be staged. Readers see nothing of it: only
when the pages turn out sound, and every landed edge is accounted for, does the staging
snapshot point at the folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.constants import YEAR_BOUNDARIES
from marquee.functions import intervals
from marquee.functions.years import YearRange, range_ends, range_number, show, uncovered
from marquee.operators.filters import (
    YEAR,
    TitleFilter,
    filter_offers,
    mark_on_services,
    offers_of,
    on_dictionary,
    requested_year,
    service_dictionary,
    title_test,
)
from marquee.operators.flatten import flatten, seasons_of_shows
from marquee.operators.pages import answered, audit_slots, merged_slots, page_errors, page_facts, page_slots
from marquee.plans import run_log
from marquee.plans.run_log import Request
from marquee.schemas import PAGE_RANGE, STAGING
from marquee.session import scratch_path, scratch_scope
from marquee.sinks import snapshots
from marquee.sinks.files import ASIDE, KIND, TITLES, UNIT, publish_units, refuse_overlap, staging_units, unit_key, write_run
from marquee.sources import page_files, read_concatenated_json, read_pages
from marquee.sources.pages import BROKEN, FILE

_SHOWN = 20  # in a message; the tables have all
_PAGE, _PLACE, _GONE, _REASON, _RECORD = "_page", "_place", "_gone", "_reason", "_record"
_FIT, _HERE, _UNIT = "_fit", "_here", "_unit"

NOT_A_PAGE = "not a page"
NO_TITLE = "an edge without a title"
NO_RANGE = "no year range"
NOT_A_TITLE = "not a title"


class PagesRejected(RuntimeError):
    """Landed pages hold a failed response, an unreadable document or an incomplete year range."""


class RowsMissing(RuntimeError):
    """Not every landed title is staged, filtered, outside the run or refused."""


def _names(services: Sequence[str] | DataFrame | None) -> Sequence[str] | DataFrame | None:
    """A table of services as its names, if they are few enough to be looked up in a row."""
    if not isinstance(services, DataFrame):
        return None if services is None else tuple(services)
    names = service_dictionary(services)
    return services if names is None else names


@dataclass(frozen=True)
class Restrictions:
    """What a run keeps of the titles, and of their offers: everything, or what is on the
    services of a list or of a long table."""

    wanted: TitleFilter = TitleFilter()
    services: tuple[str, ...] | DataFrame | None = None
    offer_services: tuple[str, ...] | DataFrame | None = None

    def fingerprint(self, *more) -> str:
        """The same for the same restrictions, whatever frames they come in."""

        def told(services) -> object:
            if not isinstance(services, DataFrame):
                return services
            code = F.xxhash64("clear_name").cast("decimal(38,0)")
            return tuple(services.select("clear_name").distinct().agg(F.count("*"), F.sum(code)).first())

        parts = (self.wanted, told(self.services), told(self.offer_services), *more)
        return hashlib.sha256(repr(parts).encode()).hexdigest()

    def joined(self) -> bool:
        """Whether a table of services has to be joined."""
        return any(isinstance(s, DataFrame) for s in (self.services, self.offer_services))


def of_ranges(pages: DataFrame, ranges: Sequence[YearRange]) -> DataFrame:
    """Pages requested for a range that overlaps one of ``ranges``. The test is on the
    partition columns alone, so other directories are not listed for reading."""
    overlap = F.lit(False)
    for low, high in ranges:
        overlap = overlap | ((F.col("min") <= high) & (F.col("max") >= low))
    return pages.where(overlap)


def of_requests(pages: DataFrame, requests: Collection[Request]) -> DataFrame:
    """Pages requested for exactly one of ``requests``; other directories are not read."""
    of = F.lit(False)
    for low, high in requests:
        of = of | (F.col("min").eqNullSafe(low) & F.col("max").eqNullSafe(high))
    return pages.where(of)


def _possible(requests: Iterable[Request]) -> list[YearRange]:
    return [(a, b) for a, b in requests if a is not None and b is not None and a <= b]


def _overlap(a: YearRange, b: YearRange) -> bool:
    return a[0] <= b[1] and a[1] >= b[0]


def asked_units(ranges: Sequence[YearRange] | None, units: Sequence[YearRange]) -> tuple[YearRange, ...]:
    """The staging ranges a run is asked for: all, or those named. A name within an open
    range stands for it."""
    if ranges is None:
        return tuple(units)
    asked = []
    for years in ranges:
        hits = [u for u in units if u == years] or [u for u in (units[0], units[-1]) if u[0] <= years[0] and years[1] <= u[1]]
        if not hits:
            raise ValueError(f"{show(years)} is no staging range; there are {', '.join(map(show, units))}")
        asked += hits
    return tuple(dict.fromkeys(asked))


def needed_requests(requests: Collection[Request], changed: Collection[Request], asked: Sequence[YearRange]) -> list[Request]:
    """Requests a run must parse again: a staging range is replaced as a whole, so with one
    request that changed come all that overlap its ranges, and so on."""
    need = set(changed)
    while True:
        ranges = [u for u in asked if any(_overlap(r, u) for r in _possible(need))]
        more = need | {r for r in _possible(requests) if any(_overlap(r, u) for u in ranges)}
        if more == need:
            return sorted(need, key=lambda r: (r[0] is not None, r[1] is not None, r if None not in r else ()))
        need = more


def landed_units(
    requests: Collection[Request], asked: Sequence[YearRange], named: bool, staged: dict[str, dict]
) -> tuple[dict[YearRange, YearRange], list[YearRange], list[YearRange]]:
    """The staging ranges that were requested, with the outer years of that, then those that
    were requested in part only, then those that were named but not requested.

    Ranges nothing was requested for keep what is staged for them. An open range is whole
    without a gap from its closed end, and if no less of it was requested than is staged.
    """
    found, partial, missing = {}, [], []
    for unit in asked:
        years, whole = uncovered(unit, _possible(requests))
        if years is None:
            missing += [unit] if named else []
            continue
        found[unit] = years
        before = staged.get(unit_key(unit), {}).get("requested", years)
        if not whole or before[0] < years[0] or before[1] > years[1]:
            partial.append(unit)
    return found, partial, missing


def placed_rows(rows: DataFrame, keep: Restrictions, units: Sequence[YearRange], run: Collection[YearRange]) -> DataFrame:
    """Every landed record with its place and what becomes of it.

    ``rows`` hold the staging columns of a record, the range it was requested for, ``_gone``
    (there is no title), ``_reason`` (why it can not be staged, null if nothing is known
    against it). Added are its year range, ``_here`` (the range is one of the run), ``_fit``
    (not filtered out) and ``kind``.
    """
    marked = rows.withColumn(_FIT, title_test(keep.wanted))
    if isinstance(keep.services, DataFrame):
        on = f"{_FIT}s"
        marked = mark_on_services(marked, keep.services, on).withColumn(_FIT, F.expr(f"{_FIT} AND {on}")).drop(on)
    elif keep.services is not None:
        marked = marked.withColumn(_FIT, F.col(_FIT) & on_dictionary(keep.services))
    if isinstance(keep.offer_services, DataFrame):
        marked = filter_offers(marked, keep.offer_services)
    elif keep.offer_services is not None:
        marked = marked.withColumn("offers", offers_of(keep.offer_services))
    here = ", ".join(str(i) for i, u in enumerate(units) if u in run) or "-1"
    low, high = range_ends(_UNIT, units)
    return (
        marked.withColumn(_UNIT, requested_year())
        .withColumn(_UNIT, range_number(_UNIT, units))
        .withColumns(
            {
                _REASON: F.expr(f"CASE WHEN NOT {_GONE} AND {_UNIT} IS NULL THEN '{NO_RANGE}' ELSE {_REASON} END"),
                _HERE: F.expr(f"coalesce({_UNIT} IN ({here}), false)"),
                UNIT[0]: low,
                UNIT[1]: high,
            }
        )
        .withColumn(KIND, F.expr(f"CASE WHEN NOT {_GONE} AND {_REASON} IS NULL AND {_FIT} AND {_HERE} THEN '{TITLES}' ELSE '{ASIDE}' END"))
    )


def landed_rows(pages: DataFrame) -> DataFrame:
    """One row per edge of every page, and one for a page without: the title's staging
    columns, and on the first row of a page its facts."""
    unreadable = F.col(BROKEN).isNotNull()
    # An outer explode gives a page without edges one row, its place null.
    nodes = F.when(~unreadable & answered(), F.col("data.popularTitles.edges.node"))
    facts = F.when(~unreadable, F.struct(*page_facts(pages)))
    edges = pages.select(
        *PAGE_RANGE.names, FILE, BROKEN, facts.alias(_PAGE), F.posexplode_outer(nodes).alias(_PLACE, "node")
    )
    reason = F.when(unreadable, NOT_A_PAGE).when(F.col(_PLACE).isNotNull() & F.col("node").isNull(), NO_TITLE)
    about = edges.select(
        "node.*", *PAGE_RANGE.names, FILE, BROKEN, _PLACE,
        F.when(F.coalesce(F.col(_PLACE), F.lit(0)) == 0, F.col(_PAGE)).alias(_PAGE),
        F.col("node").isNull().alias(_GONE), reason.alias(_REASON),
    )
    return flatten(seasons_of_shows(about), whole=(_PAGE,))


_WRITTEN = T.StructType([T.StructField(n, T.StringType()) for n in (FILE, _REASON, _RECORD)] + PAGE_RANGE.fields)


# What becomes of every landed edge, and what else a run wants to know before it goes on.
_COUNTS = {
    "edges": f"{_PLACE} IS NOT NULL",
    "staged": f"{KIND} = '{TITLES}'",
    "filtered": f"{_PLACE} IS NOT NULL AND {_REASON} IS NULL AND {_HERE} AND NOT {_FIT}",
    "outside": f"{_PLACE} IS NOT NULL AND {_REASON} IS NULL AND NOT {_HERE}",
    "refused": f"{_PLACE} IS NOT NULL AND {_REASON} IS NOT NULL",
    "unreadable": f"{BROKEN} IS NOT NULL",
}
_TROUBLED = f"{_PAGE}.errors IS NOT NULL OR NOT {_PAGE}.answered"


def _counted(placed: DataFrame, seen: Observation) -> DataFrame:
    """Counts the rows while they go by."""
    counts = _COUNTS | ({"troubled": _TROUBLED} if _PAGE in placed.columns else {})
    return placed.observe(seen, *[F.expr(f"count_if({test}) AS {name}") for name, test in counts.items()])


def _sheet(placed: DataFrame) -> DataFrame:
    """The rows as they are written: titles, facts of pages, and refused records as text."""
    page = _PAGE if _PAGE in placed.columns else None
    record = f"coalesce({BROKEN}, to_json(struct({', '.join(STAGING.names)})))"
    wanted = f"{KIND} = '{TITLES}' OR {_REASON} IS NOT NULL" + (f" OR {page} IS NOT NULL" if page else "")
    refused = {FILE: FILE, _REASON: _REASON, _RECORD: record, **{n: n for n in PAGE_RANGE.names}}
    return placed.where(wanted).selectExpr(
        *[f"CASE WHEN {KIND} = '{TITLES}' THEN {n} END AS {n}" for n in STAGING.names],
        *([page] if page else []),
        *[f"CASE WHEN {_REASON} IS NOT NULL THEN {value} END AS {n}" for n, value in refused.items()],
        KIND,
        *[f"CASE WHEN {KIND} = '{TITLES}' THEN {n} ELSE 0 END AS {n}" for n in UNIT],
    )


def _refused(spark: SparkSession, folder: str, fmt: str) -> DataFrame:
    rows = spark.read.schema(_WRITTEN).format(fmt).load(f"{folder}/{KIND}={ASIDE}").where(F.col(_REASON).isNotNull())
    return rows.select("min", "max", F.col(FILE).alias("file"), F.col(_REASON).alias("reason"), F.col(_RECORD).alias("record"))


def _staged_rows(spark: SparkSession, folder: str, fmt: str) -> dict[YearRange, int]:
    """Titles in the files of a run, by year range."""
    if not snapshots.exists(spark, f"{folder}/{KIND}={TITLES}"):
        return {}
    schema = T.StructType([T.StructField("id", T.StringType()), *[T.StructField(n, T.IntegerType()) for n in UNIT]])
    rows = spark.read.schema(schema).format(fmt).load(f"{folder}/{KIND}={TITLES}")
    return {(r[0], r[1]): r[2] for r in rows.groupBy(*UNIT).count().collect()}


def _accounted(seen: dict[str, int], landed: int, files: dict[YearRange, int]) -> None:
    """Fails unless every landed edge is where it should be."""
    places = {name: seen[name] for name in ("staged", "filtered", "outside", "refused")}
    if landed != sum(places.values()) or seen["edges"] != landed or sum(files.values()) != seen["staged"]:
        told = ", ".join(f"{n} {name}" for name, n in places.items())
        raise RowsMissing(f"{landed} landed, {told}, {sum(files.values())} in the files")


def stage_pages(
    spark: SparkSession,
    pages_path: str,
    staging_path: str,
    *,
    ranges: Sequence[YearRange] | None = None,
    wanted: TitleFilter = TitleFilter(),
    offer_services: Sequence[str] | DataFrame = (),
    services: DataFrame | None = None,
    multi_line: bool = True,
    complete: bool = True,
    partial: bool = True,
    errors_path: str | None = None,
    fmt: str = "parquet",
    rebalance: bool = False,
    boundaries: Sequence[int] = YEAR_BOUNDARIES,
    broken: str = "fail",
    refresh: bool = False,
) -> tuple[YearRange, ...]:
    """Check the landed pages, then replace their year ranges in the staging table, all in
    one step. Returns the ranges that were replaced.

    Staging is kept in the ranges that ``boundaries`` cut the years into, the first and the
    last one open (see ``marquee.functions.years``), so whatever years were requested, and
    whatever years titles have, there is a place for them. ``ranges`` limits the run to some
    of these. What has no place (no requested range, no title in an edge) is refused: it is
    in the table of ``run_log.read_refused`` with the reason. Landed edges that are neither
    staged nor filtered, outside ``ranges`` or refused fail the run with ``RowsMissing``.

    Files that are as they were at the last run over their range, with the same
    restrictions, are not parsed again, unless files that changed share a staging range with
    them; ``refresh`` parses all. A file counts as unchanged by its path, size and time.

    Nothing changes in staging when a page failed, a range is incomplete (``complete``), or
    a document can not be read: with ``broken="fail"`` the run names such documents and
    their files, with ``"refuse"`` it goes on without them. Either way they are among the
    refused records. ``partial=False`` takes errors beside a result for failures too. All
    errors of all pages are kept in ``errors_path``, by default ``<staging_path>-errors``:
    those of the last run over each requested range.
    """
    if broken not in ("fail", "refuse"):
        raise ValueError("broken is fail or refuse")
    errors_path = errors_path or run_log.errors_path(staging_path)
    for target in (staging_path, errors_path):
        refuse_overlap(pages_path, target)
    units = intervals(boundaries)
    asked = asked_units(ranges, units)
    no_offer_filter = not isinstance(offer_services, DataFrame) and not offer_services
    keep = Restrictions(wanted, _names(services), None if no_offer_filter else _names(offer_services))
    code = keep.fingerprint(units, fmt, multi_line, partial, broken)
    files_path = run_log.files_path(staging_path)
    with scratch_scope(spark):
        # Written at once: what is noted in the end is what was there before the pages were read.
        files = page_files(spark, pages_path)
        listed = run_log.write(files if ranges is None else of_ranges(files, asked), files_path)
        requests = [run_log.request_of(key) for key in listed]
        if not requests:
            raise PagesRejected(f"no page of the wanted year ranges in {pages_path}")
        changed = requests if refresh else _changed(spark, files_path, listed, code)
        # What is whole is judged by all that was landed, also where nothing changed.
        every, partly, missing = landed_units(requests, asked, ranges is not None, staging_units(spark, staging_path))
        need = needed_requests(requests, changed, asked)
        run = {u: years for u, years in every.items() if any(_overlap(r, u) for r in _possible(need))}
        if not need:
            _discard(spark, files_path, listed)
            if complete:
                _reject("incomplete", partly)
                _reject("missing", missing)
            return ()
        pages = of_requests(read_pages(spark, pages_path, multi_line, broken=True), need)
        if keep.joined():
            pages = _parsed_apart(pages)
        seen = Observation()
        placed = placed_rows(landed_rows(pages), keep, units, run)
        name, folders = write_run(_sheet(_counted(placed, seen)), staging_path, fmt, rebalance)
        folder = f"{staging_path.rstrip('/')}/{name}"
        try:
            counts = seen.get
            refused = _refused(spark, folder, fmt) if counts["refused"] + counts["unreadable"] else None
            _note(spark, run_log.refused_path(staging_path), need, refused)
            facts = _facts(pages, folder, fmt)
            _note(spark, errors_path, need, page_errors(facts) if counts["troubled"] else None)
            report = _audited(facts, need, staging_path)
            _require_answers(spark, report, need, errors_path, partial)
            if counts["unreadable"] and broken == "fail":
                _reject_unreadable(spark, staging_path, counts["unreadable"])
            if complete:
                _reject("incomplete", _possible((r["min"], r["max"]) for r in report if not r["complete"]))
                _reject("incomplete", partly)
                _reject("missing", missing)
            rows = _staged_rows(spark, folder, fmt)
            _accounted(counts, sum(r["titles"] for r in report), rows)
            notes = {u: {"requested": years, "rows": rows.get(u, 0)} for u, years in run.items()}
            publish_units(spark, staging_path, folders, tuple(run), notes)
        except BaseException:
            snapshots.delete(spark, folder)
            _discard(spark, files_path, listed)
            raise
        run_log.note(spark, files_path, need, listed, code=code)
    return tuple(run)


def _changed(spark: SparkSession, path: str, listed: dict[str, str], code: str) -> list[Request]:
    """Requested ranges whose files are not those that the last run with these restrictions
    has noted."""
    known = run_log.noted(spark, path, run_log.FILES, code=code)
    files = run_log.read(spark, path, run_log.FILES, listed.values())
    both = files.withColumn("n", F.lit(1)).union(known.withColumn("n", F.lit(-1)))
    differs = both.groupBy(*files.columns).agg(F.sum("n").alias("n")).where("n <> 0").select("min", "max").distinct()
    here = set(map(run_log.request_of, listed))
    return [r for r in map(tuple, differs.collect()) if r in here]


def _discard(spark: SparkSession, path: str, folders: dict[str, str]) -> None:
    for run in {f.split("/", 1)[0] for f in folders.values()}:
        snapshots.delete(spark, f"{path}/{run}")


def _note(spark: SparkSession, path: str, need: Sequence[Request], rows: DataFrame | None) -> None:
    run_log.note(spark, path, need, None if rows is None else run_log.write(rows, path))


def _parsed_apart(pages: DataFrame) -> DataFrame:
    """The pages as a scratch table, where services have to be joined and the rows are
    planned more than once."""
    path = scratch_path(pages.sparkSession, "parsed-pages")
    pages.write.partitionBy("min", "max").parquet(path)
    return pages.sparkSession.read.schema(pages.schema).parquet(path)


def _facts(pages: DataFrame, folder: str, fmt: str) -> DataFrame:
    """The facts of the pages a run has written, read back from its files."""
    kind = pages.select(F.struct(*page_facts(pages)).alias(_PAGE)).schema
    rows = pages.sparkSession.read.schema(kind).format(fmt).load(folder)
    return rows.where(F.col(_PAGE).isNotNull()).select(f"{_PAGE}.*")


def _audited(facts: DataFrame, need: Sequence[Request], staging_path: str) -> list:
    """Keeps the audit slots of the run; what the audit says of each requested range."""
    spark, path = facts.sparkSession, run_log.slots_path(staging_path)
    written_slots = run_log.write(page_slots(facts), path)
    run_log.note(spark, path, need, written_slots)
    audit = audit_slots(run_log.read(spark, path, run_log.SLOTS, written_slots.values()))
    return audit.orderBy("min", "max").collect()


def _require_answers(spark: SparkSession, report: list, need: Sequence[Request], errors_path: str, partial: bool) -> None:
    """Raises if a page failed; with ``partial=False`` also for an error beside a result."""
    errors = of_requests(run_log.read_errors(spark, errors_path), need)
    failed = sum(r["failed"] for r in report)
    beside = 0 if partial else errors.where("answered").count()
    if failed or beside:
        shown = errors.where("NOT answered") if partial else errors
        texts = [row["error_text"] for row in shown.orderBy("min", "max", "page_no", "error_text").limit(_SHOWN).collect()]
        raise PagesRejected(f"{failed} failed page(s), all errors in {errors_path}:\n" + "\n".join(texts))


def _reject(reason: str, ranges: Sequence[YearRange]) -> None:
    if ranges:
        raise PagesRejected(f"{reason} year range(s): {', '.join(map(show, ranges))}")


def _reject_unreadable(spark: SparkSession, staging_path: str, n: int) -> None:
    refused = run_log.read_refused(spark, staging_path).where(F.col("reason").isin(NOT_A_PAGE, NOT_A_TITLE))
    names = [r[0] for r in refused.select("file").distinct().orderBy("file").limit(_SHOWN).collect()]
    raise PagesRejected(f"{n} unreadable document(s), all in {run_log.refused_path(staging_path)}, in:\n" + "\n".join(names))


def audit_with(spark: SparkSession, staging_path: str, late: DataFrame | None = None) -> DataFrame:
    """The audit of all requested ranges as their last runs saw them, and of ``late`` pages
    beside: what was summed up is merged, no page is read again."""
    kept = run_log.noted(spark, run_log.slots_path(staging_path), run_log.SLOTS)
    if late is not None:
        kept = merged_slots(kept, page_slots(late.select(*page_facts(late))))
    return audit_slots(kept)


def stage_legacy(
    spark: SparkSession,
    legacy_path: str,
    staging_path: str,
    rebalance: bool = False,
    boundaries: Sequence[int] = YEAR_BOUNDARIES,
    broken: str = "fail",
) -> tuple[YearRange, ...]:
    """Convert legacy staging files once, so that the jobs read pruned Parquet columns.

    The name of a file tells the year range its titles were requested for; a title of a file
    without a range in its name goes by its own year, and one that has none either is
    refused, as is a record that can not be read. Such records are kept as in
    ``stage_pages``; unreadable ones fail the conversion unless ``broken`` is ``refuse``.
    Ranges without a title in the files stay as staged. Returns the ranges that were
    replaced.
    """
    if broken not in ("fail", "refuse"):
        raise ValueError("broken is fail or refuse")
    refuse_overlap(legacy_path, staging_path)
    units = intervals(boundaries)
    rows = read_concatenated_json(spark, legacy_path, requested=True, broken=True)
    known = rows.withColumns({c: F.coalesce(c, F.col(YEAR)) for c in PAGE_RANGE.names}).select(
        "*",
        F.lit(0).alias(_PLACE),
        F.lit(False).alias(_GONE),
        F.when(F.col(BROKEN).isNotNull(), NOT_A_TITLE).alias(_REASON),
    )
    seen = Observation()
    placed = placed_rows(known, Restrictions(), units, units)
    name, folders = write_run(_sheet(_counted(placed, seen)), staging_path, "parquet", rebalance)
    folder = f"{staging_path.rstrip('/')}/{name}"
    try:
        counts = seen.get
        # Legacy records are noted together: files need not name a requested range.
        nowhere = {c: F.lit(None).cast("int") for c in PAGE_RANGE.names}
        refused = _refused(spark, folder, "parquet").withColumns(nowhere) if counts["refused"] else None
        _note(spark, run_log.refused_path(staging_path), [(None, None)], refused)
        if counts["unreadable"] and broken == "fail":
            _reject_unreadable(spark, staging_path, counts["unreadable"])
        rows_in_files = _staged_rows(spark, folder, "parquet")
        _accounted(counts, counts["edges"], rows_in_files)
        publish_units(spark, staging_path, folders, (), {u: {"rows": n} for u, n in rows_in_files.items()})
    except BaseException:
        snapshots.delete(spark, folder)
        raise
    return tuple(folders)
