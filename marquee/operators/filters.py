"""Title and offer filters, and the release-year clustering.

An empty tuple means "no restriction". Services are matched by clear name: the short
service code is not part of a fetched offer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.constants import SELECTED_SERVICES
from marquee.functions import intervals, range_bounds, year_ranges
from marquee.functions.years import YearRange, range_ends, range_number
from marquee.session import written

YEAR = "content_originalReleaseYear"
GENRE_IDS = "content_genres.id"
COUNTRIES = "content_productionCountries"
SERVICE_NAMES = "offers.package.clearName"
# Number of a record among those of one title, from 0; only where titles are spread.
PART = "part"
# Names of services that are looked up inside a row; a longer list is joined.
MOST_NAMES = 10_000
_ROW, _HIT, _PLACE, _KEPT, _NAME = "_row", "_hit", "_place", "_kept", "_service"


@dataclass(frozen=True)
class TitleFilter:
    """Restrictions on titles; all given ones must hold."""

    years: YearRange | tuple[()] = ()
    services: tuple[str, ...] = ()
    genres: tuple[str, ...] = ()
    exclude_genres: tuple[str, ...] = ()
    countries: tuple[str, ...] = ()
    exclude_countries: tuple[str, ...] = ()
    object_types: tuple[str, ...] = ()
    age_certifications: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for field in fields(self):
            value = getattr(self, field.name)
            if isinstance(value, str):
                raise TypeError(f"{field.name} takes a sequence of values, not one string")
            object.__setattr__(self, field.name, tuple(value))
        if self.years and (len(self.years) != 2 or self.years[0] > self.years[1]):
            raise ValueError("years takes a first and a last year")


def selected_names(services: Sequence[tuple[str, str]] = SELECTED_SERVICES) -> tuple[str, ...]:
    return tuple(name for _, name in services)


def _any_of(array: str, values: Sequence[str]) -> Column:
    # A dotted path through an array of structs reads one leaf of it, unlike a lambda,
    # which reads the whole struct.
    return F.arrays_overlap(F.col(array), F.array(*[F.lit(v) for v in values]))


def _none_of(array: str, values: Sequence[str]) -> Column:
    # A null array, or one with null elements and no hit, overlaps to null: keep the title.
    return ~F.coalesce(_any_of(array, values), F.lit(False))


def _tests(wanted: TitleFilter) -> list[Column]:
    tests: list[Column] = []
    if wanted.years:
        low, high = wanted.years
        tests.append(F.col(YEAR).between(low, high))
    if wanted.object_types:
        tests.append(F.col("objectType").isin(*wanted.object_types))
    if wanted.age_certifications:
        tests.append(F.col("content_ageCertification").isin(*wanted.age_certifications))
    if wanted.services:
        tests.append(_any_of(SERVICE_NAMES, wanted.services))
    if wanted.genres:
        tests.append(_any_of(GENRE_IDS, wanted.genres))
    if wanted.exclude_genres:
        tests.append(_none_of(GENRE_IDS, wanted.exclude_genres))
    if wanted.countries:
        tests.append(_any_of(COUNTRIES, wanted.countries))
    if wanted.exclude_countries:
        tests.append(_none_of(COUNTRIES, wanted.exclude_countries))
    return tests


def title_test(wanted: TitleFilter) -> Column:
    """Whether a staging title satisfies every restriction; never null."""
    return F.coalesce(reduce(and_, _tests(wanted), F.lit(True)), F.lit(False))


def filter_titles(df: DataFrame, wanted: TitleFilter) -> DataFrame:
    """Staging titles that satisfy every restriction.

    All predicates look at one row, so nothing is shuffled. The year restriction is on the
    title's own year: a title may be staged under another range than its year, so partitions
    are only skipped by ``of_staging_ranges``.
    """
    for test in _tests(wanted):
        df = df.where(test)
    return df


def of_staging_ranges(df: DataFrame, ranges: Sequence[YearRange]) -> DataFrame:
    """Titles staged under one of ``ranges``, whatever their own year; other partitions are
    not read."""
    wanted = F.lit(False)
    for low, high in ranges:
        wanted = wanted | ((F.col("year_min") == low) & (F.col("year_max") == high))
    return df.where(wanted)


def service_dictionary(
    services: DataFrame, titles: DataFrame | None = None, most: int = MOST_NAMES
) -> tuple[str, ...] | None:
    """The distinct clear names of ``services(clear_name)`` if they are ``most`` at most.

    Of a longer table only the names that offers of ``titles`` carry matter: those are looked
    up, in one pass over that leaf alone. If they too are more, there is no dictionary. At
    most ``most`` + 1 names reach the driver.
    """
    names = services.select(F.col("clear_name").alias(_NAME)).where(F.col(_NAME).isNotNull()).distinct()
    rows = names.limit(most + 1).collect()
    if len(rows) > most and titles is not None:
        carried = titles.select(F.explode(SERVICE_NAMES).alias(_NAME)).distinct()
        rows = names.join(carried, _NAME, "left_semi").limit(most + 1).collect()
    return tuple(sorted(r[0] for r in rows)) if len(rows) <= most else None


def on_dictionary(names: Sequence[str]) -> Column:
    """Whether a title has an offer of one of the named services; never null. The names are
    hashed once, and each offer's name is looked up."""
    if not names:
        return F.lit(False)
    return F.coalesce(F.exists(SERVICE_NAMES, lambda name: name.isin(*names)), F.lit(False))


def _numbered(df: DataFrame) -> DataFrame:
    """The rows with their number, written once: whatever made them is not run again."""
    return written(df.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")


def mark_on_services(df: DataFrame, services: DataFrame, mark: str, most: int = MOST_NAMES) -> DataFrame:
    """Adds ``mark``: whether a record has an offer of a service in the table.

    With a dictionary of its names the test is made in the row: one scan, no join. Without,
    rows are numbered and written once, their names travel to the services, and the numbers
    that hit are joined back; Spark broadcasts them if their size allows.
    """
    names = service_dictionary(services, most=most)
    if names is not None:
        return df.withColumn(mark, on_dictionary(names))
    numbered = _numbered(df)
    names = service_dictionary(services, numbered, most)
    if names is not None:
        return numbered.withColumn(mark, on_dictionary(names)).select(*df.columns, mark)
    hits = (
        numbered.select(F.col(_ROW).alias(_HIT), F.explode(SERVICE_NAMES).alias("clear_name"))
        .join(services.select("clear_name"), "clear_name", "left_semi")
        .select(_HIT)
        .distinct()
    )
    joined = numbered.join(hits, F.col(_ROW) == F.col(_HIT), "left")
    return joined.withColumn(mark, F.col(_HIT).isNotNull()).select(*df.columns, mark)


def titles_on_services(df: DataFrame, services: DataFrame, whole: bool = False, most: int = MOST_NAMES) -> DataFrame:
    """Titles with an offer of a service in ``services(clear_name)``, a table of any size.

    Like the restriction to a list of services this looks at one record at a time. With
    ``whole`` a title that is spread over several records is kept whole if any of them hits;
    that joins the ids that hit back to the titles.
    """
    marked = mark_on_services(df, services, _KEPT, most)
    if not whole:
        return marked.where(_KEPT).drop(_KEPT)
    return df.join(marked.where(_KEPT).select("id").distinct(), "id", "left_semi")


def filter_offers(df: DataFrame, services: Sequence[str] | DataFrame, most: int = MOST_NAMES) -> DataFrame:
    """Keep only offers of the given services inside each title; the title itself stays.

    Names are tested inside the row, those of a table ``services(clear_name)`` too if there
    is a dictionary of them. Beyond that the table is joined: rows are numbered and written
    once, only names travel to the services, and the places that hit back to the number of
    their row, and an array keeps its order. A null array stays null.
    """
    if not isinstance(services, DataFrame):
        return df.withColumn("offers", offers_of(services)) if services else df
    names = service_dictionary(services, most=most)
    if names is not None:
        return df.withColumn("offers", offers_of(names))
    numbered = _numbered(df)
    names = service_dictionary(services, numbered, most)
    if names is not None:
        return numbered.withColumn("offers", offers_of(names)).select(*df.columns)
    return _offers_on_service_table(numbered, services).select(*df.columns)


def offers_of(names: Sequence[str]) -> Column:
    """The offers of the named services; a null array stays null."""
    if not names:
        return F.slice("offers", 1, 0)
    return F.filter("offers", lambda offer: offer["package"]["clearName"].isin(*names))


def _offers_on_service_table(numbered: DataFrame, services: DataFrame) -> DataFrame:
    names = services.select(F.col("clear_name").alias(_NAME)).where(F.col(_NAME).isNotNull()).distinct()
    kept = (
        numbered.select(_ROW, F.posexplode(SERVICE_NAMES).alias(_PLACE, _NAME))
        .join(names, _NAME, "left_semi")
        .groupBy(F.col(_ROW).alias(_HIT))
        .agg(F.sort_array(F.collect_list(_PLACE)).alias(_KEPT))
    )
    hits = F.transform(_KEPT, lambda place: F.get("offers", place))
    offers = F.when(F.col("offers").isNotNull(), F.coalesce(hits, F.slice("offers", 1, 0)))
    return numbered.join(kept, F.col(_ROW) == F.col(_HIT), "left").withColumn("offers", offers)


def requested_year(year: str = YEAR) -> Column:
    """The year by which a title that was requested for ``min`` to ``max`` is staged.

    A title belongs where it was asked for, whatever its own year says. Only a request that
    spans several ranges needs the year to tell them apart: it counts as moved into the
    request, a null year as the request's first. Null without a possible request.
    """
    moved = f"coalesce(least(greatest(`{year}`, `min`), `max`), `min`)"
    return F.expr(f"CASE WHEN `min` <= `max` THEN {moved} END")


def assign_requested_range(
    df: DataFrame, year: str = YEAR, ranges: Sequence[YearRange] | None = None
) -> DataFrame:
    """Replace the requested ``min`` and ``max`` by the staging range they belong to, among
    ``ranges``, by default all years cut at the fixed boundaries. A title that belongs to
    none of them gets null: nothing is left out here."""
    ranges = intervals() if ranges is None else ranges
    placed = df.withColumn(_PLACE, requested_year(year)).withColumn(_PLACE, range_number(_PLACE, ranges))
    low, high = range_ends(_PLACE, ranges)
    return placed.select(*df.columns, low.alias("year_min"), high.alias("year_max")).drop("min", "max")


def per_title(df: DataFrame) -> DataFrame:
    """One record per title: the first of those that a title with very many offers is
    spread over. Frames without a part number hold whole titles."""
    return df.where(F.col(PART) == 0) if PART in df.columns else df


def assign_year_range(
    df: DataFrame, year: str = YEAR, ranges: Sequence[YearRange] | None = None
) -> DataFrame:
    """Add ``year_min`` and ``year_max``; years outside every range drop out.

    The plain bounds on the year column are redundant for the result but reach the
    Parquet scan, which a CASE expression cannot.
    """
    ranges = year_ranges() if ranges is None else tuple(ranges)
    low, high = range_bounds(F.col(year), ranges)
    return (
        df.where(F.col(year).between(min(r[0] for r in ranges), max(r[1] for r in ranges)))
        .select("*", low.alias("year_min"), high.alias("year_max"))
        .where(F.col("year_min").isNotNull())
    )


def count_per_range(df: DataFrame) -> DataFrame:
    """Number of titles per year range: the total a complete set of pages must reach."""
    return per_title(df).groupBy("year_min", "year_max").agg(F.count("*").alias("title_count"))
