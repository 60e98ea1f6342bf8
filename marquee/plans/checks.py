"""Every operator as a query over the flat tables, with the same answer in plain SQL.

The Spark side goes through nested titles, pages, staging files or published tables. The
SQL side goes over the flat tables only, so both reach the answer by different routes.
Queries that check a reader or a writer put their files below the shared folder of the
session (see ``marquee.session``) and read them back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.adapters.order_tables import (
    landed_pages,
    nested_titles,
    order_responses,
    staging_titles,
)
from marquee.functions import year_ranges
from marquee.operators import filters, pages, ranking
from marquee.operators.filters import TitleFilter
from marquee.operators.flatten import flatten, seasons_of_shows
from marquee.plans import normalize
from marquee.plans.publish import run_all, run_jobs
from marquee.plans.run_log import errors_path, read_errors
from marquee.plans.stage import PagesRejected, audit_with, stage_pages
from marquee.schemas import DIM_COUNTRIES, STAGING, TITLE_TABLES
from marquee.session import scratch_path, unsorted_writes, written
from marquee.sinks import (
    create_country_table,
    create_database,
    load_countries,
    register_staging,
    register_tables,
    write_staging,
    write_table,
)
from marquee.sources import (
    read_concatenated_json,
    read_service_catalogue,
    read_service_selection,
    read_staging,
    services_by_code,
)

Query = Callable[[SparkSession, str], DataFrame]

# Parts of a title each table job reads.
NEEDS = {
    "fct_titles": ("seasons",),
    "dim_genres": ("genres",),
    "dim_streaming_services": ("offers",),
    "dim_titles_genres": ("genres",),
    "dim_titles_production_countries": ("countries",),
    "dim_titles_streaming_services": ("offers",),
}
SERVICES = tuple(f"Supplier#{n:09d}" for n in (1, 3, 5, 7))
CODES = ("s1", "s3", "s5", "s7")
GENRES = ("PROMO", "ECONOMY")
COUNTRIES = ("NATION_3", "NATION_20")
REPLACED = (1991, 2000)
ASKED_FROM, ASKED_YEARS = 1900, 124
BEYOND_FROM, BEYOND_SPAN, BEYOND_SPANS = 1875, 5, 40
SCALARS = (
    "id",
    "objectType",
    "content_title",
    "content_shortDescription",
    "content_originalReleaseYear",
    "content_ageCertification",
    "content_runtime",
    "content_fullPath",
    "content_scoring_imdbScore",
    "content_scoring_imdbVotes",
    "content_scoring_tmdbPopularity",
    "content_scoring_tmdbScore",
    "totalSeasonCount",
)
# Landed text repeats its field names in every record: packed it is a tenth.
LANDED = "gzip"
TITLE = ("id", "content_title", "content_originalReleaseYear")


def _job(name: str) -> Query:
    job = {contract.name: job for contract, job in normalize.JOBS}[name]
    return lambda spark, sf_dir: job(staging_titles(spark, sf_dir, NEEDS[name]))


def _filtered(needs: tuple[str, ...], wanted: TitleFilter) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        titles = filters.filter_titles(staging_titles(spark, sf_dir, needs), wanted).select(*TITLE)
        # Only offers can be spread over several records of a title.
        return titles.distinct() if "offers" in needs else titles

    return query


def _text(array: str, element) -> Column:
    """An array as sorted text; a missing array reads ``-``."""
    elements = F.array_sort(F.transform(array, element))
    return F.coalesce(F.array_join(elements, ","), F.lit("-"))


def _whole(titles: DataFrame, *more: str) -> DataFrame:
    """Every staging column, arrays as text."""
    return titles.select(
        *SCALARS,
        *more,
        _text("content_genres", lambda g: F.concat_ws("/", g["id"], g["translation"])).alias("genres"),
        _text("content_productionCountries", lambda c: c).alias("countries"),
        _text(
            "offers",
            lambda o: F.concat_ws(
                "|", o["id"], o["standardWebURL"], o["package"]["packageId"],
                o["package"]["clearName"], o["package"]["slug"], o["package"]["icon"],
            ),
        ).alias("offer_texts"),
    )


def _flatten_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole(flatten(seasons_of_shows(nested_titles(spark, sf_dir))))


def _unwrap_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = flatten(seasons_of_shows(pages.unwrap_edges(landed_pages(spark, sf_dir))))
    return _whole(titles, "min", "max")


def _titles_by_year_range(fields: tuple[str, ...]) -> Query:
    return lambda spark, sf_dir: filters.count_per_range(
        filters.assign_year_range(staging_titles(spark, sf_dir, fields))
    )


def _titles_on_service_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    services = _service_selection_scan(spark, sf_dir, "s_nationkey < 10")
    titles = staging_titles(spark, sf_dir, ("offers",))
    return filters.titles_on_services(titles, services).select(*TITLE).distinct()


def _offers_on_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = filters.filter_offers(staging_titles(spark, sf_dir, ("offers",)), SERVICES)
    return normalize.titles_streaming_services(titles)


def _offers_on_service_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    services = _service_selection_scan(spark, sf_dir, "s_nationkey < 10")
    titles = filters.filter_offers(staging_titles(spark, sf_dir, ("offers",)), services)
    return normalize.titles_streaming_services(titles)


def _popular(spark: SparkSession, sf_dir: str, fields: tuple[str, ...] = ()) -> DataFrame:
    titles = staging_titles(spark, sf_dir, fields)
    return titles.select(
        "id", "content_title", ranking.POPULARITY, filters.YEAR,
        *[c for c in ("offers", filters.PART) if c in titles.columns],
    )


def _popular_first_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.first_page(_popular(spark, sf_dir))


def _popular_first_page_with_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.first_page(_popular(spark, sf_dir, ("offers",))).drop("offers", filters.PART)


def _popular_next_page_with_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = _popular(spark, sf_dir, ("offers",))
    after = ranking.end_cursor(ranking.first_page(titles))
    return ranking.next_page(titles, after).drop("offers", filters.PART)


def _popular_page_numbers_with_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = filters.assign_year_range(_popular(spark, sf_dir, ("offers",)))
    return ranking.number_pages(titles).select("id", "year_min", "year_max", "rank", "page_no")


def _popular_next_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = _popular(spark, sf_dir)
    return ranking.next_page(titles, ranking.end_cursor(ranking.first_page(titles)))


def _popular_page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = filters.assign_year_range(_popular(spark, sf_dir))
    return ranking.number_pages(titles).select("id", "year_min", "year_max", "rank", "page_no")


def _stage(spark: SparkSession, sf_dir: str, needs: tuple[str, ...], fmt: str) -> str:
    path = scratch_path(spark, "staging")
    write_staging(
        filters.assign_year_range(staging_titles(spark, sf_dir, needs)), path, fmt, year_ranges()
    )
    return path


def _union_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges read one by one from the staging table; each reads its own directory only."""
    staging = read_staging(spark, _stage(spark, sf_dir, ("seasons",), "parquet"))
    parts = [filters.of_staging_ranges(staging, [years]) for years in year_ranges()]
    return pages.union_all(parts).select(*SCALARS, "year_min", "year_max")


def _staging_round_trip(fmt: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "staging")
        titles = filters.assign_year_range(staging_titles(spark, sf_dir, max_offers=None))
        write_staging(titles, path, fmt, year_ranges())
        return _whole(read_staging(spark, path, fmt), "year_min", "year_max")

    return query


def _staging_range_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged once whole, then one year range again with shows only."""
    path = _stage(spark, sf_dir, ("seasons",), "parquet")
    titles = filters.assign_year_range(staging_titles(spark, sf_dir, ("seasons",)), ranges=[REPLACED])
    shows = filters.filter_titles(titles, TitleFilter(object_types=("SHOW",)))
    write_staging(shows, path, ranges=[REPLACED])
    return read_staging(spark, path).select(*SCALARS, "year_min", "year_max")


def _legacy_staging_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging records as indented objects in text files, read back."""
    record = F.to_json(F.struct(*STAGING.names))
    fields = F.substring(record, 2, 1_000_000_000)
    body = F.concat(F.lit("    {\n        "), F.regexp_replace(fields, r"\}$", "\n    }\n"))
    path = scratch_path(spark, "legacy")
    titles = staging_titles(spark, sf_dir, max_offers=None)
    titles.select(body.alias("value")).write.text(path, compression=LANDED)
    return _whole(read_concatenated_json(spark, path))


def _staging_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging as a catalogue table, read by name by a table job."""
    path = _stage(spark, sf_dir, ("genres",), "parquet")
    db = scratch_path(spark, "catalogue").rsplit("/", 1)[1].replace("-", "_")
    create_database(spark, db, f"{path}-{db}")
    return normalize.titles_genres(read_staging(spark, register_staging(spark, db, path), "table"))


def _land(pages: DataFrame, path: str) -> None:
    """Pages as a crawler lands them, a document per line. Every task writes a file for each
    requested range, so that no packed file outgrows the task that wrote it."""
    with unsorted_writes(pages.sparkSession):
        pages.write.partitionBy("min", "max").json(path, compression=LANDED)


def _requested_range_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages requested for years that have nothing to do with the titles' own: every title
    is staged, and under the range it was requested for."""
    landed, staged = scratch_path(spark, "pages"), scratch_path(spark, "staging")
    asked = (F.substring("id", 3, 20).cast("bigint") % ASKED_YEARS + ASKED_FROM).cast("int")
    _land(landed_pages(spark, sf_dir, by=asked), landed)
    stage_pages(spark, landed, staged, multi_line=False)
    return _whole(read_staging(spark, staged), "year_min", "year_max")


def _requested_beyond_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages requested for spans of ``BEYOND_SPAN`` years from the nineteenth century to the
    middle of the next, across all staging ranges and beyond the last; every seventh title
    has no year. Whole staging rows: every landed title is in one staging range."""
    landed, staged = scratch_path(spark, "pages"), scratch_path(spark, "staging")
    first = (F.col("key") % BEYOND_SPANS * BEYOND_SPAN + BEYOND_FROM).cast("int")
    no_year = F.col("key") % 7 == 0
    _land(landed_pages(spark, sf_dir, asked=(first, first + BEYOND_SPAN - 1), no_year=no_year), landed)
    stage_pages(spark, landed, staged, multi_line=False)
    return _whole(read_staging(spark, staged), "year_min", "year_max")


def _late_pages_audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged without the second page of every range, then audited with it: the slots kept
    from the run and those of the late pages, no page read again."""
    landed, staged = scratch_path(spark, "pages"), scratch_path(spark, "staging")
    pages = written(landed_pages(spark, sf_dir, ()), "all-pages")
    _land(pages.where("page_no <> 2"), landed)
    stage_pages(spark, landed, staged, multi_line=False, complete=False)
    return audit_with(spark, staged, pages.where("page_no = 2"))


def _staged_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged twice, in between one range's pages landed anew with shows only: the second
    run parses that range alone and leaves the others as they were."""
    landed, staged = scratch_path(spark, "pages"), scratch_path(spark, "staging")
    fields = ("seasons",)
    _land(landed_pages(spark, sf_dir, fields), landed)
    stage_pages(spark, landed, staged, multi_line=False)
    low, high = REPLACED
    shows = landed_pages(spark, sf_dir, fields, where=F.col("objectType") == "SHOW").where(F.col("min") == low)
    shows.drop("min", "max").write.mode("overwrite").json(f"{landed}/min={low}/max={high}", compression=LANDED)
    stage_pages(spark, landed, staged, multi_line=False)
    return read_staging(spark, staged).select(*SCALARS, "year_min", "year_max")


def _errors_of_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing responses in two ranges, run one after the other: the errors of both runs."""
    landed, staged = scratch_path(spark, "pages"), scratch_path(spark, "staging")
    pages = order_responses(spark, sf_dir).withColumn("min", F.when(F.col("page_no") % 2 == 0, 1991).otherwise(2001))
    _land(pages.withColumn("max", F.col("min") + 9), landed)
    for years in ((1991, 2000), (2001, 2010)):
        try:
            stage_pages(spark, landed, staged, multi_line=False, ranges=[years])
        except PagesRejected:
            continue
    return read_errors(spark, errors_path(staged))


def _republished_at_new_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published at one root from shows only, then at another from all titles."""
    titles = staging_titles(spark, sf_dir, ("genres",))
    shows = filters.filter_titles(titles, TitleFilter(object_types=("SHOW",)))
    contract = next(c for c in TITLE_TABLES if c.name == "dim_titles_genres")
    db = scratch_path(spark, "republished").rsplit("/", 1)[1].replace("-", "_")
    create_database(spark, db, scratch_path(spark, "warehouse"))
    for rows in (shows, titles):
        root = scratch_path(spark, "root")
        write_table(normalize.titles_genres(rows), contract, root)
        register_tables(spark, db, root, (contract,))
        spark.table(f"{db}.{contract.name}").count()
    return spark.table(f"{db}.{contract.name}")


def _pages_to_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed, staged = scratch_path(spark, "pages"), scratch_path(spark, "staging")
    _land(landed_pages(spark, sf_dir), landed)
    stage_pages(
        spark, landed, staged, offer_services=SERVICES, multi_line=False,
        wanted=TitleFilter(services=SERVICES),
    )
    return normalize.titles_streaming_services(read_staging(spark, staged))


def _page_completeness(fields: tuple[str, ...]) -> Query:
    return lambda spark, sf_dir: pages.audit_pages(landed_pages(spark, sf_dir, fields))


def _page_chain_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page 2 of every range was asked for with a wrong cursor."""
    wrong = F.when(F.col("page_no") == 2, F.lit("wrong")).otherwise(F.col("cursor_sent"))
    return pages.audit_pages(landed_pages(spark, sf_dir, ()).withColumn("cursor_sent", wrong))


def _page_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_errors(order_responses(spark, sf_dir))


def _service_selection_scan(
    spark: SparkSession, sf_dir: str, which: str = "true"
) -> DataFrame:
    path = scratch_path(spark, "selection")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").where(which)
    suppliers.select(
        F.concat(F.lit("s"), "s_suppkey").alias("code"), F.col("s_name").alias("clear_name")
    ).write.json(path)
    return read_service_selection(spark, path)


def _service_catalogue_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "catalogue")
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    suppliers.select(
        F.concat(F.lit("s"), "s_suppkey").alias("code"),
        F.col("s_name").alias("streaming_name"),
        F.lower("s_name").alias("lcase_name"),
    ).write.option("header", True).csv(path)
    return read_service_catalogue(spark, path)


def _services_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return services_by_code(_service_catalogue_scan(spark, sf_dir), CODES)


def _countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.col("n_name").alias("name"),
        F.concat(F.lit("N"), "n_nationkey").alias("alpha2_code"),
        F.concat(F.lit("NN"), "n_nationkey").alias("alpha3_code"),
    )


def _country_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = scratch_path(spark, "warehouse")
    db = place.rsplit("/", 1)[1].replace("-", "_")
    create_database(spark, db, place)
    table = create_country_table(spark, db)
    load_countries(spark, _countries(spark, sf_dir), db)
    return spark.table(table).select(*DIM_COUNTRIES.columns)


def _published(name: str) -> Query:
    """The table job run to its end: staged, written, registered, read by name."""
    contract = next(c for c in TITLE_TABLES if c.name == name)

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staging = _stage(spark, sf_dir, NEEDS[name], "parquet")
        root = scratch_path(spark, "published")
        db = root.rsplit("/", 1)[1].replace("-", "_")
        run_jobs(spark, staging, root, only=(name,))
        create_database(spark, db, f"{root}/{db}")
        register_tables(spark, db, root, (contract,))
        return spark.table(f"{db}.{name}")

    return query


def _whole_run(name: str) -> Query:
    """Pages to staging to all tables to the catalogue; one table read by name."""
    return lambda spark, sf_dir: spark.table(f"{_run_database(spark, sf_dir)}.{name}")


def _run_database(spark: SparkSession, sf_dir: str) -> str:
    landed, staged = scratch_path(spark, "pages"), scratch_path(spark, "staging")
    root = scratch_path(spark, "run")
    db = root.rsplit("/", 1)[1].replace("-", "_")
    _land(landed_pages(spark, sf_dir), landed)
    countries = _countries(spark, sf_dir)
    run_all(spark, landed, staged, root, db, countries, f"{root}/{db}", multi_line=False)
    return db


QUERIES: dict[str, Query] = {
    **{name: _job(name) for name in NEEDS},
    "flatten_titles": _flatten_titles,
    "unwrap_edges": _unwrap_edges,
    "titles_by_year_range": _titles_by_year_range(()),
    "titles_by_year_range_with_offers": _titles_by_year_range(("offers",)),
    "titles_in_years": _filtered((), TitleFilter(years=(1996, 1998))),
    "titles_on_services": _filtered(("offers",), TitleFilter(services=SERVICES)),
    "titles_on_service_table": _titles_on_service_table,
    "offers_on_services": _offers_on_services,
    "offers_on_service_table": _offers_on_service_table,
    "titles_genre_any": _filtered(("genres",), TitleFilter(genres=GENRES)),
    "titles_genre_none": _filtered(("genres",), TitleFilter(exclude_genres=GENRES)),
    "titles_country_any": _filtered(("countries",), TitleFilter(countries=COUNTRIES)),
    "titles_country_none": _filtered(("countries",), TitleFilter(exclude_countries=COUNTRIES)),
    "titles_type_cert": _filtered(
        (), TitleFilter(object_types=("SHOW",), age_certifications=("1-URGENT", "2-HIGH"))
    ),
    "popular_first_page": _popular_first_page,
    "popular_next_page": _popular_next_page,
    "popular_page_numbers": _popular_page_numbers,
    "popular_first_page_with_offers": _popular_first_page_with_offers,
    "popular_next_page_with_offers": _popular_next_page_with_offers,
    "popular_page_numbers_with_offers": _popular_page_numbers_with_offers,
    "union_ranges": _union_ranges,
    "staging_parquet_round_trip": _staging_round_trip("parquet"),
    "staging_json_round_trip": _staging_round_trip("json"),
    "staging_range_replaced": _staging_range_replaced,
    "legacy_staging_scan": _legacy_staging_scan,
    "staging_table_scan": _staging_table_scan,
    "requested_range_kept": _requested_range_kept,
    "requested_beyond_ranges": _requested_beyond_ranges,
    "late_pages_audited": _late_pages_audited,
    "staged_again": _staged_again,
    "errors_of_two_runs": _errors_of_two_runs,
    "republished_at_new_root": _republished_at_new_root,
    "pages_to_staging": _pages_to_staging,
    "page_completeness": _page_completeness(()),
    "page_completeness_with_offers": _page_completeness(("offers",)),
    "page_chain_broken": _page_chain_broken,
    "page_error_rows": _page_error_rows,
    "service_selection_scan": _service_selection_scan,
    "service_catalogue_scan": _service_catalogue_scan,
    "services_by_code": _services_by_code,
    "country_table_scan": _country_table_scan,
    **{f"published_{name}": _published(name) for name in NEEDS},
    **{f"whole_run_{name}": _whole_run(name) for name in (*NEEDS, "dim_countries")},
}
