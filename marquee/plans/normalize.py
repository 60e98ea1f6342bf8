"""The six table jobs as plain transformations of the staging table.

Each is one projection, at most one explode, and a distinct over all output columns.
Distinct is a partial and a final hash aggregate around one exchange on all columns, so
copies collapse on the map side and no single key decides where rows go. The Parquet scan
reads just the nested fields that are projected.

Because every output is a set of full rows, the result does not depend on how a title's
arrays are spread over staging records.

Rows of the four tables with a title id can only repeat if a title has several records, or one
of its offers comes twice. ``without_repeats`` looks for that in the ids alone; where there is
none, ``once`` leaves out the exchange of all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee import schemas
from marquee.schemas import TableContract


# Column of the title facts, and the staging column it is taken from.
FACTS = {
    "title_id": "id",
    "object_type": "objectType",
    "title": "content_title",
    "short_description": "content_shortDescription",
    "release_year": "content_originalReleaseYear",
    "age_dertification": "content_ageCertification",
    "runtime": "content_runtime",
    "full_path": "content_fullPath",
    "imdb_score": "content_scoring_imdbScore",
    "imdb_votes": "content_scoring_imdbVotes",
    "tmdb_popolarity": "content_scoring_tmdbPopularity",
    "tmbd_score": "content_scoring_tmdbScore",
    "season_count": "totalSeasonCount",
}


def titles(staging: DataFrame, once: bool = False) -> DataFrame:
    """Title facts. Missing numbers become 0 before the distinct, so titles that differ
    only in null against 0 are one row."""
    facts = staging.select([F.col(source).alias(name) for name, source in FACTS.items()])
    rows = schemas.FCT_TITLES.conform(facts).na.fill(0)
    return rows if once else rows.dropDuplicates()


def genres(staging: DataFrame) -> DataFrame:
    """Distinct (id, name). One id with two names gives two rows."""
    rows = staging.select(F.explode("content_genres").alias("genre")).select(
        F.col("genre.id").alias("genre_id"), F.col("genre.translation").alias("name")
    )
    return schemas.DIM_GENRES.conform(rows).dropDuplicates()


def streaming_services(staging: DataFrame) -> DataFrame:
    rows = staging.select(F.explode("offers.package").alias("package")).select(
        F.col("package.packageId").alias("streaming_service_id"),
        F.col("package.clearName").alias("clear_name"),
        F.col("package.slug").alias("slug"),
        F.col("package.icon").alias("icon"),
    )
    return schemas.DIM_STREAMING_SERVICES.conform(rows).dropDuplicates()


def titles_genres(staging: DataFrame, once: bool = False) -> DataFrame:
    rows = staging.select(
        F.col("id").alias("title_id"), F.explode(F.array_distinct("content_genres.id")).alias("genre_id")
    )
    rows = schemas.DIM_TITLES_GENRES.conform(rows)
    return rows if once else rows.dropDuplicates()


def titles_production_countries(staging: DataFrame, once: bool = False) -> DataFrame:
    rows = staging.select(
        F.col("id").alias("title_id"),
        F.explode(F.array_distinct("content_productionCountries")).alias("country_code"),
    )
    rows = schemas.DIM_TITLES_PRODUCTION_COUNTRIES.conform(rows)
    return rows if once else rows.dropDuplicates()


def titles_streaming_services(staging: DataFrame, once: bool = False) -> DataFrame:
    # Spark prunes an exploded struct array to one field at most. Zipping the three leaves
    # that are needed keeps the other fields of the package out of the scan.
    leaves = F.arrays_zip("offers.id", "offers.standardWebURL", "offers.package.packageId")
    rows = staging.select(F.col("id").alias("title_id"), F.explode(leaves).alias("offer")).select(
        F.col("offer.id").alias("title_streaming_service_id"),
        F.col("offer.standardWebURL").alias("standard_web_url"),
        "title_id",
        F.col("offer.packageId").alias("streaming_service_id"),
    )
    rows = schemas.DIM_TITLES_STREAMING_SERVICES.conform(rows)
    return rows if once else rows.dropDuplicates()


# Jobs whose rows hold the title's id.
OF_TITLES = (titles, titles_genres, titles_production_countries, titles_streaming_services)


def without_repeats(staging: DataFrame) -> list[Callable[..., DataFrame]]:
    """The jobs of ``OF_TITLES`` whose rows can not repeat: all if every title has one record,
    but that of the offers only if those of no title are alike. Offers with one hash count as
    alike; then there is an exchange too many, nothing else."""
    offers = F.arrays_zip("offers.id", "offers.standardWebURL", "offers.package.packageId")
    hashes = F.transform(offers, lambda o: F.xxhash64(o["id"], o["standardWebURL"], o["packageId"]))
    alike = F.coalesce(F.size(F.array_distinct(hashes)) < F.size(hashes), F.lit(False))
    titles_found = staging.select("id", alike.alias("alike")).groupBy("id")
    counted = titles_found.agg(F.count("*").alias("records"), F.bool_or("alike").alias("alike"))
    several, twice = counted.agg(F.bool_or(F.col("records") > 1), F.bool_or("alike")).first()
    if several:
        return []
    return [job for job in OF_TITLES if not (twice and job is titles_streaming_services)]
JOBS: tuple[tuple[TableContract, Callable[[DataFrame], DataFrame]], ...] = (
    (schemas.FCT_TITLES, titles),
    (schemas.DIM_GENRES, genres),
    (schemas.DIM_STREAMING_SERVICES, streaming_services),
    (schemas.DIM_TITLES_GENRES, titles_genres),
    (schemas.DIM_TITLES_PRODUCTION_COUNTRIES, titles_production_countries),
    (schemas.DIM_TITLES_STREAMING_SERVICES, titles_streaming_services),
)
