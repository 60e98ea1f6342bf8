"""The answers of ``marquee.plans.checks`` in plain SQL over the flat tables."""

from __future__ import annotations

from marquee.constants import FLAG_PATTERN, PAGE_SIZE
from marquee.functions import intervals, year_ranges
from marquee.plans.checks import ASKED_FROM, ASKED_YEARS, BEYOND_FROM, BEYOND_SPAN, BEYOND_SPANS, CODES, COUNTRIES, GENRES, NEEDS, REPLACED, SERVICES


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _case(end: int, year: str = "year(o_orderdate)", ranges=year_ranges()) -> str:
    arms = " ".join(
        f"WHEN {year} BETWEEN {r[0]} AND {r[1]} THEN {r[end]}" for r in ranges
    )
    return f"CAST(CASE {arms} END AS INTEGER)"


ASKED = f"(o_orderkey % {ASKED_YEARS} + {ASKED_FROM})"
# The span a title was requested for, its own year if it has one, and that moved into the span.
BEYOND = f"(o_orderkey % {BEYOND_SPANS} * {BEYOND_SPAN} + {BEYOND_FROM})"
NO_YEAR = "(o_orderkey % 7 = 0)"
MOVED = (
    f"(CASE WHEN {NO_YEAR} THEN {BEYOND} ELSE "
    f"least(greatest(year(o_orderdate), {BEYOND}), {BEYOND} + {BEYOND_SPAN - 1}) END)"
)
YEAR_MIN, YEAR_MAX = _case(0), _case(1)
COVERED = f"year(o_orderdate) BETWEEN {year_ranges()[0][0]} AND {year_ranges()[-1][1]}"
OBJECT_TYPE = "CASE WHEN o_orderstatus = 'O' THEN 'SHOW' ELSE 'MOVIE' END"
CERTIFICATION = "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END"
SCORE = "CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END"
VOTES = "CASE WHEN o_custkey % 2 <> 0 THEN CAST(o_custkey AS DOUBLE) END"
TMDB = "CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 100000 END"
SEASONS = "CASE WHEN o_orderstatus = 'O' THEN CAST(coalesce(line_count, 0) AS DOUBLE) END"
ORDERS = (
    "orders LEFT JOIN (SELECT l_orderkey, count(*) AS line_count FROM lineitem "
    "GROUP BY l_orderkey) ON l_orderkey = o_orderkey"
)
TITLE = (
    "'tt' || o_orderkey AS id, 'Title ' || o_orderkey AS content_title, "
    "CAST(year(o_orderdate) AS INTEGER) AS \"content_originalReleaseYear\""
)
SCALARS = f"""
    {TITLE},
    {OBJECT_TYPE} AS "objectType",
    o_orderpriority AS "content_shortDescription",
    {CERTIFICATION} AS "content_ageCertification",
    o_custkey % 180 AS content_runtime,
    '/title/' || o_orderkey AS "content_fullPath",
    {SCORE} AS "content_scoring_imdbScore",
    {VOTES} AS "content_scoring_imdbVotes",
    o_totalprice AS "content_scoring_tmdbPopularity",
    {TMDB} AS "content_scoring_tmdbScore",
    {SEASONS} AS "totalSeasonCount"
"""
GENRE_LINES = "lineitem JOIN part ON p_partkey = l_partkey"
OFFER_LINES = "lineitem JOIN supplier ON s_suppkey = l_suppkey"
COUNTRY_LINES = f"{OFFER_LINES} JOIN nation ON n_nationkey = s_nationkey"


def _gathered(key: str, lines: str, text: str) -> str:
    return (
        f"LEFT JOIN (SELECT l_orderkey AS {key}_key, coalesce(array_to_string(list_sort("
        f"list(DISTINCT {text}) FILTER ({text} IS NOT NULL)), ','), '') AS {key} "
        f"FROM {lines} GROUP BY 1) ON {key}_key = o_orderkey"
    )


OFFER_TEXT = (
    "'o' || l_orderkey || '-' || l_linenumber || '|/u/' || l_linenumber || '|' || s_suppkey || '|' "
    "|| s_name || '|' || lower(s_name) || '|/i/' || s_suppkey"
)
WHOLE = (
    f"{SCALARS.rstrip()}, coalesce(genres, '-') AS genres, coalesce(countries, '-') AS countries, "
    "coalesce(offer_texts, '-') AS offer_texts"
)
WHOLE_ORDERS = " ".join(
    [
        ORDERS,
        _gathered("genres", "lineitem LEFT JOIN part ON p_partkey = l_partkey", "p_type || '/' || lower(p_type)"),
        _gathered(
            "countries",
            "lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey",
            "n_name",
        ),
        _gathered("offer_texts", "lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey", OFFER_TEXT),
    ]
)
OFFERS = f"""
SELECT DISTINCT 'o' || l_orderkey || '-' || l_linenumber AS title_streaming_service_id,
    '/u/' || l_linenumber AS standard_web_url, 'tt' || o_orderkey AS title_id,
    CAST(s_suppkey AS INTEGER) AS streaming_service_id
FROM orders JOIN {OFFER_LINES} ON l_orderkey = o_orderkey
"""
POPULAR = (
    "'tt' || o_orderkey AS id, 'Title ' || o_orderkey AS content_title, "
    "o_totalprice AS \"content_scoring_tmdbPopularity\", "
    "CAST(year(o_orderdate) AS INTEGER) AS \"content_originalReleaseYear\""
)
POPULAR_ORDER = "ORDER BY o_totalprice DESC NULLS LAST, 'tt' || o_orderkey"

TABLES = {
    "fct_titles": f"""
SELECT DISTINCT 'tt' || o_orderkey AS title_id, {OBJECT_TYPE} AS object_type,
    'Title ' || o_orderkey AS title, o_orderpriority AS short_description,
    CAST(coalesce(year(o_orderdate), 0) AS SMALLINT) AS release_year,
    {CERTIFICATION} AS age_dertification, coalesce(o_custkey % 180, 0) AS runtime,
    '/title/' || o_orderkey AS full_path, coalesce({SCORE}, 0) AS imdb_score,
    coalesce({VOTES}, 0) AS imdb_votes, coalesce(o_totalprice, 0) AS tmdb_popolarity,
    coalesce({TMDB}, 0) AS tmbd_score, coalesce({SEASONS}, 0) AS season_count
FROM {ORDERS}""",
    "dim_genres": f"""
SELECT DISTINCT p_type AS genre_id, lower(p_type) AS name
FROM orders JOIN {GENRE_LINES} ON l_orderkey = o_orderkey""",
    "dim_streaming_services": f"""
SELECT DISTINCT CAST(s_suppkey AS INTEGER) AS streaming_service_id, s_name AS clear_name,
    lower(s_name) AS slug, '/i/' || s_suppkey AS icon
FROM orders JOIN {OFFER_LINES} ON l_orderkey = o_orderkey""",
    "dim_titles_genres": f"""
SELECT DISTINCT 'tt' || o_orderkey AS title_id, p_type AS genre_id
FROM orders JOIN {GENRE_LINES} ON l_orderkey = o_orderkey""",
    "dim_titles_production_countries": f"""
SELECT DISTINCT 'tt' || o_orderkey AS title_id, n_name AS country_code
FROM orders JOIN {COUNTRY_LINES} ON l_orderkey = o_orderkey""",
    "dim_titles_streaming_services": OFFERS,
}


def _titles(where: str) -> str:
    return f"SELECT {TITLE} FROM orders WHERE {where}"


def _distinct_titles(where: str) -> str:
    return f"SELECT DISTINCT {TITLE} FROM orders WHERE {where}"


def _exists(lines: str, where: str) -> str:
    return f"EXISTS (SELECT 1 FROM {lines} WHERE l_orderkey = o_orderkey AND {where})"


_GENRE_HIT = _exists(GENRE_LINES, f"p_type IN {_in(GENRES)}")
_COUNTRY_HIT = _exists(COUNTRY_LINES, f"n_name IN {_in(COUNTRIES)}")
_LISTED = "FROM orders WHERE o_orderstatus = 'P' OR (o_orderstatus = 'O' AND o_orderkey % 5 = 0)"
_STATUS = "CAST(CASE WHEN o_orderstatus = 'P' THEN 500 ELSE 200 END AS INTEGER)"

SQL: dict[str, str] = {
    **TABLES,
    "flatten_titles": f"SELECT {WHOLE} FROM {WHOLE_ORDERS}",
    "unwrap_edges": f"SELECT {WHOLE}, {YEAR_MIN} AS min, {YEAR_MAX} AS max FROM {WHOLE_ORDERS} WHERE {COVERED}",
    "titles_by_year_range": f"""
SELECT {YEAR_MIN} AS year_min, {YEAR_MAX} AS year_max, count(*) AS title_count
FROM orders WHERE {COVERED} GROUP BY 1, 2""",
    "titles_in_years": _titles("year(o_orderdate) BETWEEN 1996 AND 1998"),
    "titles_on_services": _distinct_titles(_exists(OFFER_LINES, f"s_name IN {_in(SERVICES)}")),
    "titles_on_service_table": _distinct_titles(_exists(OFFER_LINES, "s_nationkey < 10")),
    "offers_on_services": f"{OFFERS} WHERE s_name IN {_in(SERVICES)}",
    "titles_genre_any": _titles(_GENRE_HIT),
    "titles_genre_none": _titles(f"NOT {_GENRE_HIT}"),
    "titles_country_any": _titles(_COUNTRY_HIT),
    "titles_country_none": _titles(f"NOT {_COUNTRY_HIT}"),
    "titles_type_cert": _titles(
        f"{OBJECT_TYPE} = 'SHOW' AND {CERTIFICATION} IN ('1-URGENT', '2-HIGH')"
    ),
    "popular_first_page": f"SELECT {POPULAR} FROM orders {POPULAR_ORDER} LIMIT {PAGE_SIZE}",
    "popular_next_page": (
        f"SELECT {POPULAR} FROM orders {POPULAR_ORDER} LIMIT {PAGE_SIZE} OFFSET {PAGE_SIZE}"
    ),
    "popular_page_numbers": f"""
SELECT id, year_min, year_max, rank, CAST(ceil(rank / {PAGE_SIZE}.0) AS INTEGER) AS page_no
FROM (SELECT 'tt' || o_orderkey AS id, {YEAR_MIN} AS year_min, {YEAR_MAX} AS year_max,
    row_number() OVER (PARTITION BY {YEAR_MIN} {POPULAR_ORDER}) AS rank
    FROM orders WHERE {COVERED})""",
    "union_ranges": f"""
SELECT {SCALARS}, {YEAR_MIN} AS year_min, {YEAR_MAX} AS year_max FROM {ORDERS} WHERE {COVERED}""",
    **{
        f"staging_{fmt}_round_trip": f"""
SELECT {WHOLE}, {YEAR_MIN} AS year_min, {YEAR_MAX} AS year_max FROM {WHOLE_ORDERS} WHERE {COVERED}"""
        for fmt in ("parquet", "json")
    },
    "staging_range_replaced": f"""
SELECT {SCALARS}, {YEAR_MIN} AS year_min, {YEAR_MAX} AS year_max
FROM {ORDERS} WHERE {COVERED} AND (o_orderstatus = 'O'
    OR year(o_orderdate) NOT BETWEEN {REPLACED[0]} AND {REPLACED[1]})""",
    "legacy_staging_scan": f"SELECT {WHOLE} FROM {WHOLE_ORDERS}",
    "staging_table_scan": f"{TABLES['dim_titles_genres']} WHERE {COVERED}",
    "requested_range_kept": f"""
SELECT {WHOLE}, {_case(0, ASKED)} AS year_min, {_case(1, ASKED)} AS year_max FROM {WHOLE_ORDERS}""",
    "requested_beyond_ranges": f"""
SELECT * EXCLUDE (o_orderkey) REPLACE (CASE WHEN NOT {NO_YEAR} THEN "content_originalReleaseYear" END AS "content_originalReleaseYear")
FROM (SELECT {WHOLE}, {_case(0, MOVED, intervals())} AS year_min, {_case(1, MOVED, intervals())} AS year_max, o_orderkey
    FROM {WHOLE_ORDERS})""",
    "staged_again": f"""
SELECT {SCALARS}, {YEAR_MIN} AS year_min, {YEAR_MAX} AS year_max FROM {ORDERS}
WHERE {COVERED} AND (o_orderstatus = 'O' OR year(o_orderdate) NOT BETWEEN {REPLACED[0]} AND {REPLACED[1]})""",
    "republished_at_new_root": TABLES["dim_titles_genres"],
    "offers_on_service_table": f"{OFFERS} WHERE s_nationkey < 10",
    "pages_to_staging": f"{OFFERS} WHERE s_name IN {_in(SERVICES)} AND {COVERED}",
    "page_completeness": f"""
SELECT {YEAR_MIN} AS min, {YEAR_MAX} AS max,
    CAST(ceil(count(*) / {PAGE_SIZE}.0) AS BIGINT) AS pages, CAST(0 AS BIGINT) AS failed,
    count(*) AS titles, count(*) AS total_count, true AS complete
FROM orders WHERE {COVERED} GROUP BY 1, 2""",
    "late_pages_audited": f"""
SELECT {YEAR_MIN} AS min, {YEAR_MAX} AS max,
    CAST(ceil(count(*) / {PAGE_SIZE}.0) AS BIGINT) AS pages, CAST(0 AS BIGINT) AS failed,
    count(*) AS titles, count(*) AS total_count, true AS complete
FROM orders WHERE {COVERED} GROUP BY 1, 2""",
    "page_chain_broken": f"""
SELECT {YEAR_MIN} AS min, {YEAR_MAX} AS max,
    CAST(ceil(count(*) / {PAGE_SIZE}.0) AS BIGINT) AS pages, CAST(0 AS BIGINT) AS failed,
    count(*) AS titles, count(*) AS total_count, count(*) <= {PAGE_SIZE} AS complete
FROM orders WHERE {COVERED} GROUP BY 1, 2""",
    "page_error_rows": f"""
SELECT o_orderkey AS page_no, {_STATUS} AS status, o_orderstatus = 'O' AS answered,
    '{{"code":"' || o_orderstatus || '"}} : [{{"line":' || (o_custkey % 100) || ',"column":'
    || (o_orderkey % 10) || '}}] : ' || o_orderpriority AS error_text {_LISTED}
UNION ALL
SELECT o_orderkey, {_STATUS}, o_orderstatus = 'O',
    '{{"code":"' || o_orderstatus || '"}} : [{{"line":1,"column":2}}] : order ' || o_orderkey {_LISTED}
UNION ALL
SELECT o_orderkey, CAST(200 AS INTEGER), false, 'failed without a listed error'
FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0""",
    "errors_of_two_runs": f"""
SELECT CAST(low AS INTEGER) AS min, CAST(low + 9 AS INTEGER) AS max, CAST(o_orderkey AS INTEGER) AS page_no, status, answered, error_text
FROM (SELECT o_orderkey, {_STATUS} AS status, o_orderstatus = 'O' AS answered,
    CASE WHEN o_orderkey % 2 = 0 THEN 1991 ELSE 2001 END AS low,
    '{{"code":"' || o_orderstatus || '"}} : [{{"line":' || (o_custkey % 100) || ',"column":'
    || (o_orderkey % 10) || '}}] : ' || o_orderpriority AS error_text {_LISTED}
UNION ALL
SELECT o_orderkey, {_STATUS}, o_orderstatus = 'O', CASE WHEN o_orderkey % 2 = 0 THEN 1991 ELSE 2001 END,
    '{{"code":"' || o_orderstatus || '"}} : [{{"line":1,"column":2}}] : order ' || o_orderkey {_LISTED}
UNION ALL
SELECT o_orderkey, CAST(200 AS INTEGER), false, CASE WHEN o_orderkey % 2 = 0 THEN 1991 ELSE 2001 END,
    'failed without a listed error'
FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0)""",
    "service_selection_scan": "SELECT 's' || s_suppkey AS code, s_name AS clear_name FROM supplier",
    "service_catalogue_scan": (
        "SELECT 's' || s_suppkey AS code, s_name AS streaming_name, "
        "lower(s_name) AS lcase_name FROM supplier"
    ),
    "services_by_code": (
        "SELECT 's' || s_suppkey AS code, s_name AS clear_name FROM supplier "
        f"WHERE 's' || s_suppkey IN {_in(CODES)}"
    ),
    "country_table_scan": f"""
SELECT n_name AS name, 'N' || n_nationkey AS alpha2_code, 'NN' || n_nationkey AS alpha3_code,
    replace('{FLAG_PATTERN}', '%s', 'NN' || n_nationkey) AS flag
FROM nation""",
    **{f"published_{name}": TABLES[name] for name in NEEDS},
}
# The published tables come through staging, which holds the covered years only.
for _name in NEEDS:
    SQL[f"published_{_name}"] += f" WHERE {COVERED}"
    SQL[f"whole_run_{_name}"] = SQL[f"published_{_name}"]
SQL["whole_run_dim_countries"] = SQL["country_table_scan"]
for _name in ("titles_by_year_range", "popular_first_page", "popular_next_page", "popular_page_numbers", "page_completeness"):
    SQL[f"{_name}_with_offers"] = SQL[_name]
