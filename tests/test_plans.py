"""Physical plans over a staging table with every column filled."""

import contextlib
import io
import pathlib
import re

import pytest

from marquee.adapters import order_tables
from marquee.adapters.order_tables import landed_pages, nested_titles, staging_titles
from marquee.operators import filters, pages, ranking
from marquee.operators.filters import TitleFilter
from marquee.operators.flatten import flatten, seasons_of_shows
from marquee.plans import normalize, stage
from marquee.plans.checks import QUERIES
from marquee.schemas import NODE, STAGING
from marquee.session import shared_dir
from marquee.sinks import write_staging
from marquee.sinks.files import write_run
from marquee.sources import read_concatenated_json, read_pages, read_staging
from rows import bag, node, staging as staging_rows


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def read_schemas(df):
    return re.findall(r"ReadSchema: (.*)", plan(df))


@pytest.fixture(scope="module")
def staging(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "s")
    rows = [node(str(y), y, popularity=float(y)) for y in (1949, 1995, 1996, 2005, 2022)]
    write_staging(filters.assign_year_range(staging_rows(spark, *rows)), path)
    return read_staging(spark, path)


READS = {
    "genres": "struct<content_genres:array<struct<id:string,translation:string>>>",
    "streaming_services": "struct<offers:array<struct<package:struct<packageId:int,"
    "clearName:string,slug:string,icon:string>>>>",
    "titles_genres": "struct<id:string,content_genres:array<struct<id:string>>>",
    "titles_production_countries": "struct<id:string,content_productionCountries:array<string>>",
    "titles_streaming_services": "struct<id:string,offers:array<struct<id:string,"
    "standardWebURL:string,package:struct<packageId:int>>>>",
}


@pytest.mark.parametrize("job", READS)
def test_jobs_read_only_what_they_project(staging, job):
    assert read_schemas(getattr(normalize, job)(staging)) == [READS[job]]


def test_titles_job_reads_no_array(staging):
    (schema,) = read_schemas(normalize.titles(staging))
    assert "array" not in schema and "offers" not in schema


@pytest.mark.parametrize("job", [*READS, "titles"])
def test_jobs_shuffle_once_after_partial_aggregation(staging, job):
    text = plan(getattr(normalize, job)(staging))
    tree = text[: text.index("\n\n")]
    assert tree.count("Exchange") == 1
    assert tree.count("HashAggregate") == 2
    assert "Python" not in text and "Window" not in text


def test_filters_stay_in_the_scan_stage(staging):
    wanted = TitleFilter(
        years=(1995, 1996), services=("Hulu",), genres=("drm",), exclude_countries=("FR",),
        object_types=("MOVIE",),
    )
    df = filters.filter_titles(staging, wanted).select("id")
    text = plan(df)
    assert "Exchange" not in text
    (schema,) = read_schemas(df)
    assert "offers:array<struct<package:struct<clearName:string>>>" in schema
    assert "content_genres:array<struct<id:string>>" in schema
    assert "content_title" not in schema
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "EqualTo(objectType,MOVIE)" in pushed
    assert "GreaterThanOrEqual(content_originalReleaseYear,1995)" in pushed


def test_staging_ranges_prune_partitions(spark, staging):
    hit = filters.of_staging_ranges(staging, [(1991, 2000)])
    files = {f for (f,) in hit.selectExpr("_metadata.file_path").distinct().collect()}
    assert files and all("year_min=1991" in f for f in files)


def test_landed_pages_are_parsed_once(spark, sf_dir, tmp_path, monkeypatch):
    landed_pages(spark, sf_dir, ()).write.partitionBy("min", "max").json(str(tmp_path / "p"))
    reads, written = [], []
    monkeypatch.setattr(stage, "read_pages", lambda *a, **k: reads.append(a) or read_pages(*a, **k))
    monkeypatch.setattr(stage, "write_run", lambda df, *a: written.append(plan(df)) or write_run(df, *a))
    stage.stage_pages(spark, str(tmp_path / "p"), str(tmp_path / "s"), multi_line=False)
    # One pass over the documents, without a shuffle and without a copy in between.
    assert len(reads) == len(written) == 1 and len(re.findall(r"\+- Scan json", written[0])) == 1
    assert "Exchange" not in written[0] and "Scan parquet" not in written[0]


def test_year_bounds_reach_the_scan(staging):
    df = filters.assign_year_range(staging.drop("year_min", "year_max")).select("id")
    pushed = re.search(r"PushedFilters: (.*)", plan(df)).group(1)
    assert "GreaterThanOrEqual(content_originalReleaseYear,1900)" in pushed


def test_first_page_is_a_top_k(staging):
    assert "TakeOrderedAndProject" in plan(ranking.first_page(staging))
    cursor = ranking.Cursor(2000.0, "x")
    text = plan(ranking.next_page(staging, cursor))
    assert "TakeOrderedAndProject" in text and "PushedFilters: [Or(" in text


def test_offer_filter_keeps_its_shape_without_shuffle(staging):
    df = filters.filter_offers(staging, ("Hulu",))
    assert "Exchange" not in plan(df)
    assert df.drop("year_min", "year_max").schema.simpleString() == STAGING.simpleString()


def test_service_table_is_looked_up_in_the_row(spark, staging):
    services = spark.createDataFrame([("Hulu",)], "clear_name string")
    df = filters.titles_on_services(staging, services).select("id")
    assert read_schemas(df) == ["struct<id:string,offers:array<struct<package:struct<clearName:string>>>>"]
    assert "Join" not in plan(df) and "Exchange" not in plan(df)
    for kept in (filters.filter_offers(staging, services), filters.filter_offers(staging, services.where("false"))):
        assert "Join" not in plan(kept) and "Exchange" not in plan(kept)
    joined = filters.titles_on_services(staging, services, most=0).select("id")
    assert "Join" in plan(joined)


def test_edges_of_columnar_pages_are_pruned(spark, sf_dir, tmp_path):
    landed_pages(spark, sf_dir).write.parquet(str(tmp_path / "p"))
    df = pages.unwrap_edges(spark.read.parquet(str(tmp_path / "p"))).select("id")
    (schema,) = read_schemas(df)
    assert schema.endswith("edges:array<struct<node:struct<id:string>>>>>>")


def test_audit_has_no_window_and_no_join(spark, sf_dir, tmp_path):
    landed_pages(spark, sf_dir).write.parquet(str(tmp_path / "p"))
    text = plan(pages.audit_pages(spark.read.parquet(str(tmp_path / "p"))))
    assert "Window" not in text and "Join" not in text


def test_adapter_records_match_the_schemas(spark, sf_dir):
    flat, nested = staging_titles(spark, sf_dir, max_offers=None), nested_titles(spark, sf_dir)
    assert flat.schema.simpleString() == STAGING.simpleString()
    assert nested.schema.simpleString() == NODE.simpleString()
    assert bag(flatten(seasons_of_shows(nested))) == bag(flat)


def test_adapter_reads_only_what_a_query_uses(spark, sf_dir):
    schemas = read_schemas(QUERIES["titles_country_none"](spark, sf_dir))
    assert "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in schemas
    assert "struct<l_orderkey:bigint,l_suppkey:bigint>" in schemas


def _made(spark, label, work):
    """Scratch tables of a label that ``work`` leaves."""
    root = pathlib.Path(shared_dir(spark).removeprefix("file:"))
    before = set(root.glob(f"{label}-*"))
    work()
    return sorted(set(root.glob(f"{label}-*")) - before)


def test_pages_are_ranked_by_short_rows(spark, sf_dir):
    """What is written for the ranking and joined to it holds no title texts and no line items."""
    (records,) = _made(spark, "records", lambda: landed_pages(spark, sf_dir))
    columns = set(spark.read.parquet(str(records)).columns)
    assert not columns & {"node", "genres", "countries", "offers", *STAGING.names} - {"id", filters.YEAR}


def test_landed_text_is_packed(spark, sf_dir):
    for query, label in (("pages_to_staging", "pages"), ("legacy_staging_scan", "legacy")):
        (landed,) = _made(spark, label, lambda: QUERIES[query](spark, sf_dir).count())
        files = [f.name for f in landed.rglob("part-*")]
        assert files and all(f.endswith(".gz") for f in files)


def test_table_jobs_shuffle_ids_only_where_no_title_repeats(spark):
    df = staging_rows(spark, node("a"), node("b"))
    for job in normalize.without_repeats(df):
        assert "Exchange" in plan(job(df)) and "Exchange" not in plan(job(df, once=True))


def test_blank_legacy_records_are_found_by_a_search(spark, tmp_path):
    (tmp_path / "f.json").write_text("")
    assert "translate(" not in plan(read_concatenated_json(spark, str(tmp_path)))


def test_sets_with_offers_are_made_behind_the_shuffle(spark, sf_dir, monkeypatch):
    def shuffled_first():
        text = plan(order_tables._title_sets(spark, sf_dir, order_tables.ALL))
        return text.index("hashpartitioning(key") < text.index("partial_collect_set")

    assert shuffled_first()
    monkeypatch.setattr(order_tables, "MAX_OFFERS", 1)
    assert not shuffled_first()  # copies of an order's many line items collapse ahead


def test_lines_and_titles_are_dealt_to_tasks_of_bounded_size(spark, sf_dir, monkeypatch):
    usual = bag(landed_pages(spark, sf_dir))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    monkeypatch.setattr(order_tables, "LINES_A_TASK", 50)
    monkeypatch.setattr(order_tables, "TITLES_A_TASK", 50)
    tasks = order_tables._title_sets(spark, sf_dir, order_tables.ALL).rdd.getNumPartitions()
    assert tasks == -(-lines // 50)
    assert bag(landed_pages(spark, sf_dir)) == usual
    monkeypatch.setattr(order_tables, "MAX_OFFERS", 1)
    assert bag(landed_pages(spark, sf_dir)) == usual
