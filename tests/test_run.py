import pathlib

import pytest

from marquee.__main__ import main
from marquee.operators import filters
from marquee.operators.filters import TitleFilter, filter_offers
from marquee.plans.publish import publish, run_all, run_jobs
from marquee.functions.years import OPEN_HIGH, OPEN_LOW
from marquee.plans import run_log, stage
from marquee.plans.stage import PagesRejected, RowsMissing, audit_with, of_ranges, stage_legacy, stage_pages
from marquee.schemas import TITLE_TABLES
from marquee.session import scratch_path, scratch_scope, written
from marquee.sinks import published_path, snapshots
from marquee.sources import read_pages, read_service_selection, read_staging, service_names
from rows import bag, error, ids, node, offer, page, staging
from test_sources import land, legacy

SERVICES = ("Hulu", "Max")


@pytest.fixture
def landed(tmp_path):
    root = tmp_path / "pages"
    hulu, other = offer("1", "Hulu", 7), offer("2", "Other", 8)
    land(root, page(1, [node("a", 1995, offers=[hulu, other])], None, "a", True, 2))
    land(root, page(2, [node("b", 1999, kind="SHOW", seasons=2.0, offers=[other])], "a", "b", False, 2))
    land(root, page(1, [node("c", 2001, seasons=5.0, offers=[hulu])], None, "c", False, 1, 2001, 2010))
    land(root, page(1, [], total=0, low=2011, high=2012))
    return root


def test_stage(spark, tmp_path, landed):
    staged = str(tmp_path / "s")
    stage_pages(spark, str(landed), staged)
    rows = {r.id: r for r in read_staging(spark, staged).collect()}
    assert sorted(rows) == ["a", "b", "c"]
    assert (rows["b"].year_min, rows["b"].year_max, rows["b"].totalSeasonCount) == (1991, 2000, 2.0)
    assert rows["c"].totalSeasonCount is None


def test_stage_with_filters(spark, tmp_path, landed):
    staged = str(tmp_path / "s")
    stage_pages(
        spark, str(landed), staged, wanted=TitleFilter(services=SERVICES), offer_services=SERVICES
    )
    got = bag(read_staging(spark, staged).selectExpr("id", "offers.package.clearName"))
    assert got == [("a", ["Hulu"]), ("c", ["Hulu"])]


def test_stage_one_range_leaves_the_others(spark, tmp_path, landed):
    staged = str(tmp_path / "s")
    stage_pages(spark, str(landed), staged)
    nothing = TitleFilter(object_types=("NONE",))
    stage_pages(spark, str(landed), staged, ranges=[(2001, 2010)], wanted=nothing)
    assert ids(read_staging(spark, staged)) == ["a", "b"]
    assert ids(of_ranges(read_pages(spark, str(landed)), [(2001, 2010)]).selectExpr(
        "explode(data.popularTitles.edges.node.id) as id")) == ["c"]


def test_failed_page_stops_the_run(spark, tmp_path, landed):
    land(landed, page(3, [], status=500, errors=[error("first"), error("second", "E2")]))
    staged, errors = tmp_path / "s", str(tmp_path / "errors")
    with pytest.raises(PagesRejected) as caught:
        stage_pages(spark, str(landed), str(staged), errors_path=errors)
    assert "1 failed page" in str(caught.value)
    assert "first" in str(caught.value) and "second" in str(caught.value)
    assert spark.read.parquet(errors).count() == 2
    assert snapshots.current(spark, str(staged)) is None
    # The other ranges are not affected.
    stage_pages(spark, str(landed), str(staged), ranges=[(2001, 2010)])
    assert ids(read_staging(spark, str(staged))) == ["c"]


def test_failed_page_without_errors_stops_the_run(spark, tmp_path, landed):
    land(landed, page(3, [], status=502))
    with pytest.raises(PagesRejected, match="1 failed page"):
        stage_pages(spark, str(landed), str(tmp_path / "s"), complete=False)


def test_incomplete_range_stops_the_run(spark, tmp_path, landed):
    land(landed, page(2, [node("b", 1999)], "wrong", "b", False, 2))
    with pytest.raises(PagesRejected, match="1991-2000"):
        stage_pages(spark, str(landed), str(tmp_path / "s"))
    stage_pages(spark, str(landed), str(tmp_path / "s"), complete=False)
    assert ids(read_staging(spark, str(tmp_path / "s"))) == ["a", "b", "c"]


def test_staging_must_not_lie_in_the_pages(spark, landed):
    with pytest.raises(ValueError, match="overlap"):
        stage_pages(spark, str(landed), str(landed / "staging"))


def test_whole_run_twice(spark, tmp_path, landed):
    countries = spark.createDataFrame(
        [("Zambia", "ZM", "ZMB")], "name string, alpha2_code string, alpha3_code string"
    )
    for _ in range(2):
        run_all(
            spark, str(landed), str(tmp_path / "s"), str(tmp_path / "out"), "whole", countries,
            wanted=TitleFilter(services=SERVICES), offer_services=SERVICES,
        )
        read = lambda name: bag(spark.table(f"whole.{name}"))
        assert [r[0] for r in read("fct_titles")] == ["a", "c"]
        assert read("dim_streaming_services") == [(7, "Hulu", "Hulu", "/i")]
        assert read("dim_titles_streaming_services") == [("1", "/u", "a", 7), ("1", "/u", "c", 7)]
        assert read("dim_titles_genres") == [("a", "drm"), ("c", "drm")]
        assert read("dim_titles_production_countries") == [("a", "US"), ("c", "US")]
        assert read("dim_genres") == [("drm", "drm")]
        assert len(read("dim_countries")) == 1


def test_ranges_without_pages_keep_their_staging(spark, tmp_path, landed):
    """A run over some landed ranges must not empty the others."""
    staged = str(tmp_path / "s")
    assert stage_pages(spark, str(landed), staged) == ((1991, 2000), (2001, 2010), (2011, 2012))
    later = tmp_path / "later"
    land(later, page(1, [node("d", 2005), node("stray", 1995)], low=2001, high=2010))
    assert stage_pages(spark, str(later), staged) == ((2001, 2010),)
    assert ids(read_staging(spark, staged)) == ["a", "b", "d", "stray"]


def test_titles_stay_in_the_range_they_were_requested_for(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    titles = [node("in", 1995), node("null", None), node("before", 1900), node("after", 2050)]
    land(root, page(1, titles, low=1991, high=2000))
    stage_pages(spark, str(root), staged)
    rows = read_staging(spark, staged)
    assert ids(rows) == ["after", "before", "in", "null"]
    assert {(r.year_min, r.year_max) for r in rows.collect()} == {(1991, 2000)}
    # A request over several staging ranges is told apart by the year, strays by its ends.
    land(tmp_path / "wide", page(1, titles, low=1991, high=2010))
    stage_pages(spark, str(tmp_path / "wide"), staged)
    assert {r.id: r.year_min for r in read_staging(spark, staged).collect()} == {
        "in": 1991, "null": 1991, "before": 1991, "after": 2001
    }


def test_all_errors_are_kept(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    many = [error(f"e{i:02}") for i in range(50)]
    land(root, page(1, [], status=500, errors=many))
    with pytest.raises(PagesRejected, match="1 failed page"):
        stage_pages(spark, str(root), staged)
    assert spark.read.parquet(f"{staged}-errors").count() == 50


def test_answers_with_errors(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    land(root, page(1, [node("a", 1995)], errors=[error("beside")]))
    stage_pages(spark, str(root), staged)
    assert ids(read_staging(spark, staged)) == ["a"]
    assert [r.answered for r in spark.read.parquet(f"{staged}-errors").collect()] == [True]
    with pytest.raises(PagesRejected, match="beside"):
        stage_pages(spark, str(root), staged, partial=False)
    empty = page(1, [], errors=[error("instead")])
    empty["data"] = None
    land(tmp_path / "empty", empty)
    with pytest.raises(PagesRejected, match="instead"):
        stage_pages(spark, str(tmp_path / "empty"), staged)


def test_tables_follow_a_new_root_and_refuse_other_columns(spark, tmp_path, landed):
    stage_pages(spark, str(landed), str(tmp_path / "s"))
    for root in ("r1", "r2"):
        rows = str(tmp_path / "s")
        run_jobs(spark, rows, str(tmp_path / root))
        publish(spark, "moved", str(tmp_path / root))
        where = spark.table("moved.dim_genres").inputFiles()
        assert where and all(f"/{root}/" in f for f in where)
    spark.sql("DROP TABLE moved.dim_genres")
    spark.sql("CREATE TABLE moved.dim_genres (other INT) USING PARQUET")
    with pytest.raises(ValueError, match="other columns"):
        publish(spark, "moved", str(tmp_path / "r1"))
    assert all("/r2/" in f for f in spark.table("moved.fct_titles").inputFiles())


def test_failing_run_leaves_the_tables(spark, tmp_path, landed):
    out = (str(tmp_path / "s"), str(tmp_path / "out"), "steady")
    run_all(spark, str(landed), *out)
    before = {c.name: bag(spark.table(f"steady.{c.name}")) for c in TITLE_TABLES}
    land(tmp_path / "bad", page(1, [node("z", 40000)], low=1991, high=2000))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        run_all(spark, str(tmp_path / "bad"), *out)
    assert before == {c.name: bag(spark.table(f"steady.{c.name}")) for c in TITLE_TABLES}


def test_missing_countries_are_reported(spark, tmp_path, landed):
    stage_pages(spark, str(landed), str(tmp_path / "s"))
    run_jobs(spark, str(tmp_path / "s"), str(tmp_path / "out"))
    with pytest.warns(UserWarning, match="no countries"):
        publish(spark, "bare", str(tmp_path / "out"))


def test_scratch_scope_cleans_up(spark, tmp_path):
    with scratch_scope(spark):
        written(spark.range(3).toDF("x"), "kept")
        place = pathlib.Path(scratch_path(spark, "other").removeprefix("file:"))
        made = list(place.parent.glob("kept-*"))
        assert made
    assert not any(m.exists() for m in made)


def test_asked_range_must_be_landed(spark, tmp_path, landed):
    with pytest.raises(PagesRejected, match="missing year range.*2013-2014"):
        stage_pages(spark, str(landed), str(tmp_path / "s"), ranges=[(1991, 2000), (2013, 2014)])
    with pytest.raises(PagesRejected, match="no page"):
        stage_pages(spark, str(landed), str(tmp_path / "s"), ranges=[(2013, 2014)], complete=False)


def test_partly_landed_range_is_incomplete(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    land(root, page(1, [node("a", 1992)], low=1991, high=1995))
    with pytest.raises(PagesRejected, match="incomplete year range.*1991-2000"):
        stage_pages(spark, str(root), staged)
    land(root, page(1, [node("b", 1999)], low=1996, high=2000))
    assert stage_pages(spark, str(root), staged) == ((1991, 2000),)
    assert ids(read_staging(spark, staged)) == ["a", "b"]


def test_legacy_staging(spark, tmp_path):
    (tmp_path / "old").mkdir()
    legacy(tmp_path / "old" / "titles_1991_2000.json", [node("a", 1995), node("b", 1996), node("n", None)])
    legacy(tmp_path / "old" / "titles_2001_2010.json", [node("c", 2005, runtime=None), node("s", 1920)])
    legacy(tmp_path / "old" / "more.json", [node("d", 2015)])
    stage_legacy(spark, str(tmp_path / "old"), str(tmp_path / "s"))
    rows = {r.id: r.year_min for r in read_staging(spark, str(tmp_path / "s")).collect()}
    assert rows == {"a": 1991, "b": 1991, "n": 1991, "c": 2001, "s": 2001, "d": 2015}
    run_jobs(spark, str(tmp_path / "old"), str(tmp_path / "x"), "legacy")
    run_jobs(spark, str(tmp_path / "s"), str(tmp_path / "y"), at_once=1)
    for contract in TITLE_TABLES:
        read = lambda root: bag(spark.read.parquet(published_path(spark, contract, str(tmp_path / root))))  # noqa: E731,B023
        assert read("x") == read("y") != []


def test_failing_job_is_reported(spark, tmp_path):
    (tmp_path / "old").mkdir()
    legacy(tmp_path / "old" / "f.json", [node("a", 40000)])
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        run_jobs(spark, str(tmp_path / "old"), str(tmp_path / "x"), "legacy")
    assert snapshots.current(spark, str(tmp_path / "x")) is None
    assert snapshots.names_below(spark, str(tmp_path / "x"), "run=*") == []


def test_command_line(spark, tmp_path, landed):
    (tmp_path / "services.json").write_text('{"code":"oth", "clear_name":"Other"}\n')
    (tmp_path / "countries.csv").write_text("name,alpha2_code,alpha3_code\nÅland,AX,ALA\n", "utf-8")
    places = ["--pages", str(landed), "--staging", str(tmp_path / "s")]
    root = ["--root", str(tmp_path / "out")]
    main(["all", *places, *root, "--db", "cli", "--countries", str(tmp_path / "countries.csv")], spark)
    # Nothing is filtered unless asked for.
    assert bag(spark.table("cli.dim_streaming_services")) == [(7, "Hulu", "Hulu", "/i"), (8, "Other", "Other", "/i")]
    assert spark.table("cli.dim_countries").first().flag.endswith("/ALA.png")

    main(["stage", *places, "--services", str(tmp_path / "services.json"), "--range", "1991-2000"], spark)
    main(["jobs", "--staging", str(tmp_path / "s"), *root, "--table", "dim_streaming_services"], spark)
    main(["publish", *root, "--db", "cli"], spark)
    assert {r.clear_name for r in spark.table("cli.dim_streaming_services").collect()} == {"Hulu", "Other"}
    assert spark.table("cli.dim_countries").count() == 1
    (tmp_path / "flags.csv").write_text("name,alpha2_code,alpha3_code,flag\nX,XX,XXX,own\n")
    main(["publish", *root, "--db", "cli", "--countries", str(tmp_path / "flags.csv")], spark)
    assert spark.table("cli.dim_countries").first().flag == "own"
    main(["stage", *places, "--default-services"], spark)
    assert ids(read_staging(spark, str(tmp_path / "s"))) == ["a", "c"]

    main(["stage", *places, "--all-services"], spark)
    assert ids(read_staging(spark, str(tmp_path / "s"))) == ["a", "b", "c"]


def test_long_selection(spark, tmp_path, landed):
    lines = "".join(f'{{"code":"c{i}", "clear_name":"S{i}"}}\n' for i in range(2000))
    (tmp_path / "many.json").write_text(lines + '{"code":"o", "clear_name":"Other"}\n')
    main(["stage", "--pages", str(landed), "--staging", str(tmp_path / "s"), "--services", str(tmp_path / "many.json")], spark)
    got = bag(read_staging(spark, str(tmp_path / "s")).selectExpr("id", "offers.package.clearName"))
    assert got == [("a", ["Other"]), ("b", ["Other"])]
    assert len(service_names(read_service_selection(spark, str(tmp_path / "many.json")))) == 2001


def test_offers_by_service_table_keep_order_and_null_arrays(spark):
    services = spark.createDataFrame([("Hulu",), ("Hulu",), (None,)], "clear_name string")
    hulu, other = offer("1", "Hulu"), offer("2", "Other")
    titles = staging(spark, node("a", offers=[other, hulu, hulu]), node("b", offers=None), node("c", offers=[]), node("d", offers=[other]))
    found = {r.id: r.offers if r.offers is None else [o.id for o in r.offers] for r in filter_offers(titles, services).collect()}
    assert found == {"a": ["1", "1"], "b": None, "c": [], "d": []}


EARLY, LATE = (OPEN_LOW, 1899), (2024, OPEN_HIGH)


def staged_ranges(spark, path):
    return {r.id: (r.year_min, r.year_max) for r in read_staging(spark, path).collect()}


def test_no_landed_title_vanishes(spark, tmp_path):
    """A request that ends behind the fixed boundaries: titles of all years are staged."""
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    titles = [node("a", 2022), node("b", 2024), node("c", 2050), node("d", None)]
    land(root, page(1, titles, low=2021, high=2025))
    assert stage_pages(spark, str(root), staged) == ((2021, 2023), LATE)
    assert staged_ranges(spark, staged) == {"a": (2021, 2023), "b": LATE, "c": LATE, "d": (2021, 2023)}


def test_requests_outside_the_boundaries(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    land(root, page(1, [node("a", 2024), node("b", 2030)], low=2024, high=2026))
    land(root, page(1, [node("c", 1880), node("d", 1700)], low=1890, high=1899))
    assert stage_pages(spark, str(root), staged) == (EARLY, LATE)
    assert staged_ranges(spark, staged) == {"a": LATE, "b": LATE, "c": EARLY, "d": EARLY}
    # Less of an open range than is staged would lose the rest of it.
    land(tmp_path / "less", page(1, [node("e", 2024)], low=2024, high=2025))
    with pytest.raises(PagesRejected, match="incomplete year range.*2024-$"):
        stage_pages(spark, str(tmp_path / "less"), staged)
    land(tmp_path / "gap", page(1, [node("e", 2030)], low=2025, high=2040))
    with pytest.raises(PagesRejected, match="incomplete year range.*2024-$"):
        stage_pages(spark, str(tmp_path / "gap"), staged)
    land(tmp_path / "more", page(1, [node("e", 2024)], low=2024, high=2030))
    assert stage_pages(spark, str(tmp_path / "more"), staged, ranges=[(2024, OPEN_HIGH)]) == (LATE,)
    assert staged_ranges(spark, staged) == {"e": LATE, "c": EARLY, "d": EARLY}


def test_failed_page_of_a_late_range_stops_the_run(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    land(root, page(1, [node("a", 1995)]))
    land(root, page(1, [], status=500, errors=[error("late")], low=2024, high=2026))
    with pytest.raises(PagesRejected, match="1 failed page(.|\n)*late"):
        stage_pages(spark, str(root), staged)
    assert [r.min for r in run_log.read_errors(spark, run_log.errors_path(staged)).collect()] == [2024]


def test_own_boundaries(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    land(root, page(1, [node("a", 2024), node("b", 2026)], low=2021, high=2030))
    assert stage_pages(spark, str(root), staged, boundaries=(2020, 2025, 2030)) == ((2021, 2025), (2026, 2030))
    assert staged_ranges(spark, staged) == {"a": (2021, 2025), "b": (2026, 2030)}
    with pytest.raises(ValueError, match="overlaps"):
        stage_pages(spark, str(root), staged)
    assert staged_ranges(spark, staged) == {"a": (2021, 2025), "b": (2026, 2030)}
    with pytest.raises(ValueError, match="no staging range"):
        stage_pages(spark, str(root), staged, ranges=[(1991, 1995)])


def test_what_has_no_place_is_refused(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    empty = page(1, [node("a", 1995), node("b", 1996)], total=2)
    empty["data"]["popularTitles"]["edges"][1]["node"] = None
    land(root, empty)
    land(root, page(1, [node("c", 2005)], low=2010, high=2001))
    assert stage_pages(spark, str(root), staged) == ((1991, 2000),)
    assert staged_ranges(spark, staged) == {"a": (1991, 2000)}
    refused = {(r.min, r.max): r for r in run_log.read_refused(spark, staged).collect()}
    assert refused[1991, 2000].reason == "an edge without a title"
    assert refused[2010, 2001].reason == "no year range" and '"id":"c"' in refused[2010, 2001].record
    assert refused[2010, 2001].file.endswith(".json")


def test_rows_that_do_not_add_up_fail(spark, tmp_path, monkeypatch):
    landed, staged = tmp_path / "pages", str(tmp_path / "s")
    land(landed, page(1, [node("a", 1995), node("b", 1996), node("c", 1997)]))
    stage_pages(spark, str(landed), staged)
    monkeypatch.setattr(stage, "_sheet", lambda placed, original=stage._sheet: original(placed.where("id IS NULL OR id <> 'b'")))
    with pytest.raises(RowsMissing, match="landed"):
        stage_pages(spark, str(landed), staged, refresh=True)
    assert ids(read_staging(spark, staged)) == ["a", "b", "c"]
    assert len(snapshots.names_below(spark, staged, "run=*")) == 1


def test_broken_record_is_named(spark, tmp_path, landed):
    staged = str(tmp_path / "s")
    bad = landed / "min=2001" / "max=2010" / "cut.json"
    bad.write_text('{"page_no": 2, "status": 20')
    with pytest.raises(PagesRejected, match="1 unreadable document(.|\n)*cut.json"):
        stage_pages(spark, str(landed), staged)
    assert snapshots.current(spark, staged) is None
    refused = run_log.read_refused(spark, staged).collect()
    assert [(r.reason, r.record, r.min) for r in refused] == [("not a page", '{"page_no": 2, "status": 20', 2001)]
    assert refused[0].file.endswith("/cut.json")
    stage_pages(spark, str(landed), staged, broken="refuse")
    assert ids(read_staging(spark, staged)) == ["a", "b", "c"]
    assert run_log.read_refused(spark, staged).count() == 1
    bad.unlink()
    stage_pages(spark, str(landed), staged)
    assert run_log.read_refused(spark, staged).count() == 0
    with pytest.raises(ValueError, match="fail or refuse"):
        stage_pages(spark, str(landed), staged, broken="ignore")


def test_errors_of_two_runs_are_kept(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    land(root, page(1, [node("a", 1995)], errors=[error("one")]))
    land(root, page(1, [node("b", 2005)], errors=[error("two")], low=2001, high=2010))
    for years in ((1991, 2000), (2001, 2010)):
        stage_pages(spark, str(root), staged, ranges=[years])
    errors = lambda: sorted(r.error_text.rsplit(" ", 1)[1] for r in run_log.read_errors(spark, run_log.errors_path(staged)).collect())
    assert errors() == ["one", "two"]
    # A later run over a range replaces the errors of that range alone, also by none.
    land(root, page(1, [node("a", 1995)]))
    stage_pages(spark, str(root), staged, ranges=[(1991, 2000)])
    assert errors() == ["two"]


def test_unchanged_pages_are_not_parsed_again(spark, tmp_path, landed, monkeypatch):
    staged = str(tmp_path / "s")
    every = ((1991, 2000), (2001, 2010), (2011, 2012))
    assert stage_pages(spark, str(landed), staged) == every
    parsed = []
    monkeypatch.setattr(stage, "of_requests", lambda pages, need, original=stage.of_requests: parsed.append(need) or original(pages, need))
    before = snapshots.current(spark, staged)
    assert stage_pages(spark, str(landed), staged) == () and parsed == []
    assert snapshots.current(spark, staged) == before
    # One range changed: it alone is parsed. Restrictions changed: all are.
    land(landed, page(1, [node("c", 2001), node("d", 2002)], None, "c", False, 2, 2001, 2010))
    assert stage_pages(spark, str(landed), staged) == ((2001, 2010),) and set(map(tuple, parsed[0])) == {(2001, 2010)}
    assert ids(read_staging(spark, staged)) == ["a", "b", "c", "d"]
    assert stage_pages(spark, str(landed), staged, wanted=TitleFilter(services=SERVICES)) == every
    assert stage_pages(spark, str(landed), staged, wanted=TitleFilter(services=SERVICES)) == ()
    assert stage_pages(spark, str(landed), staged, wanted=TitleFilter(services=SERVICES), refresh=True) == every
    # A file that is gone is a change of its range.
    next((landed / "min=1991").rglob("*2*.json")).unlink()
    with pytest.raises(PagesRejected, match="incomplete"):
        stage_pages(spark, str(landed), staged, wanted=TitleFilter(services=SERVICES))


def test_ranges_that_share_a_staging_range_are_parsed_together(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    land(root, page(1, [node("a", 1992)], low=1991, high=1995))
    land(root, page(1, [node("b", 1999), node("c", 2002)], low=1996, high=2005))
    land(root, page(1, [node("d", 2008)], low=2006, high=2010))
    land(root, page(1, [node("e", 2011)], low=2011, high=2012))
    stage_pages(spark, str(root), staged)
    land(root, page(1, [node("x", 2007)], low=2006, high=2010))
    assert stage_pages(spark, str(root), staged) == ((1991, 2000), (2001, 2010))
    assert ids(read_staging(spark, staged)) == ["a", "b", "c", "e", "x"]


def test_late_page_updates_the_audit(spark, tmp_path):
    root, staged = tmp_path / "pages", str(tmp_path / "s")
    one = page(1, [node("a", 1995)], None, "a", True, 3)
    three = page(3, [node("c", 1997)], "b", "c", False, 3)
    land(root, one), land(root, three)
    stage_pages(spark, str(root), staged, complete=False)
    assert [r.complete for r in audit_with(spark, staged).collect()] == [False]
    land(tmp_path / "late", page(2, [node("b", 1996)], "a", "b", True, 3))
    late = read_pages(spark, str(tmp_path / "late"))
    row = audit_with(spark, staged, late).first()
    assert (row.complete, row.pages, row.titles) == (True, 3, 3)


def test_long_service_tables_are_joined(spark, tmp_path, landed, monkeypatch):
    services = spark.createDataFrame([("Hulu",), ("S1",), ("S2",)], "clear_name string")
    results = []
    for most in (10_000, 1, 0):
        monkeypatch.setattr(stage, "service_dictionary", lambda s, most=most: filters.service_dictionary(s, most=most))
        for name in ("mark_on_services", "filter_offers"):
            monkeypatch.setattr(stage, name, lambda *a, most=most, f=getattr(filters, name): f(*a, most=most))
        stage_pages(spark, str(landed), str(tmp_path / f"s{most}"), services=services, offer_services=services)
        results.append(bag(read_staging(spark, str(tmp_path / f"s{most}")).selectExpr("id", "offers.id")))
    assert results[0] == results[1] == results[2] == [("a", ["1"]), ("c", ["1"])]


def test_legacy_titles_of_all_years(spark, tmp_path):
    (tmp_path / "old").mkdir()
    legacy(tmp_path / "old" / "more.json", [node("a", 1995), node("b", 2024), node("c", 1880), node("d", None)])
    with open(tmp_path / "old" / "bad_1991_2000.json", "w") as f:
        f.write("    {\n        \"id\": \"x\n    }\n")
    with pytest.raises(PagesRejected, match="bad_1991_2000.json"):
        stage_legacy(spark, str(tmp_path / "old"), str(tmp_path / "s"))
    stage_legacy(spark, str(tmp_path / "old"), str(tmp_path / "s"), broken="refuse")
    assert staged_ranges(spark, str(tmp_path / "s")) == {"a": (1991, 2000), "b": LATE, "c": EARLY}
    refused = {r.reason: r.record for r in run_log.read_refused(spark, str(tmp_path / "s")).collect()}
    assert set(refused) == {"no year range", "not a title"} and '"id":"d"' in refused["no year range"]


def test_command_line_publishes_all_or_nothing(spark, tmp_path, landed):
    places = ["--pages", str(landed), "--staging", str(tmp_path / "s"), "--root", str(tmp_path / "out"), "--db", "whole_cli"]
    main(["all", *places], spark)
    read = lambda: {c.name: bag(spark.table(f"whole_cli.{c.name}")) for c in TITLE_TABLES}
    before = read()
    land(landed, page(1, [node("z", 40000, offers=[offer("9", "New", 9)])], None, "z", False, 1, 2001, 2010))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        main(["all", *places], spark)
    assert read() == before


def test_scratch_scopes_of_two_threads(spark):
    """A scope deletes what was made inside it, not what another thread makes meanwhile."""
    import threading

    inside, leave = threading.Event(), threading.Event()

    def other():
        with scratch_scope(spark):
            inside.set()
            leave.wait(60)

    thread = threading.Thread(target=other)
    thread.start()
    inside.wait(60)
    kept = written(spark.range(3).toDF("x"), "kept")
    leave.set()
    thread.join()
    assert kept.count() == 3
