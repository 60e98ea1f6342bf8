import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from marquee.operators.filters import assign_year_range
from marquee.plans import normalize
from marquee.plans.publish import publish, run_jobs
from marquee.schemas import DIM_GENRES, FCT_TITLES, TITLE_TABLES
from marquee.session import FILES_OPEN, WRITERS, unsorted_writes
from marquee.sinks import (
    create_country_table,
    create_database,
    load_countries,
    published_path,
    register_staging,
    register_tables,
    snapshots,
    table_path,
    write_staging,
    write_table,
)
from marquee.sinks.files import KIND, TITLES, write_run
from marquee.sources import read_staging
from rows import bag, genre, ids, node, offer, staging

RANGES = ((1991, 2000), (2001, 2010))


def ranged(spark, *records):
    return assign_year_range(staging(spark, *records))


@pytest.mark.parametrize("fmt", ["parquet", "json"])
@pytest.mark.parametrize("rebalance", [False, True])
def test_staging_round_trip(spark, tmp_path, fmt, rebalance):
    df = ranged(
        spark, node("a", 1995, offers=[offer("1", "Hulu"), None]), node("b", 2005, genres=None)
    )
    write_staging(df, str(tmp_path / "s"), fmt, RANGES, rebalance)
    back = read_staging(spark, str(tmp_path / "s"), fmt)
    assert bag(back.select(df.columns)) == bag(df)
    assert snapshots.current(spark, str(tmp_path / "s")).units["1991_2000"]["folder"].endswith("/year_min=1991/year_max=2000")


def test_staging_replaces_only_its_ranges(spark, tmp_path):
    path = str(tmp_path / "s")
    write_staging(ranged(spark, node("a", 1995), node("b", 2005), node("c", 2011)), path)
    write_staging(ranged(spark, node("d", 1996)), path)
    assert ids(read_staging(spark, path)) == ["b", "c", "d"]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_range_without_titles_is_emptied(spark, tmp_path, fmt):
    path = str(tmp_path / "s")
    write_staging(ranged(spark, node("a", 1995), node("b", 2005), node("c", 2011)), path, fmt)
    write_staging(ranged(spark, node("d", 1996)), path, fmt, RANGES)
    assert ids(read_staging(spark, path, fmt)) == ["c", "d"]
    write_staging(ranged(spark), path, fmt, RANGES)
    assert ids(read_staging(spark, path, fmt)) == ["c"]


def test_staging_table_by_name(spark, tmp_path):
    write_staging(ranged(spark, node("a", 1995)), str(tmp_path / "s"))
    read_staging(spark, str(tmp_path / "s")).createOrReplaceTempView("staged")
    assert ids(read_staging(spark, "staged", "table")) == ["a"]


def test_tables_are_overwritten_with_contract_types(spark, tmp_path):
    root = str(tmp_path)
    write_table(normalize.titles(staging(spark, node("a"), node("b"))), FCT_TITLES, root)
    write_table(normalize.titles(staging(spark, node("c"))), FCT_TITLES, root)
    back = spark.read.parquet(table_path(FCT_TITLES, root))
    assert back.dtypes == [(f.name, f.dataType.simpleString()) for f in FCT_TITLES.schema]
    assert [r.title_id for r in back.collect()] == ["c"]


def test_write_casts_to_the_contract(spark, tmp_path):
    df = spark.sql("select 7 as name, 'x' as genre_id, 1 as extra")
    back = spark.read.parquet(write_table(df, DIM_GENRES, str(tmp_path)))
    assert bag(back) == [("x", "7")]


def test_job_must_not_overwrite_its_source(spark, tmp_path):
    write_staging(ranged(spark, node("a", 1995)), str(tmp_path / "titles"))
    with pytest.raises(ValueError, match="overlap"):
        run_jobs(spark, str(tmp_path / "titles"), str(tmp_path))
    assert ids(read_staging(spark, str(tmp_path / "titles"))) == ["a"]
    with pytest.raises(ValueError, match="unknown"):
        run_jobs(spark, str(tmp_path / "titles"), str(tmp_path / "out"), only=("nope",))


def test_country_table(spark):
    create_database(spark, "lands")
    create_database(spark, "lands")
    table = create_country_table(spark, "lands")
    rows = [
        ("Côte d'Ivoire", "CI", "CIV"), ("Korea, Republic of", "KR", "KOR"), ("Zambia", "ZM", "ZMB"),
    ]
    df = spark.createDataFrame(rows, "name string, alpha2_code string, alpha3_code string")
    load_countries(spark, df, "lands")
    flag = "https://cdn.worlddata.info/pics/flags3d/{}.png"
    assert bag(spark.table(table)) == sorted((*r, flag.format(r[2])) for r in rows)
    load_countries(spark, df.where("alpha2_code = 'ZM'"), "lands")
    assert spark.table(table).count() == 4
    load_countries(spark, df, "lands", overwrite=True)
    assert spark.table(table).count() == 3
    own_flag = spark.createDataFrame(
        [("f.png", "ZMB", "ZM", "Zambia")], "flag string, alpha3_code string, alpha2_code string, name string"
    )
    load_countries(spark, own_flag, "lands", overwrite=True)
    assert bag(spark.table(table)) == [("Zambia", "ZM", "ZMB", "f.png")]
    long = spark.createDataFrame([("x" * 257, "A", "B", "C")], spark.table(table).schema)
    with pytest.raises(Exception, match="EXCEED|exceed"):
        load_countries(spark, long, "lands")


def test_publish_and_read_by_name(spark, tmp_path):
    staged, root = str(tmp_path / "s"), str(tmp_path / "out")
    write_staging(ranged(spark, node("a", 1995), node("b", 2005, genres=[genre("w")])), staged)
    assert run_jobs(spark, staged, root) == [c.name for c in TITLE_TABLES]
    countries = spark.createDataFrame(
        [("Zambia", "ZM", "ZMB")], "name string, alpha2_code string, alpha3_code string"
    )
    for _ in range(2):
        publish(spark, "shop", root, countries)
    for contract in TITLE_TABLES:
        table = spark.table(f"shop.{contract.name}")
        assert table.dtypes == [(f.name, f.dataType.simpleString()) for f in contract.schema]
        assert bag(table) == bag(spark.read.parquet(published_path(spark, contract, root)))
    assert spark.table("shop.dim_countries").count() == 1
    assert {r.genre_id for r in spark.table("shop.dim_genres").collect()} == {"drm", "w"}

    # A later run writes new files; the table shows them after registering again.
    write_staging(ranged(spark, node("c", 1995, genres=[genre("n")])), staged)
    run_jobs(spark, staged, root, only=("dim_genres",))
    register_tables(spark, "shop", root)
    assert {r.genre_id for r in spark.table("shop.dim_genres").collect()} == {"n", "w"}


def test_staging_without_year_range_is_refused(spark, tmp_path):
    path = str(tmp_path / "s")
    write_staging(ranged(spark, node("a", 1995)), path)
    bad = staging(spark, node("b")).selectExpr("*", "CAST(NULL AS INT) AS year_min", "2000 AS year_max")
    with pytest.raises(Exception, match="without year range"):
        write_staging(bad, path)
    assert ids(read_staging(spark, path)) == ["a"]


def test_a_write_that_ends_early_changes_nothing(spark, tmp_path):
    """One range is written, the next fails: readers keep what they had, of both."""
    path = str(tmp_path / "s")
    write_staging(ranged(spark, node("a", 1995), node("b", 2005)), path)
    fails = F.when(F.col("id") == "d", F.raise_error(F.lit("lost"))).otherwise(F.col("content_title"))
    rows = ranged(spark, node("c", 1995), node("d", 2005)).withColumn("content_title", fails.cast("string"))
    with pytest.raises(Exception, match="lost"):
        write_staging(rows.repartitionByRange(2, "id"), path, ranges=RANGES)
    assert ids(read_staging(spark, path)) == ["a", "b"]
    # A run that was killed before it published is not read either, and goes when it is old.
    write_run(ranged(spark, node("e", 1995)).withColumn(KIND, F.lit(TITLES)), path)
    assert ids(read_staging(spark, path)) == ["a", "b"]
    assert len(snapshots.names_below(spark, path, "run=*")) == 2
    snapshots.expire(spark, path, abandoned=0)
    assert len(snapshots.names_below(spark, path, "run=*")) == 1
    assert ids(read_staging(spark, path)) == ["a", "b"]


def test_readers_keep_their_snapshot_for_one_more_run(spark, tmp_path):
    path = str(tmp_path / "s")
    write_staging(ranged(spark, node("a", 1995)), path)
    reader = read_staging(spark, path)
    write_staging(ranged(spark, node("b", 1995)), path)
    assert ids(reader) == ["a"] and ids(read_staging(spark, path)) == ["b"]
    write_staging(ranged(spark, node("c", 1995)), path)
    assert len(snapshots.names_below(spark, path, "run=*")) == 2 and ids(read_staging(spark, path)) == ["c"]


def test_overlapping_ranges_are_refused(spark, tmp_path):
    path = str(tmp_path / "s")
    write_staging(ranged(spark, node("a", 1995)), path)
    other = staging(spark, node("b")).selectExpr("*", "1995 AS year_min", "2005 AS year_max")
    with pytest.raises(ValueError, match="1995-2005 overlaps 1991-2000"):
        write_staging(other, path)
    assert ids(read_staging(spark, path)) == ["a"]


def test_plain_folders_are_read_and_taken_over(spark, tmp_path):
    path = str(tmp_path / "s")
    ranged(spark, node("a", 1995), node("b", 2005)).write.partitionBy("year_min", "year_max").parquet(path)
    assert ids(read_staging(spark, path)) == ["a", "b"]
    write_staging(ranged(spark, node("c", 1996)), path)
    rows = read_staging(spark, path)
    assert bag(rows.select("id", "year_min", "year_max")) == [("b", 2001, 2010), ("c", 1991, 2000)]


def test_two_commits_at_once(spark, tmp_path):
    """A run that publishes while another one is about to goes first; nothing is lost."""
    root = str(tmp_path / "r")

    def change(units):
        if "second" not in units and "first" not in units:
            snapshots.commit(spark, root, snapshots.replaced({"second": "run=r-2/x"}))
        return {**units, "first": {"folder": "run=r-1/x"}}

    done = snapshots.commit(spark, root, change)
    assert done.number == 2 and set(done.units) == {"first", "second"}
    assert snapshots.current(spark, root) == done and snapshots.current(spark, str(tmp_path / "none")) is None


def test_staging_table_follows_the_snapshot(spark, tmp_path):
    path = str(tmp_path / "s")
    write_staging(ranged(spark, node("a", 1995), node("b", 2005)), path)
    create_database(spark, "followed", str(tmp_path / "db"))
    for change, found in ((None, ["a", "b"]), (ranged(spark, node("c", 2005)), ["a", "c"])):
        if change is not None:
            write_staging(change, path)
        assert ids(read_staging(spark, register_staging(spark, "followed", path), "table")) == found
    write_staging(ranged(spark).limit(0), path, ranges=[(2001, 2010)])
    assert ids(spark.table(register_staging(spark, "followed", path))) == ["a"]


def test_failing_job_leaves_all_tables(spark, tmp_path):
    staged, root = str(tmp_path / "s"), str(tmp_path / "out")
    write_staging(ranged(spark, node("a", 1995)), staged)
    run_jobs(spark, staged, root)
    read = lambda: {c.name: bag(spark.read.parquet(published_path(spark, c, root))) for c in TITLE_TABLES}
    before = read()
    bad = staging(spark, node("z", 40000)).selectExpr("*", "1991 AS year_min", "2000 AS year_max")
    write_staging(bad, staged)
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        run_jobs(spark, staged, root)
    assert read() == before
    run_jobs(spark, staged, root, only=("dim_genres", "dim_titles_genres"))
    now = read()
    assert now["dim_titles_genres"] == [("z", "drm")] and now["fct_titles"] == before["fct_titles"]


def test_old_generations_are_deleted_when_nobody_points_at_them(spark, tmp_path):
    staged, root = str(tmp_path / "s"), str(tmp_path / "out")
    write_staging(ranged(spark, node("a", 1995)), staged)
    for _ in range(4):
        run_jobs(spark, staged, root)
    assert len(snapshots.names_below(spark, root, "run=*")) == 4
    create_database(spark, "old", str(tmp_path / "db"))
    register_tables(spark, "old", root)
    for _ in range(3):
        run_jobs(spark, staged, root, only=("dim_genres",))
        # The registered tables still stand where they did.
        assert spark.table("old.fct_titles").count() == 1 and spark.table("old.dim_genres").count() == 1
    with pytest.warns(UserWarning, match="no countries"):
        publish(spark, "old", root)
    # The present one of all tables but one, and that one's, now and before.
    assert len(snapshots.names_below(spark, root, "run=*")) == 3
    assert all(spark.table(f"old.{c.name}").count() == 1 for c in TITLE_TABLES)
    with pytest.raises(FileNotFoundError, match="never published"):
        write_staging(ranged(spark, node("a", 1995)), staged)
        run_jobs(spark, staged, str(tmp_path / "other"), only=("dim_genres",))
        register_tables(spark, "old", str(tmp_path / "other"))


def test_json_staging_is_packed(spark, tmp_path):
    path = str(tmp_path / "s")
    write_staging(ranged(spark, node("a", 1995), node("b", 2005)), path, "json", RANGES)
    files = list((tmp_path / "s").rglob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert ids(read_staging(spark, path, "json")) == ["a", "b"]


def test_published_tables_hold_repeated_titles_once(spark, tmp_path):
    records = [node("a", 1995), node("a", 1995), node("b", 1995, offers=[offer("1", "S"), offer("1", "S")])]
    for name, rows in (("several", records), ("one", records[1:])):
        path, root = str(tmp_path / name), str(tmp_path / f"{name}-tables")
        write_staging(ranged(spark, *rows), path, ranges=RANGES)
        run_jobs(spark, path, root)
        for contract, job in normalize.JOBS:
            table = spark.read.parquet(published_path(spark, contract, root))
            assert bag(table) == bag(job(read_staging(spark, path)))
            assert table.count() == table.distinct().count() > 0


def test_staging_is_written_unsorted(spark, tmp_path, monkeypatch):
    seen, save = [], DataFrameWriter.save

    def noted(self, *args, **kwargs):
        seen.append(spark.conf.get(WRITERS, None))
        return save(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "save", noted)
    write_run(ranged(spark, node("a", 1995), node("b", 2005)).withColumn(KIND, F.lit(TITLES)), str(tmp_path / "s"))
    assert seen == [str(FILES_OPEN)] and spark.conf.get(WRITERS, None) is None


def test_unsorted_writes_leave_the_setting_as_it_was(spark, tmp_path):
    folders = FILES_OPEN + 36
    df = spark.range(5 * folders).withColumn("folder", F.col("id") % folders).repartition(2)
    spark.conf.set(WRITERS, "3")
    try:
        with unsorted_writes(spark):
            with unsorted_writes(spark):
                df.write.partitionBy("folder").parquet(str(tmp_path / "many"))
            assert spark.conf.get(WRITERS) == str(FILES_OPEN)
        assert spark.conf.get(WRITERS) == "3"
    finally:
        spark.conf.unset(WRITERS)
    back = spark.read.parquet(str(tmp_path / "many")).select(df.columns)
    assert bag(back.withColumn("folder", F.col("folder").cast("long"))) == bag(df)
