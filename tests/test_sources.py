import json

import pandas as pd
import pytest

from marquee.schemas import STAGING
from marquee.sources import (
    read_concatenated_json,
    read_pages,
    read_service_catalogue,
    read_service_selection,
    read_staging,
)
from rows import bag, ids, node, page


def land(root, record, indent=None):
    record = dict(record)
    folder = root / f"min={record.pop('min')}" / f"max={record.pop('max')}"
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"page_{record['page_no']}.json"
    path.write_text(json.dumps(record, indent=indent), encoding="utf-8")


@pytest.mark.parametrize("multi_line,indent", [(True, 4), (True, None), (False, None)])
def test_pages(spark, tmp_path, multi_line, indent):
    land(tmp_path, page(1, [node("a"), node("é")], end="x", more=True, total=3), indent)
    land(tmp_path, page(2, [node("c", offers=None)], sent="x", total=3), indent)
    land(tmp_path, page(1, [], low=2001, high=2010), indent)
    df = read_pages(spark, str(tmp_path), multi_line)
    found = bag(df.selectExpr("min", "max", "page_no", "data.popularTitles.edges.node.id"))
    assert found == [(1991, 2000, 1, ["a", "é"]), (1991, 2000, 2, ["c"]), (2001, 2010, 1, [])]


def test_broken_page_fails(spark, tmp_path):
    folder = tmp_path / "min=1991" / "max=2000"
    folder.mkdir(parents=True)
    (folder / "page_1.json").write_text('{"page_no": 1, "status": ')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        read_pages(spark, str(tmp_path)).collect()


def test_service_lists(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        '{"code":"nfx", "clear_name":"Netflix"}\n{"code":"hlu", "clear_name":"Hulu"}', "utf-8"
    )
    assert bag(read_service_selection(spark, str(tmp_path / "s.json"))) == [
        ("hlu", "Hulu"), ("nfx", "Netflix"),
    ]
    (tmp_path / "c.csv").write_text(
        'code,streaming_name,lcase_name\naae,A&E,a_e\nxyz,"Comma, Inc",comma_inc\nhiy,Hi-YAH,hi-yah\n',
        "utf-8",
    )
    assert bag(read_service_catalogue(spark, str(tmp_path / "c.csv"))) == [
        ("aae", "A&E", "a_e"), ("hiy", "Hi-YAH", "hi-yah"), ("xyz", "Comma, Inc", "comma_inc"),
    ]


def test_catalogue_with_other_columns_fails(spark, tmp_path):
    (tmp_path / "c.csv").write_text("streaming_name,code,lcase_name\nA&E,aae,a_e\n", "utf-8")
    with pytest.raises(Exception, match="[Hh]eader"):
        read_service_catalogue(spark, str(tmp_path / "c.csv")).collect()


def legacy(path, records, indent=4):
    flat = pd.json_normalize(records, sep="_", max_level=5)
    flat.to_json(path, orient="records", lines=True, indent=indent)


HARD = 'brace\n}\n{ "quoted" /slash\n    }\n é 漢 \\ end'


def test_legacy_files(spark, tmp_path):
    legacy(tmp_path / "titles_1991_2000.json", [
        node("a", text=HARD, seasons=3.0), node("b", genres=None, offers=None), node("c"),
    ])
    legacy(tmp_path / "titles_2001_2010.json", [node("d", genres=[])])
    legacy(tmp_path / "titles_2011_2012.json", [])
    df = read_concatenated_json(spark, str(tmp_path))
    assert df.schema == STAGING
    rows = {r.id: r for r in df.collect()}
    assert sorted(rows) == ["a", "b", "c", "d"]
    assert rows["a"].content_shortDescription == HARD
    assert rows["a"].totalSeasonCount == 3.0 and rows["c"].totalSeasonCount is None
    assert rows["b"].content_genres is None and rows["d"].content_genres == []
    assert rows["a"].offers[0].package.clearName == "Hulu"


def test_legacy_whole_numbers_with_a_point(spark, tmp_path):
    """A null in the file turns the numbers of the column into floats."""
    legacy(tmp_path / "f.json", [node("a", 1995, runtime=90), node("b", None, runtime=None)])
    assert '"content_runtime":90.0' in (tmp_path / "f.json").read_text()
    df = read_concatenated_json(spark, str(tmp_path))
    assert df.schema == STAGING
    got = bag(df.select("id", "content_runtime", "content_originalReleaseYear"))
    assert got == [("a", 90, 1995), ("b", None, None)]
    legacy(tmp_path / "f.json", [node("a", runtime=90.5)])
    with pytest.raises(Exception, match="not a whole number: 90.5"):
        read_concatenated_json(spark, str(tmp_path)).collect()


def test_json_lines_staging_with_float_numbers(spark, tmp_path):
    folder = tmp_path / "year_min=1991" / "year_max=2000"
    folder.mkdir(parents=True)
    legacy(folder / "f.json", [node("a", 1995), node("b", None, runtime=None)], indent=None)
    df = read_staging(spark, str(tmp_path), "json")
    assert df.schema[: len(STAGING)] == STAGING
    got = bag(df.select("id", "content_runtime", "content_originalReleaseYear", "year_min"))
    assert got == [("a", 90, 1995, 1991), ("b", None, None, 1991)]


@pytest.mark.parametrize("end", ["", "\n", "\n\n", "  \r\n"])
def test_legacy_file_endings(spark, tmp_path, end):
    legacy(tmp_path / "f.json", [node("a"), node("b")])
    text = (tmp_path / "f.json").read_text().rstrip() + end
    (tmp_path / "f.json").write_text(text)
    assert ids(read_concatenated_json(spark, str(tmp_path))) == ["a", "b"]


def test_legacy_file_cut_into_many_splits(spark, tmp_path):
    records = [node(f"n{i:03d}", text=HARD * (i % 7)) for i in range(300)]
    legacy(tmp_path / "f.json", records)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = read_concatenated_json(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 10
        got = {r.id: r.content_shortDescription for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {r["id"]: r["content"]["shortDescription"] for r in records}


def test_damaged_legacy_record_fails(spark, tmp_path):
    (tmp_path / "f.json").write_text('\n    {\n        "id":"a",\n    oops\n    }\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        read_concatenated_json(spark, str(tmp_path)).collect()
