import pytest
from pyspark.sql import functions as F

from marquee.operators.flatten import flatten, seasons_of_shows
from rows import ids, node, nodes, staging


def nest(depth):
    column = F.lit(1)
    for name in reversed("abcdefgh"[1:depth]):
        column = F.struct(column.alias(name))
    return column.alias("a")


def test_depth_bound(spark):
    one = spark.range(1)
    assert flatten(one.select(nest(8))).columns == ["a_b_c_d_e_f"]
    assert flatten(one.select(nest(8))).schema[0].dataType.simpleString() == "struct<g:struct<h:int>>"
    assert flatten(one.select(nest(6))).schema[0].dataType.simpleString() == "int"
    assert flatten(one.select(nest(3)), ".", 1).columns == ["a.b"]
    assert flatten(one.select(nest(3)), max_level=0).columns == ["a"]


def test_arrays_stay_whole_and_odd_names_survive(spark):
    df = spark.sql("select array(struct(1 as x)) as arr, struct(2 as `p.q`, 3 as `r``s`) as t")
    flat = flatten(df)
    assert flat.columns == ["arr", "t_p.q", "t_r`s"]
    assert tuple(flat.first())[1:] == (2, 3)


def test_clashing_names_raise(spark):
    with pytest.raises(ValueError, match="a_b"):
        flatten(spark.sql("select struct(1 as b) as a, 2 as a_b"))
    with pytest.raises(ValueError, match="a_b"):
        flatten(spark.sql("select struct(1 as b) as a, 2 as A_B"))


def test_null_struct_adds_no_column(spark):
    row = staging(spark, node("a", scoring=None)).first()
    assert "content_scoring" not in row.asDict()
    assert row.content_scoring_imdbScore is None


def test_season_count_is_for_shows(spark):
    df = nodes(spark, node("m", seasons=4.0), node("s", kind="SHOW", seasons=2.0))
    out = seasons_of_shows(df)
    assert {r.id: r.totalSeasonCount for r in out.collect()} == {"m": None, "s": 2.0}
    assert ids(out) == ["m", "s"]
