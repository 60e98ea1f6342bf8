import pytest

from marquee.operators.pages import (
    audit_pages,
    failed_pages,
    ok_pages,
    page_errors,
    union_all,
    unwrap_edges,
)
from rows import bag, error, ids, node, page, pages

A, B, C = node("a"), node("b"), node("c")
GOOD = [
    page(1, [A], None, "x", True, 3),
    page(2, [B], "x", "y", True, 3),
    page(3, [C], "y", "z", False, 3),
]


def verdict(spark, *records):
    return {r["min"]: r["complete"] for r in audit_pages(pages(spark, *records)).collect()}


def changed(number, **changes):
    out = [dict(p) for p in GOOD]
    p = out[number - 1]
    info = {k: changes.pop(k) for k in ("endCursor", "hasNextPage") if k in changes}
    if info or "totalCount" in changes:
        popular = dict(p["data"]["popularTitles"])
        popular["pageInfo"] = {**popular["pageInfo"], **info}
        popular["totalCount"] = changes.pop("totalCount", popular["totalCount"])
        p["data"] = {"popularTitles": popular}
    p.update(changes)
    return out


def test_complete(spark):
    (row,) = audit_pages(pages(spark, *GOOD)).collect()
    assert tuple(row) == (1991, 2000, 3, 0, 3, 3, True)
    assert verdict(spark, page(1, [], total=0)) == {1991: True}
    assert verdict(spark, page(1, [A], sent="")) == {1991: True}


@pytest.mark.parametrize(
    "records",
    [
        changed(2, cursor_sent="other"),
        changed(2, cursor_sent=None),
        changed(1, cursor_sent="w"),
        changed(1, endCursor=None),
        changed(2, hasNextPage=False),
        changed(3, hasNextPage=True),
        changed(3, hasNextPage=None),
        changed(3, totalCount=4),
        changed(2, totalCount=None, page_no=2, cursor_sent=None),
        changed(3, page_no=4),
        GOOD[:2],
        GOOD[1:],
        [GOOD[0], GOOD[2]],
        [*GOOD, GOOD[1]],
        [GOOD[0], {**GOOD[1], "page_no": 3}, {**GOOD[2], "page_no": 2}],
        [page(1, [A, B], total=3)],
        [*GOOD, page(4, [], sent="z", status=500)],
    ],
)
def test_incomplete(spark, records):
    assert verdict(spark, *records) == {1991: False}


def test_page_without_result_failed(spark):
    empty = [{**GOOD[0], "data": None}, {**GOOD[0], "data": {"popularTitles": None}}]
    for record in empty:
        (row,) = audit_pages(pages(spark, record)).collect()
        assert (row.failed, row.complete) == (1, False)


def test_ranges_are_judged_apart(spark):
    other = [page(1, [A], total=2, low=2001, high=2010)]
    assert verdict(spark, *GOOD, *other) == {1991: True, 2001: False}


def test_many_copies_of_one_page(spark):
    df = pages(spark, *GOOD)
    copies = df.where("page_no = 2").crossJoin(spark.range(2000)).drop("id")
    (row,) = audit_pages(df.unionByName(copies)).collect()
    assert (row.pages, row.titles, row.complete) == (2003, 2003, False)


def test_status_split_loses_nothing(spark):
    df = pages(spark, GOOD[0], page(2, [], status=500), {**GOOD[2], "status": None})
    assert ok_pages(df).count() == 1
    assert failed_pages(df).count() == 2


def test_errors(spark):
    bare = {"message": "plain", "locations": None, "extensions": None}
    df = pages(
        spark,
        GOOD[0],
        page(2, [], status=500, errors=[error("first"), error("second", "E2")]),
        page(3, [], status=404, errors=[bare]),
        page(4, [], status=500, errors=None),
        page(5, [A], errors=[error("beside")]),
    )
    assert bag(page_errors(df).select("page_no", "error_text")) == [
        (2, '{"code":"E1"} : [{"line":3,"column":4}] : first'),
        (2, '{"code":"E2"} : [{"line":3,"column":4}] : second'),
        (3, "null : null : plain"),
        (4, "failed without a listed error"),
        (5, '{"code":"E1"} : [{"line":3,"column":4}] : beside'),
    ]
    assert bag(page_errors(df).where("answered").select("page_no")) == [(5,)]


def test_unwrap_edges(spark):
    df = pages(spark, page(1, [A, B]), page(2, []), page(3, [C], status=500), page(4, [A]))
    out = unwrap_edges(df)
    assert ids(out) == ["a", "a", "b"]
    names = ["id", "objectType", "content", "offers", "totalSeasonCount"]
    assert out.columns == [*names, "min", "max"]
    assert unwrap_edges(df.drop("min", "max")).columns == names


def test_union_keeps_copies_and_fills_columns(spark):
    a = spark.sql("select 1 as x, 2 as y")
    b = spark.sql("select 2 as y, 1 as x")
    c = spark.sql("select 5 as x")
    assert bag(union_all([a, b, c])) == [(1, 2), (1, 2), (5, None)]
