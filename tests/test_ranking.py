import random

import pytest
from pyspark.sql import functions as F

from marquee.operators import ranking
from marquee.operators.ranking import POPULARITY
from marquee.session import written


def frame(spark, rows, parts=5):
    df = spark.createDataFrame(
        rows, f"id string, {POPULARITY} double, year_min int, year_max int"
    )
    return df.repartition(parts)


def titles(count, seed=1):
    rng = random.Random(seed)
    # One range holds most titles, and a third of all popularities is one value or null.
    out = []
    for i in range(count):
        value = rng.choice([None, 7.0, 7.0, float(rng.randrange(50)), rng.random() * 100])
        low, high = rng.choice([(1991, 2000)] * 4 + [(2001, 2010)])
        out.append((f"t{i:05d}", value, low, high))
    return out


def expected(rows):
    return sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0.0), r[0]))


def test_order_and_first_page(spark):
    rows = titles(300)
    df = frame(spark, rows)
    want = [r[0] for r in expected(rows)]
    assert [r.id for r in ranking.by_popularity(df).collect()] == want
    assert [r.id for r in ranking.first_page(df, 40).collect()] == want[:40]


@pytest.mark.parametrize("size", [1, 7, 40, 1000])
def test_walking_the_pages_gives_every_title_once(spark, size):
    rows = titles(30)
    df = frame(spark, rows, 2)
    page, walked = ranking.first_page(df, size), []
    while True:
        batch = [r.id for r in page.collect()]
        walked += batch
        cursor = ranking.end_cursor(page)
        if cursor is None:
            break
        page = ranking.next_page(df, cursor, size)
    assert walked == [r[0] for r in expected(rows)]


@pytest.mark.parametrize("parts", [1, 6])
def test_page_numbers_equal_a_plain_ranking(spark, parts):
    rows = titles(2000, parts)
    numbered = ranking.number_pages(frame(spark, rows, parts), size=9)
    got = {r.id: (r.year_min, r["rank"], r.page_no) for r in numbered.collect()}
    want = {}
    for low in (1991, 2001):
        for place, row in enumerate(expected([r for r in rows if r[2] == low]), 1):
            want[row[0]] = (low, place, (place - 1) // 9 + 1)
    assert got == want


@pytest.mark.parametrize(
    "rows",
    [
        [(f"t{i:05d}", float(i % 3), 1991, 2000) for i in range(4000)],
        [("copy", 1.0, 1991, 2000)] * 4000,
    ],
    ids=["one range", "copies of one title"],
)
def test_numbering_spreads_hot_groups(spark, monkeypatch, rows):
    blocks = []

    def spy(df, label):
        kept = written(df, label)
        blocks.append(kept.groupBy(F.shiftright("position", 33)).count().collect())
        return kept

    monkeypatch.setattr(ranking, "written", spy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = ranking.number_pages(frame(spark, rows, 16), size=10)
        assert sorted(r["rank"] for r in numbered.collect()) == list(range(1, 4001))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in blocks[0]]
    assert len(sizes) > 2 and max(sizes) < 2000


def test_kept_columns_travel_along(spark):
    df = frame(spark, titles(50)).withColumn("more", F.struct("id", F.lit(1)))
    numbered = ranking.number_pages(df, keep=("more",))
    assert numbered.where("more.id = id").count() == 50


def test_empty(spark):
    df = frame(spark, [])
    assert ranking.number_pages(df).count() == 0
    assert ranking.end_cursor(ranking.first_page(df)) is None
