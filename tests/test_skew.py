"""All registered queries over tables where single keys hold a third of the rows."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from marquee.adapters.order_tables import staging_titles
from marquee.plans.check_sql import SQL
from marquee.plans.checks import QUERIES

LINES = 9_000


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """Order 7 has a third of all line items, all different; order 9 has a third, all
    copies of one; one part and one supplier hold a third as well. A third of all rows of
    the orders are copies of one order. Most orders fall into one year range and share one
    price."""
    rng = random.Random(5)
    root = tmp_path_factory.mktemp("skewed")
    lines = []
    for i in range(LINES):
        if i % 3 == 0:
            row = (7, rng.randrange(30), rng.randrange(20), i)
        elif i % 3 == 1:
            row = (9, 4, 4, 1)
        else:
            # Orders 180 to 199 have no line item; parts and suppliers 30, 20 do not exist.
            row = (rng.choice([*range(180), 200]), rng.randrange(31), rng.randrange(21), rng.randrange(7))
        lines.append(row)
    tables = {
        "lineitem": pd.DataFrame(
            lines, columns=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
        ).astype({"l_linenumber": "int32"}),
        "orders": pd.DataFrame(
            [
                (
                    k, rng.randrange(50), rng.choice("OPF"),
                    None if k % 11 == 0 else 1000.5 if k % 3 else float(rng.randrange(900)),
                    None if k % 37 == 0 else datetime.datetime(
                        rng.choice([1995, 1996, 1999, 2000, 2001, 2024]), 5, 1),
                    rng.choice(["1-URGENT", "2-HIGH", "5-LOW"]),
                )
                for k in range(200)
            ]
            + [(200, 3, "O", 55.5, datetime.datetime(1996, 5, 1), "2-HIGH")] * 100,
            columns=["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                     "o_orderpriority"],
        ),
        "part": pd.DataFrame(
            [(k, rng.choice(["PROMO", "ECONOMY", "SMALL", "LARGE"])) for k in range(30)],
            columns=["p_partkey", "p_type"],
        ),
        "supplier": pd.DataFrame(
            [(k, f"Supplier#{k:09d}", k % 25) for k in range(20)],
            columns=["s_suppkey", "s_name", "s_nationkey"],
        ).astype({"s_nationkey": "int32"}),
        "nation": pd.DataFrame(
            [(k, f"NATION_{k}") for k in range(25)], columns=["n_nationkey", "n_name"]
        ).astype({"n_nationkey": "int32"}),
    }
    for name, frame in tables.items():
        frame.to_parquet(root / f"{name}.parquet", index=False, coerce_timestamps="us")
    return str(root)


@pytest.fixture(scope="module")
def con(skewed):
    return connect(skewed)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, skewed, con, name):
    assert difference(QUERIES[name](spark, skewed), con, SQL[name]) is None


# Queries that see titles with their offers spread over several records.
SPREAD = [n for n in QUERIES if "offer" in n or "service" in n and not n.startswith(("service", "whole"))]


@pytest.mark.parametrize("limit", [1, 4, 50, 10_000])
def test_queries_do_not_depend_on_the_split(spark, skewed, con, limit, monkeypatch):
    defaults = staging_titles.__defaults__
    monkeypatch.setattr(staging_titles, "__defaults__", (*defaults[:-1], limit))
    assert staging_titles(spark, skewed, ("offers",)).where("part > 0").isEmpty() == (limit == 10_000)
    for name in SPREAD:
        assert difference(QUERIES[name](spark, skewed), con, SQL[name]) is None, name


def test_no_staging_record_grows_with_its_order(spark, skewed):
    records = staging_titles(spark, skewed, ("offers",), max_offers=100)
    sizes = records.select("id", F.size("offers").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] < 200
    assert sizes.where("id = 'tt7'").count() > 25

