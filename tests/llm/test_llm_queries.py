import sys

import pytest

from compare import connect, difference
from marquee.llm.registry import QUERIES, SQL

TYPES_LEFT_OUT = {"spans"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, len(numbers) + 1))


def test_entry_has_them():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert "marquee.llm" in sys.modules
