import pytest
from pyspark.sql import functions as F

from marquee.functions import intervals, year_ranges
from marquee.functions.years import OPEN_HIGH, OPEN_LOW, is_open, range_ends, range_number, show, uncovered
from marquee.plans.stage import asked_units, landed_units, needed_requests


def test_intervals_cover_every_year():
    units = intervals()
    assert units[0] == (OPEN_LOW, 1899) and units[-1] == (2024, OPEN_HIGH) and units[1:-1] == year_ranges()
    assert all(a[1] + 1 == b[0] for a, b in zip(units, units[1:]))
    assert intervals((1999, 2009)) == ((OPEN_LOW, 1999), (2000, 2009), (2010, OPEN_HIGH))
    assert [is_open(u) for u in intervals((1999, 2009))] == [True, False, True]
    for bad in ((2000,), (2000, 2000), (2010, 2000), (1999, OPEN_HIGH), (OPEN_LOW - 1, 2000)):
        with pytest.raises(ValueError, match="boundaries"):
            intervals(bad)


def test_show():
    assert [show(u) for u in intervals((1999, 2009))] == ["-1999", "2000-2009", "2010-"]


@pytest.mark.parametrize("unit, requested, outer, whole", [
    ((1991, 2000), [(1991, 2000)], (1991, 2000), True),
    ((1991, 2000), [(1996, 2005), (1980, 1995)], (1991, 2000), True),
    ((1991, 2000), [(1991, 1994), (1996, 2000)], (1991, 2000), False),
    ((1991, 2000), [(1992, 2000)], (1992, 2000), False),
    ((1991, 2000), [(2001, 2010)], None, False),
    ((2024, OPEN_HIGH), [(2021, 2026)], (2024, 2026), True),
    ((2024, OPEN_HIGH), [(2025, 2026)], (2025, 2026), False),
    ((2024, OPEN_HIGH), [(2024, 2024), (2026, 2030)], (2024, 2030), False),
    ((2024, OPEN_HIGH), [(2024, 20_000)], (2024, OPEN_HIGH), True),
    ((OPEN_LOW, 1899), [(1880, 1900)], (1880, 1899), True),
    ((OPEN_LOW, 1899), [(1880, 1890)], (1880, 1890), False),
])
def test_uncovered(unit, requested, outer, whole):
    assert uncovered(unit, requested) == (outer, whole)


def test_range_numbers(spark):
    units = intervals((1999, 2009))
    rows = spark.createDataFrame([(y,) for y in (-20_000, -9999, 1999, 2000, 2009, 2010, 9999, 10_000, None)], "y int")
    low, high = range_ends("n", units)
    found = [tuple(r) for r in rows.withColumn("n", range_number("y", units)).select("n", low.alias("low"), high.alias("high")).collect()]
    none = (None, None, None)
    assert found == [none, *[(0, *units[0])] * 2, *[(1, *units[1])] * 2, *[(2, *units[2])] * 2, none, none]
    assert rows.select(range_number("y", ()).alias("n")).where(F.col("n").isNotNull()).count() == 0


def test_asked_units():
    units = intervals((1999, 2009))
    assert asked_units(None, units) == units
    assert asked_units([(2024, 2026), (2000, 2009), (2030, 2031)], units) == (units[2], units[1])
    with pytest.raises(ValueError, match="2000-2005 is no staging range"):
        asked_units([(2000, 2005)], units)


def test_needed_requests_are_closed_under_overlap():
    units = intervals((1999, 2009, 2019))
    requests = [(1990, 1999), (2000, 2004), (2005, 2012), (2013, 2019), (2020, 2030), (None, None), (9, 3)]
    assert needed_requests(requests, [], units) == []
    assert needed_requests(requests, [(2013, 2019)], units) == [(2000, 2004), (2005, 2012), (2013, 2019)]
    assert set(needed_requests(requests, [(None, None), (9, 3), (2020, 2030)], units)) == {(None, None), (9, 3), (2020, 2030)}


def test_landed_units():
    units = intervals((1999, 2009))
    staged = {"2010_9999": {"requested": [2010, 2015]}}
    found, partly, missing = landed_units([(2000, 2012)], units, False, staged)
    assert found == {units[1]: (2000, 2009), units[2]: (2010, 2012)} and partly == [units[2]] and missing == []
    found, partly, missing = landed_units([(2000, 2015)], (units[0], units[2]), True, staged)
    assert found == {units[2]: (2010, 2015)} and partly == [] and missing == [units[0]]
