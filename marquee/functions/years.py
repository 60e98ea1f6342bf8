"""Release-year ranges.

Two sets of ranges share one list of boundaries. ``year_ranges`` are the closed ranges a
catalogue is asked for; a year before the first or after the last is in none of them.
``intervals`` are the ranges that staging is kept in: the same, and one open range on either
side, so that every year has its place.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.constants import YEAR_BOUNDARIES

YearRange = tuple[int, int]

# Ends of the open ranges: they stand for "and before" and "and after".
OPEN_LOW, OPEN_HIGH = -9999, 9999


def year_ranges(boundaries: Sequence[int] = YEAR_BOUNDARIES) -> tuple[YearRange, ...]:
    """Closed ranges between consecutive boundaries: ``[b[i] + 1, b[i + 1]]``."""
    if len(boundaries) < 2 or any(a >= b for a, b in zip(boundaries, boundaries[1:])):
        raise ValueError("year boundaries must be at least two and rise strictly")
    return tuple((low + 1, high) for low, high in zip(boundaries, boundaries[1:]))


def intervals(boundaries: Sequence[int] = YEAR_BOUNDARIES) -> tuple[YearRange, ...]:
    """The closed ranges between an open one before and an open one behind them."""
    closed = year_ranges(boundaries)
    if boundaries[0] < OPEN_LOW or boundaries[-1] >= OPEN_HIGH:
        raise ValueError(f"year boundaries must lie within {OPEN_LOW} and {OPEN_HIGH - 1}")
    return ((OPEN_LOW, closed[0][0] - 1), *closed, (closed[-1][1] + 1, OPEN_HIGH))


def is_open(years: YearRange) -> bool:
    return years[0] == OPEN_LOW or years[1] == OPEN_HIGH


def show(years: YearRange) -> str:
    """``1991-2000``, ``-1899`` or ``2024-``."""
    low, high = ("" if end in (OPEN_LOW, OPEN_HIGH) else str(end) for end in years)
    return f"{low}-{high}"


def uncovered(years: YearRange, requested: Iterable[YearRange]) -> tuple[YearRange | None, bool]:
    """What of a range was requested, as its outer years, and whether that is without a gap.

    A closed range is whole if every year of it was requested. An open one has no last year:
    it is whole as far as it was requested without a gap, counted from its closed end.
    """
    low, high = years
    parts = sorted((max(a, low), min(b, high)) for a, b in requested if a <= high and b >= low)
    if not parts:
        return None, False
    reach, whole = parts[0][1], True
    for a, b in parts[1:]:
        whole, reach = whole and a <= reach + 1, max(reach, b)
    first = parts[0][0]
    whole = whole and (first == low or low == OPEN_LOW) and (reach == high or high == OPEN_HIGH)
    return (first, reach), whole


def range_number(year: str, ranges: Sequence[YearRange]) -> Column:
    """Place of the range that the column ``year`` falls in; null outside every range.

    A CASE expression on the row itself, so no join and no shuffle.
    """
    arms = " ".join(f"WHEN {year} BETWEEN {low} AND {high} THEN {i}" for i, (low, high) in enumerate(ranges))
    return F.expr(f"CASE {arms} END") if ranges else F.lit(None).cast("int")


def range_ends(number: str, ranges: Sequence[YearRange]) -> tuple[Column, Column]:
    """Lower and upper end of the range with that place; null if there is none."""
    if not ranges:
        return F.lit(None).cast("int"), F.lit(None).cast("int")
    arms = [" ".join(f"WHEN {i} THEN {years[end]}" for i, years in enumerate(ranges)) for end in (0, 1)]
    return F.expr(f"CASE {number} {arms[0]} END"), F.expr(f"CASE {number} {arms[1]} END")


def range_bounds(year: Column, ranges: Sequence[YearRange]) -> tuple[Column, Column]:
    """Lower and upper end of the range a year falls in; null outside every range.

    A CASE expression on the row itself, so no join and no shuffle.
    """
    def case(end: int) -> Column:
        column = F
        for bounds in ranges:
            column = column.when(year.between(*bounds), F.lit(bounds[end]))
        return column

    return case(0), case(1)
