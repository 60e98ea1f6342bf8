"""Popularity order, first and next page, page numbers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.constants import PAGE_SIZE
from marquee.operators.filters import per_title
from marquee.session import written

POPULARITY = "content_scoring_tmdbPopularity"
RANGE = ("year_min", "year_max")
_ROW = "_row"
_ROW_BITS = 33  # monotonically_increasing_id: block number above, row number below


@dataclass(frozen=True)
class Cursor:
    """Place of a title in the popularity order."""

    popularity: float | None
    id: str


def _order(popularity: str, ties: Sequence[str]) -> list[Column]:
    return [F.col(popularity).desc_nulls_last(), *[F.col(tie).asc() for tie in ties]]


def by_popularity(df: DataFrame, popularity: str = POPULARITY) -> DataFrame:
    """Most popular first, unknown popularity last, ties by id."""
    return df.orderBy(*_order(popularity, ["id"]))


def first_page(df: DataFrame, size: int = PAGE_SIZE, popularity: str = POPULARITY) -> DataFrame:
    """Top ``size`` titles: each task keeps its own top rows, no full sort."""
    return by_popularity(per_title(df), popularity).limit(size)


def end_cursor(page: DataFrame, popularity: str = POPULARITY) -> Cursor | None:
    """Cursor of the last title of a page, or None for an empty page. Fetches one row."""
    last = (
        page.select(popularity, "id")
        .orderBy(F.col(popularity).asc_nulls_first(), F.col("id").desc())
        .limit(1)
        .collect()
    )
    return Cursor(last[0][0], last[0][1]) if last else None


def next_page(
    df: DataFrame, after: Cursor, size: int = PAGE_SIZE, popularity: str = POPULARITY
) -> DataFrame:
    """The ``size`` titles behind a cursor: a plain predicate, so the rows before the
    cursor are filtered out in the scan and never sorted."""
    value = F.col(popularity)
    if after.popularity is None:
        behind = value.isNull() & (F.col("id") > after.id)
    else:
        behind = (
            (value < after.popularity)
            | ((value == after.popularity) & (F.col("id") > after.id))
            | value.isNull()
        )
    return first_page(df.where(behind), size, popularity)


def number_pages(
    df: DataFrame,
    size: int = PAGE_SIZE,
    popularity: str = POPULARITY,
    ties: Sequence[str] = ("id",),
    groups: Sequence[str] = RANGE,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rank the titles of each group by popularity and cut the ranking into pages.

    Returns the group, popularity, tie and ``keep`` columns with ``rank``, ``page_no`` and
    ``total``, the number of titles of the group. Only the keys travel through the sort.
    Records that are kept are numbered and written once, and the ranks are joined to them by
    that number: joining by id would multiply the copies of a title with each other.

    A window per year range would sort a whole range, easily a third of all titles, in
    one task. Instead all titles are sorted globally, which range-partitions them evenly,
    and a rank is the row's offset in its sorted block plus the number of rows of its group
    in the blocks before. The ties tell titles apart; copies of one title are told apart by
    the number of their row, so that they too spread over several blocks.

    Positions must not move between the pass that counts the blocks and the pass that
    adds the offsets, so the sorted keys are written to a scratch table once. The offset
    table has at most (number of sorted blocks + number of groups) rows; whether it is
    broadcast is left to Spark, which knows its size.
    """
    df = per_title(df)
    names = [*groups, popularity, *ties]
    numbered = df.select(*names, *keep, F.monotonically_increasing_id().alias(_ROW))
    records = written(numbered, "records") if keep else numbered
    keys = [*names, _ROW]
    placed = written(
        records.select(*keys)
        .orderBy(*groups, *_order(popularity, ties), _ROW)
        .select(*keys, F.monotonically_increasing_id().alias("position")),
        "ranked",
    )
    block = F.shiftright("position", _ROW_BITS)
    # Both windows run over the few rows of the offset table.
    before = Window.partitionBy(*groups).orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        placed.groupBy(*groups, block.alias("block"))
        .agg(F.count("*").alias("rows"), F.min("position").alias("start"))
        .select(
            *[F.col(g).alias(f"g{i}") for i, g in enumerate(groups)],
            "block",
            "start",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("ahead"),
            F.sum("rows").over(Window.partitionBy(*groups)).alias("total"),
        )
    )
    same_group = [F.col(g).eqNullSafe(F.col(f"g{i}")) for i, g in enumerate(groups)]
    rank = F.col("position") - F.col("start") + F.col("ahead") + 1
    ranked = (
        placed.withColumn("block", block)
        .join(offsets.withColumnRenamed("block", "at"),
              [F.col("block") == F.col("at"), *same_group])
        .select(*keys, rank.alias("rank"), "total")
        .select("*", F.expr(f"cast((rank - 1) div {int(size)} + 1 as int)").alias("page_no"))
    )
    if not keep:
        return ranked.drop(_ROW)
    return records.join(ranked.select(_ROW, "rank", "total", "page_no"), _ROW).drop(_ROW)
