"""Response pages: status split, errors, edges, and the paging audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import error_text

OK = 200
REQUESTED = ("min", "max")
NO_ERROR_LISTED = "failed without a listed error"


def answered() -> Column:
    """A page answered if its status is 200 and its body holds a result."""
    return F.col("status").eqNullSafe(OK) & F.col("data.popularTitles").isNotNull()


def ok_pages(pages: DataFrame) -> DataFrame:
    return pages.where(answered())


def failed_pages(pages: DataFrame) -> DataFrame:
    """Pages that did not answer: a status other than 200, none at all, or no result."""
    return pages.where(~answered())


def page_facts(pages: DataFrame) -> list[Column]:
    """What the audit and the error log need of a page, without its titles."""
    popular = "data.popularTitles"
    return [
        *[F.col(c) for c in (*REQUESTED, "page_no", "cursor_sent", "status")],
        answered().alias("answered"),
        F.col(f"{popular}.pageInfo.endCursor").alias("end_cursor"),
        F.coalesce(F.col(f"{popular}.pageInfo.hasNextPage"), F.lit(True)).alias("has_next"),
        F.col(f"{popular}.totalCount").alias("total"),
        F.coalesce(F.size(F.col(f"{popular}.edges")), F.lit(0)).alias("edges"),
        *[F.col(c) for c in ("errors",) if c in pages.columns],
    ]


def page_errors(pages: DataFrame) -> DataFrame:
    """One row per listed error of any page, and one with a fixed text for a failed page
    that lists none. ``answered`` tells errors beside a result from errors instead of one.
    ``pages`` are whole or facts."""
    carried = [c for c in ("min", "max", "page_no", "status") if c in pages.columns]
    if "answered" in pages.columns:
        good = F.col("answered")
    else:
        good = answered() if "data" in pages.columns else F.col("status").eqNullSafe(OK)
    return (
        pages.select(
            *carried,
            good.alias("answered"),
            F.explode_outer("errors").alias("error"),
        )
        .where("error IS NOT NULL OR NOT answered")
        .select(
            *carried,
            "answered",
            F.when(F.col("error").isNull(), F.lit(NO_ERROR_LISTED))
            .otherwise(error_text("error"))
            .alias("error_text"),
        )
    )


def unwrap_edges(pages: DataFrame) -> DataFrame:
    """One row per title: the edges of every good page, without their cursors, and the
    year range the page was requested for (``min``, ``max``) when the pages carry it.

    The exploded array is the node field alone, so a columnar page table is read without
    the cursors and with only those node fields that are used later.
    """
    requested = [c for c in REQUESTED if c in pages.columns]
    return (
        ok_pages(pages)
        .select(*requested, F.explode("data.popularTitles.edges.node").alias("node"))
        .select("node.*", *requested)
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; a column missing on one side reads null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _struct(**fields: Column) -> Column:
    return F.struct(*[column.alias(name) for name, column in fields.items()])


def audit_pages(pages: DataFrame) -> DataFrame:
    """One row per requested year range: what was landed, and whether it is complete.

    A page failed as ``failed_pages`` says.
    Complete means: no failed page; page numbers without gap or copy; the lowest page is
    the only one asked for without a cursor; every other page was asked for with the end
    cursor of the page before; exactly the highest page says there is no next one; and
    the edges add up to the announced total.

    A page states two facts: what it was asked with (slot ``page_no``) and what the next
    page must be asked with (slot ``page_no + 1``). Grouping the facts by slot links
    neighbours in one shuffle with map-side partial aggregation: no self join that copies
    of a page could blow up, no window that would put a whole range into one task. The slots
    can be kept and merged with those of pages that come later.
    """
    return audit_slots(page_slots(pages.select(*page_facts(pages))))


def page_slots(facts: DataFrame) -> DataFrame:
    """One row per requested range and slot: what the pages of that number were asked with,
    and what the pages before promised. Sums and extremes only, so slots of several sets of
    pages are merged by ``merged_slots``."""
    arrival = _struct(
        slot=F.col("page_no"),
        asked=F.coalesce(F.col("cursor_sent"), F.lit("")),
        promised=F.lit(None).cast("string"),
        here=F.lit(1),
        failed=F.when(F.col("answered"), 0).otherwise(1),
        is_last=~F.col("has_next"),
        edges=F.col("edges"),
        total=F.col("total"),
    )
    promise = _struct(
        slot=F.col("page_no") + 1,
        asked=F.lit(None).cast("string"),
        promised=F.col("end_cursor"),
        here=F.lit(0),
        failed=F.lit(0),
        is_last=F.lit(None).cast("boolean"),
        edges=F.lit(0),
        total=F.lit(None).cast("bigint"),
    )
    return (
        facts.select("min", "max", F.explode(F.array(arrival, promise)).alias("fact"))
        .select("min", "max", "fact.*")
        .groupBy("min", "max", "slot")
        .agg(
            F.sum("here").alias("copies"),
            F.sum("failed").alias("failed"),
            F.min("asked").alias("asked"),
            F.max("asked").alias("asked_high"),
            F.min("promised").alias("promised"),
            F.max("promised").alias("promised_high"),
            F.bool_or("is_last").alias("is_last"),
            F.sum("edges").alias("edges"),
            F.min("total").alias("total"),
            F.max("total").alias("total_high"),
        )
    )


def merged_slots(*slots: DataFrame) -> DataFrame:
    """Slots of pages that were summed up apart, as if they had been summed up together."""
    return (
        union_all(list(slots))
        .groupBy("min", "max", "slot")
        .agg(
            *[F.sum(c).alias(c) for c in ("copies", "failed", "edges")],
            *[F.min(c).alias(c) for c in ("asked", "promised", "total")],
            *[F.max(c).alias(c) for c in ("asked_high", "promised_high", "total_high")],
            F.bool_or("is_last").alias("is_last"),
        )
    )


def audit_slots(slots: DataFrame) -> DataFrame:
    """The audit of pages that were summed up as slots."""
    slots = slots.where("copies > 0")
    starts = F.col("asked") == ""
    follows = (
        (F.col("asked") == F.col("promised"))
        & (F.col("asked_high") == F.col("asked"))
        & (F.col("promised_high") == F.col("promised"))
    )
    per_range = slots.groupBy("min", "max").agg(
        F.sum("copies").alias("pages"),
        F.sum("failed").alias("failed"),
        F.sum("edges").alias("titles"),
        F.max("total_high").alias("total_count"),
        F.min("total").alias("total_low"),
        F.min("slot").alias("first_slot"),
        F.max("slot").alias("last_slot"),
        F.count_if(starts).alias("starts"),
        F.min(F.when(starts, F.col("slot"))).alias("start_slot"),
        F.bool_and(starts | F.coalesce(follows, F.lit(False))).alias("linked"),
        F.count_if("is_last").alias("ends"),
        F.max(F.when(F.col("is_last"), F.col("slot"))).alias("end_slot"),
    )
    complete = (
        (F.col("failed") == 0)
        & (F.col("pages") == F.col("last_slot") - F.col("first_slot") + 1)
        & (F.col("starts") == 1)
        & (F.col("start_slot") == F.col("first_slot"))
        & F.col("linked")
        & (F.col("ends") == 1)
        & (F.col("end_slot") == F.col("last_slot"))
        & (F.col("total_low") == F.col("total_count"))
        & (F.col("titles") == F.col("total_count"))
    )
    return per_range.select(
        "min", "max", "pages", "failed", "titles", "total_count",
        F.coalesce(complete, F.lit(False)).alias("complete"),
    )
