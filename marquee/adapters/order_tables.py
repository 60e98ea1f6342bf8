"""Titles, response pages and errors derived from the flat order tables.

One order plays one title; its line items give the genres (part type), the production
countries (nation of the supplier) and the offers (line item with its supplier).

Sizes. Genres and countries of a title are sets over small domains (part types, nations),
collected with map-side aggregation, so even an order with a third of all line items ends
up with a short array. Offers have no such bound. In staging frames an order with more than
``max_offers`` line items is therefore split: its line items are hashed over several
records, each of which repeats the title's other columns, holds its own share of the offers
and carries its number. No offer is dropped, no record grows with the order, and copies of
a line item collapse in the set. Table jobs give the same result for split and whole
titles, and operators that count or rank titles look at the first record of each.
"""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.constants import PAGE_SIZE, SHOW
from marquee.operators.filters import PART, YEAR, assign_year_range
from marquee.operators.flatten import seasons_of_shows
from marquee.operators.ranking import POPULARITY, RANGE, number_pages
from marquee.schemas import STAGING
from marquee.session import written

ALL = ("genres", "countries", "offers", "seasons")
MAX_OFFERS = 1_000
CHUNK = 1_000
# Rows that a task gathers to sets, and to pages: sorted, they take some 100 MB.
LINES_A_TASK = 500_000
TITLES_A_TASK = 250_000


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"), "l_partkey", "l_suppkey", "l_linenumber"
    )


def _with_supplier(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _read(spark, sf_dir, "supplier")
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")


def _dealt(rows: DataFrame, count: int, most: int, *keys: str) -> DataFrame:
    """The ``count`` rows shuffled by ``keys``. There are as many tasks as keep them to some
    ``most`` rows: AQE merges partitions by their packed bytes, which tell little of what
    sets and pages take in memory."""
    parts = -(-count // most)
    if parts <= 1:
        return rows.repartition(*keys)
    return rows.repartition(max(parts, rows.sparkSession.sparkContext.defaultParallelism), *keys)


def _line_counts(lines: DataFrame) -> tuple[int, int]:
    """Number of line items, and that of the order with the most."""
    counts = lines.groupBy("key").agg(F.count("*").alias("n"))
    found = counts.agg(F.sum("n"), F.max("n")).first()
    return found[0] or 0, found[1] or 0


def _title_sets(
    spark: SparkSession, sf_dir: str, fields: Collection[str], counts: tuple[int, int] | None = None
) -> DataFrame:
    """Per order: number of line items, genre set, country set, offer set, in one pass over
    the line items. ``collect_set`` skips nulls, so a line item without a matching part or
    supplier adds nothing. Only what tells offers apart is shuffled; their texts are spelt
    out afterwards. Sets in order, of which many are alike, take less room in files.

    Offers hardly ever collapse, so with them short line items are shuffled, and sets are
    made behind that, in tasks of bounded size. Only where an order has very many are sets
    made ahead of the shuffle as well, by which its copies collapse. ``counts`` are the
    ``_line_counts``, if known."""
    lines = _lines(spark, sf_dir)
    count, largest = counts or (_line_counts(lines) if "offers" in fields else (0, 0))
    found = []
    if "seasons" in fields:
        found.append(F.count("*").cast("double").alias("line_count"))
    if "genres" in fields:
        parts = _read(spark, sf_dir, "part").select("p_partkey", "p_type")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        found.append(F.sort_array(F.collect_set("p_type")).alias("genres"))
    if "offers" in fields and largest <= MAX_OFFERS:
        used = [c for c in ("key", "p_type", "l_suppkey", "l_linenumber") if c in lines.columns]
        lines = _dealt(lines.select(*used), count, LINES_A_TASK, "key")
    if {"countries", "offers"} & set(fields):
        lines = _with_supplier(lines, spark, sf_dir)
    if "countries" in fields:
        nations = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        lines = lines.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        found.append(F.sort_array(F.collect_set("n_name")).alias("countries"))
    if "offers" in fields:
        found.append(_offer_set())
    return lines.groupBy("key").agg(*found)


def _offer_set() -> Column:
    offer = F.struct("l_linenumber", "s_suppkey", "s_name")
    return F.collect_set(F.when(F.col("s_suppkey").isNotNull(), offer)).alias("offers")


def _with_sets(
    frame: DataFrame, spark: SparkSession, sf_dir: str, fields: Collection[str], counts: tuple[int, int] | None = None
) -> DataFrame:
    """Orders with the sets of their line items. Line items are counted as joined to the
    tables of the genres and countries, so offers alone are gathered apart from the count."""
    apart = [{"offers"}] if {"offers", "seasons"} <= set(fields) and "countries" not in fields else []
    rest = set(fields) & set(ALL) - (apart[0] if apart else set())
    for wanted in filter(None, (rest, *apart)):
        frame = frame.join(_title_sets(spark, sf_dir, wanted, counts), "key", "left")
    return frame


def _oversize(lines: DataFrame, max_offers: int) -> DataFrame:
    """Orders that need more than one record, with their number of records."""
    return (
        lines.groupBy("key")
        .count()
        .where(F.col("count") > max_offers)
        .select("key", F.ceil(F.col("count") / max_offers).cast("int").alias("parts"))
    )


def _heads(frame: DataFrame, big: DataFrame) -> DataFrame:
    """One row per record an order needs, its part numbers counting from 0.

    Numbered in two steps with a shuffle between, so that no array and no task has to hold
    all the records of one hot order.
    """
    last = F.coalesce(F.col("parts"), F.lit(1)) - 1
    first = F.col("chunk") * CHUNK
    return (
        frame.join(big, "key", "left")
        .withColumn("last", last)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / CHUNK))))
        .repartition("key", "chunk")
        .withColumn(
            PART, F.explode(F.sequence(first, F.least(F.col("last"), first + CHUNK - 1)))
        )
        .withColumn(PART, F.col(PART).cast("int"))
        .drop("parts", "last", "chunk")
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a title takes from its order; its texts are spelt out later."""
    return _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), "o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey",
        F.year("o_orderdate").alias(YEAR),
    )


def _records(
    spark: SparkSession, sf_dir: str, fields: Collection[str], max_offers: int | None
) -> DataFrame:
    """One row per title record: staging columns for the wanted fields, and the part number."""
    frame = _orders(spark, sf_dir)
    # Counted once, ahead: most tables hold no such order, and then nothing is spread.
    counts = _line_counts(_lines(spark, sf_dir)) if "offers" in fields else None
    if counts is None or max_offers is None or counts[1] <= max_offers:
        frame = _with_sets(frame, spark, sf_dir, fields, counts).withColumn(PART, F.lit(0))
    else:
        big = written(_oversize(_lines(spark, sf_dir), max_offers), "oversize")
        frame = _with_sets(frame, spark, sf_dir, set(fields) - {"offers"})
        share = F.pmod(F.xxhash64("l_partkey", "l_suppkey", "l_linenumber"), F.col("parts"))
        lines = _lines(spark, sf_dir).join(big, "key", "left").withColumn(
            PART, F.coalesce(share, F.lit(0)).cast("int")
        )
        offers = _with_supplier(lines, spark, sf_dir).groupBy("key", PART).agg(_offer_set())
        frame = _heads(frame, big).join(offers, ["key", PART], "left")
    spelt = _spelt(fields, F.col)
    return frame.select(PART, *[value.alias(name) for name, value in spelt.items()])


def _spelt(fields: Collection[str], at: Callable[[str], Column]) -> dict[str, Column]:
    """The staging columns of a title from its order and sets, which ``at`` gives by name."""
    key, status, priority, price = map(at, ("key", "o_orderstatus", "o_orderpriority", "o_totalprice"))
    customer = at("o_custkey")
    values = {
        "id": F.concat(F.lit("tt"), key),
        "objectType": F.when(status == "O", F.lit(SHOW)).otherwise(F.lit("MOVIE")),
        "content_title": F.concat(F.lit("Title "), key),
        "content_shortDescription": priority,
        YEAR: at(YEAR),
        "content_ageCertification": F.when(status != "P", priority),
        "content_runtime": customer % 180,
        "content_fullPath": F.concat(F.lit("/title/"), key),
        "content_scoring_imdbScore": F.when(status != "F", price),
        "content_scoring_imdbVotes": F.when(customer % 2 != 0, customer.cast("double")),
        "content_scoring_tmdbPopularity": price,
        "content_scoring_tmdbScore": F.when(priority != "5-LOW", price / 100000),
    }
    if "countries" in fields:
        values["content_productionCountries"] = at("countries")
    if "genres" in fields:
        values["content_genres"] = F.transform(
            at("genres"), lambda g: F.struct(g.alias("id"), F.lower(g).alias("translation"))
        )
    if "offers" in fields:
        values["offers"] = F.transform(at("offers"), lambda offer: _offer(key, offer))
    if "seasons" in fields:
        # Of movies too: staging keeps the count of shows only.
        values["totalSeasonCount"] = F.coalesce(at("line_count"), F.lit(0.0))
    return {name: values[name] for name in STAGING.names if name in values}


def _offer(key: Column, offer: Column) -> Column:
    number, supplier, name = offer["l_linenumber"], offer["s_suppkey"], offer["s_name"]
    package = F.struct(
        supplier.cast("int").alias("packageId"),
        name.alias("clearName"),
        F.lower(name).alias("slug"),
        F.concat(F.lit("/i/"), supplier).alias("icon"),
    )
    return F.struct(
        F.concat(F.lit("o"), key, F.lit("-"), number).alias("id"),
        F.concat(F.lit("/u/"), number).alias("standardWebURL"),
        package.alias("package"),
    )


def _node(spelt: dict[str, Column]) -> list[Column]:
    """The flat columns as the fields of a title record."""

    def gather(prefix: str) -> list[Column]:
        depth = prefix.count("_")
        names = [c for c in spelt if c.startswith(prefix) and c.count("_") == depth]
        return [spelt[c].alias(c[len(prefix) :]) for c in names]

    scoring = F.struct(*gather("content_scoring_")).alias("scoring")
    content = F.struct(*gather("content_"), scoring).alias("content")
    whole = {c: spelt[c].alias(c) for c in ("id", "objectType", "offers", "totalSeasonCount") if c in spelt}
    return [whole.pop("id"), whole.pop("objectType"), content, *whole.values()]


def staging_titles(
    spark: SparkSession,
    sf_dir: str,
    fields: Collection[str] = ALL,
    max_offers: int | None = MAX_OFFERS,
) -> DataFrame:
    """Titles as flat staging columns, with the number of the record where a title may be
    spread over several. ``fields`` names the columns that need line items; columns left out
    are absent, and the tables behind them are not read."""
    titles = _records(spark, sf_dir, fields, max_offers)
    if "seasons" in fields:
        titles = seasons_of_shows(titles)
    return titles if "offers" in fields and max_offers is not None else titles.drop(PART)


def nested_titles(
    spark: SparkSession,
    sf_dir: str,
    fields: Collection[str] = ALL,
    max_offers: int | None = None,
) -> DataFrame:
    """The same titles as nested records, by default one per title."""
    flat = _records(spark, sf_dir, fields, max_offers)
    return flat.select(_node({c: F.col(c) for c in flat.columns if c != PART}))


def landed_pages(
    spark: SparkSession,
    sf_dir: str,
    fields: Collection[str] = ALL,
    size: int = PAGE_SIZE,
    by: Column | None = None,
    asked: tuple[Column, Column] | None = None,
    no_year: Column | None = None,
    where: Column | None = None,
) -> DataFrame:
    """The titles as response pages per year range, most popular first.

    A response holds one edge per title with all of its offers, so titles are not spread
    here: a title's record is the set of its line items, which has as many elements as one
    API answer would. Links between pages come from the ranking too: the title at the end of
    page n is the cursor sent for n + 1. ``by`` is the year a title is requested under, by
    default its own; ``asked`` gives the first and last year of the request itself, from the
    order number ``key``. Titles for which ``no_year`` holds have none. ``where`` restricts
    the titles.
    """
    # Orders are ranked before their line items are gathered, and titles are spelt out when
    # they are on their page: what is sorted, written and shuffled are short rows.
    orders = _orders(spark, sf_dir)
    short = orders.columns
    plain = _spelt((), F.col)
    titles = orders.select("*", *[value.alias(name) for name, value in plain.items() if name not in short])
    if where is not None:
        titles = titles.where(where)
    if no_year is not None:
        titles = titles.withColumn(YEAR, F.when(~no_year, F.col(YEAR)))
    if asked is not None:
        titles = titles.select("*", *[c.alias(n) for c, n in zip(asked, RANGE)])
    elif by is None:
        titles = assign_year_range(titles)
    else:
        titles = assign_year_range(titles.withColumn("_by", by), "_by")
    rows = titles.select(*RANGE, "id", F.col(POPULARITY).alias("popularity"), *short)
    ranked = number_pages(rows, size, "popularity", ("id",), keep=short)
    # Copies of a title have the same id; the rank tells their cursors apart.
    cursor = F.concat_ws("/", "id", "rank")
    sent = ranked.where(F.col("rank") % size == 0).select(
        *RANGE, (F.col("page_no") + 1).alias("page_no"), cursor.alias("cursor_sent")
    )
    whole = _with_sets(ranked, spark, sf_dir, fields)
    edge = F.struct("rank", *[c for c in whole.columns if c not in (*RANGE, "id", "popularity", "rank", "page_no", "total")])
    pages = (
        _dealt(whole, orders.count(), TITLES_A_TASK, *RANGE, "page_no")
        .groupBy(*RANGE, "page_no")
        .agg(F.sort_array(F.collect_list(edge)).alias("ranked"), F.max("total").alias("total"))
        .join(sent, [*RANGE, "page_no"], "left")
    )

    def spelt_edge(e: Column) -> Column:
        spelt = _spelt(fields, lambda name: e[name])
        return F.struct(F.concat_ws("/", spelt["id"], e["rank"]).alias("cursor"), F.struct(*_node(spelt)).alias("node"))

    last = F.element_at("ranked", -1)
    return pages.select(
        "page_no",
        "cursor_sent",
        F.lit(200).alias("status"),
        F.struct(
            F.struct(
                F.col("total").alias("totalCount"),
                F.struct(
                    spelt_edge(last)["cursor"].alias("endCursor"),
                    (last["rank"] < F.col("total")).alias("hasNextPage"),
                ).alias("pageInfo"),
                F.transform("ranked", spelt_edge).alias("edges"),
            ).alias("popularTitles")
        ).alias("data"),
        F.col("year_min").alias("min"),
        F.col("year_max").alias("max"),
    )


def order_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per order: pending orders failed with two errors, every third finished
    order answered nothing without saying why, every fifth open one has errors beside its
    result, the others are fine."""
    orders = _read(spark, sf_dir, "orders")
    failed = F.col("o_orderstatus") == "P"
    silent = (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 == 0)
    beside = (F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 5 == 0)

    def error(message, line, column):
        return F.struct(
            message.alias("message"),
            F.array(
                F.struct(line.cast("int").alias("line"), column.cast("int").alias("column"))
            ).alias("locations"),
            F.create_map(F.lit("code"), F.col("o_orderstatus")).alias("extensions"),
        )

    errors = F.array(
        error(F.col("o_orderpriority"), F.col("o_custkey") % 100, F.col("o_orderkey") % 10),
        error(F.concat(F.lit("order "), F.col("o_orderkey")), F.lit(1), F.lit(2)),
    )
    return orders.select(
        F.col("o_orderkey").alias("page_no"),
        F.when(failed, F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.when(failed | beside, errors).alias("errors"),
        F.when(
            ~failed & ~silent, F.struct(F.struct(F.lit(1).cast("bigint").alias("totalCount")).alias("popularTitles"))
        ).alias("data"),
    )
