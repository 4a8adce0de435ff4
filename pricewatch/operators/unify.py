"""Raw scraped offers to one clean price table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.days import days_before, loaded_from, text_day_from
from ..functions.frames import first_per_group, nulls_last
from ..functions.prices import (
    not_blank,
    null_if_not_above,
    percent_off,
    try_price,
    whole_number,
)
from ..sources.tables import in_set

ATTRIBUTES = ["shop", "p_key", "itemId", "itemName", "itemUrl", "slug"]
UNIFIED = [
    *ATTRIBUTES,
    "currentPrice",
    "originalPrice",
    "officialSale",
    "itemImage",
    "date",
    "inStock",
]


def recent(raw: DataFrame, as_of: date | Column | None, days_back: int, day_column: str = "_timestamp") -> DataFrame:
    """Rows of the last `days_back` days by load time, or by the scraped `date` text."""
    start = days_before(as_of, days_back)
    if day_column == "_timestamp":
        return raw.where(loaded_from(start))
    return raw.where(text_day_from(start, day_column))


def rows_of_days(raw: DataFrame, batch: DataFrame) -> DataFrame:
    """All raw rows of the days in `batch`, days read as `unify` reads them.

    Raw offers that are stored by day (`sources.raw`) are read in these days' folders only.
    """
    if "day" in raw.columns:
        days = batch.where(not_blank("date")).select(F.to_date("date").alias("day")).where("day is not null")
        return in_set(raw, "day", days)
    dated = lambda df: df.where(not_blank("date")).withColumn("_day", F.to_date("date"))
    days = dated(batch).select("_day").distinct()
    return dated(raw).join(days, "_day", "left_semi").drop("_day")


def unify(
    raw: DataFrame, min_scope: str = "scrape", by: Sequence[str] = (), extra: Sequence[str] = ()
) -> DataFrame:
    """Typed offers with the lowest selling and the highest claimed price of their group.

    `min_scope` sets the group of the lowest price: 'scrape' takes rows with
    the same scrape time, 'day' takes the whole calendar day. The highest
    claimed price always goes by day, and is dropped when it is not above the
    row's own selling price. Copies merge; `_timestamp` is the latest load.
    `by` keeps shops apart that use the same item ids; `extra` names further
    columns of the shop that pass through as they are.

    The group extremes come from partial aggregates that are joined back, not
    from windows: one item may hold a large part of all offers, and AQE can
    split the row side of a join but not a window partition.
    """
    if min_scope not in ("scrape", "day"):
        raise ValueError(f"min_scope must be 'scrape' or 'day', not {min_scope!r}")
    offers = (
        raw.where(not_blank("currentPrice") & not_blank("date") & not_blank("itemId"))
        .select(
            "shop",
            "itemId",
            "itemName",
            "itemUrl",
            "slug",
            try_price("currentPrice").alias("own_price"),
            try_price("originalPrice").alias("own_original"),
            percent_off(
                whole_number(F.col("currentPrice")), whole_number(F.col("originalPrice"))
            ).alias("officialSale"),
            F.col("img").alias("itemImage"),
            F.to_date("date").alias("date"),
            F.col("date").alias("scraped"),
            "inStock",
            *extra,
            "_timestamp",
        )
    )
    if min_scope == "day":
        offers = offers.drop("scraped")
    offers = _merge_copies(offers)

    day_group = [*by, "itemId", "date"]
    group = day_group if min_scope == "day" else [*day_group, "scraped"]
    extremes = offers.groupBy(*group).agg(
        F.min("own_price").alias("currentPrice"), F.max("own_original").alias("top_original")
    )
    if min_scope == "scrape":
        # One row per scrape time by now: at most the seconds of a day per partition.
        top = F.max("top_original").over(Window.partitionBy(*day_group))
        extremes = extremes.withColumn("top_original", top)
    rows = offers.join(extremes, group).withColumn(
        "originalPrice", null_if_not_above(F.col("top_original"), F.col("own_price"))
    )
    columns = [c for c in UNIFIED if c != "p_key"]
    return _with_key(_merge_copies(rows.select(*columns, *extra, "_timestamp")), extra)


def _with_key(rows: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Add `p_key`, the hash of shop and item. Last of all, so that no shuffle carries it."""
    return rows.withColumn("p_key", F.md5(F.concat("shop", "itemId"))).select(*UNIFIED, *extra, "_timestamp")


def _merge_copies(rows: DataFrame) -> DataFrame:
    """Distinct rows that keep the latest load time; copies merge before the shuffle."""
    columns = [c for c in rows.columns if c != "_timestamp"]
    return rows.groupBy(*columns).agg(F.max("_timestamp").alias("_timestamp"))


def one_per_day(unified: DataFrame, keys: Sequence[str] = ("itemId",)) -> DataFrame:
    """The row that the (item, day) key keeps: lowest price, then highest claim, then a fixed order."""
    order = [
        *nulls_last(F.col("currentPrice")),
        *nulls_last(-F.col("originalPrice")),
        *[
            F.col(c)
            for c in dict.fromkeys([*UNIFIED, *unified.columns])
            if c not in (*keys, "date", "currentPrice", "originalPrice", "_timestamp")
        ],
    ]
    columns = [c for c in unified.columns if c not in (*keys, "date")]
    return first_per_group(unified, [*keys, "date"], order, columns).select(*unified.columns)


def item_count_check(recent_rows: DataFrame, raw: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per day: items with a price and items with a claimed price, repeated for each recent origin.

    Days are counted once, over all raw rows, before they meet the origins: a
    first aggregate by (day, item) carries the claim flag, so no row is doubled
    for two distinct counts. The day counts travel as one array, which is
    bounded by the number of calendar days. `by` counts each shop's own rows
    for its own origins, and keeps them in the result.
    """
    per_item = (
        raw.where(not_blank("currentPrice") & not_blank("date"))
        .groupBy(*by, F.to_date("date").alias("date"), "itemId")
        .agg(F.max(not_blank("originalPrice")).alias("claimed"))
    )
    claims = F.count(F.when(F.col("claimed"), F.col("itemId")))
    per_day = per_item.groupBy(*by, "date").agg(
        F.count("itemId").alias("count_itemId_with_curPrice"),
        claims.alias("count_itemId_with_origPrice"),
    )
    if by:
        return recent_rows.select(*by, "shopOrigin").distinct().join(per_day, list(by))
    days = per_day.agg(F.collect_list(F.struct(*per_day.columns)).alias("days")).scalar()
    return (
        recent_rows.select("shopOrigin").distinct()
        .select("shopOrigin", F.explode(days).alias("day"))
        .select("shopOrigin", "day.*")
    )


def merge_feeds(main: DataFrame, second: DataFrame, keys: Sequence[str] = ("itemId",), extra: Sequence[str] = ()) -> DataFrame:
    """Two unified feeds, one row per key and day each, merged into one: `merge_all` of two."""
    return merge_all([main, second], keys, extra)


def merge_all(feeds: Sequence[DataFrame], keys: Sequence[str] = ("itemId",), extra: Sequence[str] = ()) -> DataFrame:
    """Unified feeds of the same items, the main one first, merged to one row per key and day.

    The lowest selling price wins; the claimed price is that of the last feed that has one,
    every other attribute, `extra` columns among them, that of the first. The load time is the newest;
    key and claimed discount are recomputed. A feed need not have the extra columns.

    One grouped reduction for any number of feeds, with partial sums before the shuffle, in place of a full join for each.
    """
    attributes = [c for c in ("shop", "itemName", "itemUrl", "slug", "itemImage", "inStock", *extra) if c not in keys]
    columns = [*dict.fromkeys([*keys, "itemId", "date", "currentPrice", "originalPrice", *attributes, "_timestamp"])]
    kinds = {f.name: f.dataType for feed in reversed(feeds) for f in feed.schema}
    rows = [
        feed.select(
            *[F.col(c) if c in feed.columns else F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in columns],
            F.lit(n).alias("_feed"),
        )
        for n, feed in enumerate(feeds)
    ]

    def of_feed(pick, name: str) -> Column:
        return pick(F.col(name), F.when(F.col(name).isNotNull(), F.col("_feed"))).alias(name)

    group = [*dict.fromkeys([*keys, "itemId", "date"])]
    merged = reduce(DataFrame.unionByName, rows).groupBy(*group).agg(
        F.min("currentPrice").alias("currentPrice"),
        of_feed(F.max_by, "originalPrice"),
        *[of_feed(F.min_by, c) for c in attributes],
        F.max("_timestamp").alias("_timestamp"),
    )
    sale = percent_off(F.col("currentPrice"), F.col("originalPrice"))
    return _with_key(merged.withColumn("officialSale", sale), extra)
