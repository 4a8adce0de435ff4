"""Unified prices joined with reference prices; suspicious price jumps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.days import days_before, loaded_from
from ..functions.frames import with_table_value
from ..functions.prices import percent_off, whole_number
from ..sources.tables import in_set, newest_loads

ITEM = ("itemId",)


def latest_batch(unified: DataFrame, by: Sequence[str] = (), loads: DataFrame | None = None) -> DataFrame:
    """Rows of the newest load.

    `loads` is the table's side table (`tables.loads`): the newest load comes from
    it, and only the days that this load wrote are read.
    """
    source = unified
    if loads is not None:
        source, unified = loads, in_set(unified, "date", newest_loads(loads, 1, by).select("date"))
    return (
        with_table_value(unified, source, F.max("_timestamp"), "newest_load", by)
        .where(F.col("_timestamp") == F.col("newest_load"))
        .drop("newest_load")
    )


def complete(
    unified: DataFrame,
    reference: DataFrame,
    scope: str | int = "latest",
    as_of: date | Column | None = None,
    keys: Sequence[str] = ITEM,
    by: Sequence[str] = (),
    loads: DataFrame | None = None,
) -> DataFrame:
    """Prices with reference price and real discount.

    `scope` is 'latest' for the newest load or a number of days of load time
    before `as_of`. Extra columns of `unified` pass through. `loads`: see `latest_batch`.

    Reference prices are read only for the span of days the rows have: with a
    table partitioned by date that prunes all older partitions.
    """
    rows = (
        latest_batch(unified, by, loads)
        if scope == "latest"
        else unified.where(loaded_from(days_before(as_of, int(scope))))
    )
    first, last = (rows.agg(edge("date")).scalar() for edge in (F.min, F.max))
    prices = reference.where(F.col("date").between(first, last)).select(
        *keys, "date", "commonPrice", "minPrice"
    )
    joined = rows.join(prices, [*keys, "date"], "left")
    base = F.coalesce("minPrice", "commonPrice")
    return joined.select(
        *unified.columns,
        "commonPrice",
        "minPrice",
        base.alias("originalPriceHS"),
        percent_off(F.col("currentPrice"), base).alias("newSale"),
    )


def suspicious_prices(
    unified: DataFrame,
    days: int = 2,
    above: float = 100.0,
    below: float = 0.01,
    keys: Sequence[str] = ITEM,
    by: Sequence[str] = (),
    loads: DataFrame | None = None,
) -> DataFrame:
    """Prices that are `above` times, or less than `below` times, the item's previous price.

    The window of days counts back from the newest load time, and prices are
    compared as whole numbers. With the side table `loads` that time is not looked for in the rows.
    """
    # A day counts when its midnight is not before the limit: the first such day
    # as a date, so that the filter on the bare column reaches the scan.
    just_before = F.max("_timestamp") - F.make_dt_interval(F.lit(days), F.lit(0), F.lit(0), F.lit(0.000001))
    first_day = F.date_add(just_before.cast("date"), 1)
    source = unified if loads is None else loads
    recent = with_table_value(unified, source, first_day, "first_day", by).where(
        F.col("date") >= F.col("first_day")
    )
    before = Window.partitionBy(*keys).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    price = whole_number(F.col("currentPrice"))
    growth = price.cast("double") / F.nullif(F.col("prev").cast("double"), F.lit(0.0))
    return (
        recent.withColumn("prev", F.last(price, ignorenulls=True).over(before))
        .withColumn("narust", growth)
        .where((F.col("narust") > above) | (F.col("narust") < below))
        .select(
            "shop",
            "itemId",
            "itemName",
            "itemUrl",
            "slug",
            "currentPrice",
            "originalPrice",
            "officialSale",
            "date",
            "prev",
            "narust",
        )
    )
