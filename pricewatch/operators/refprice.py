"""Independent reference prices: most frequent price, and lowest price before a discount.

The work runs on *price runs*: one row per scraped (item, day) that says from
when to when its price was in force. Filling the gaps day by day would turn
each item into one row per calendar day; a run holds the same facts, so day
counts become date differences and the 30-day minimum becomes two range
frames. The dense form is still there (`fill_days`) for those who want it.

Every window is by item over at most one row per calendar day, so the largest
window partition is bounded by the length of the calendar, however many offers
an item had.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.days import as_day, days_before
from ..functions.frames import with_table_value

CALENDAR_DAYS = 151
LOOKBACK_DAYS = 30
ITEM = ("itemId",)
RULES = ("since_up", "gradual_v2", "last_change")

Day = date | Column | None


def active_items(unified: DataFrame, as_of: Day, history_days: int, keys: Sequence[str] = ITEM) -> DataFrame:
    """Items seen within the history window."""
    return unified.where(F.col("date") >= days_before(as_of, history_days)).select(*keys).distinct()


def calendar(unified: DataFrame, days: int = CALENDAR_DAYS, by: Sequence[str] = ()) -> DataFrame:
    """The `days` days that end at the last day of the data."""
    last = unified.groupBy(*by).agg(F.max("date").alias("last"))
    return last.select(*by, F.explode(_back_from(F.col("last"), days)).alias("date"))


def date_item_grid(
    unified: DataFrame, items: DataFrame, days: int = CALENDAR_DAYS, by: Sequence[str] = ()
) -> DataFrame:
    """Every calendar day for every item; each item row unrolls its own calendar."""
    dated = with_table_value(items, unified, F.max("date"), "last", by)
    return dated.select(*items.columns, F.explode(_back_from(F.col("last"), days)).alias("date"))


def _back_from(last: Column, days: int) -> Column:
    return F.sequence(F.date_sub(last, days - 1), last)


def price_points(unified: DataFrame, as_of: Day, history_days: int, keys: Sequence[str] = ITEM) -> DataFrame:
    """Priced rows of the history window, with a mark on days where a claimed price first appears.

    The mark needs a previous row without a claim: an item's first row has none.
    """
    return _numbered_points(unified, as_of, history_days, keys).drop("day_no")


def _series(keys: Sequence[str]):
    """Item days in order. Range frames need numbers, and one order column means one sort for all windows."""
    return Window.partitionBy(*keys).orderBy("day_no")


def _numbered_points(unified: DataFrame, as_of: Day, history_days: int, keys: Sequence[str]) -> DataFrame:
    series = _series(keys)
    had_no_claim = F.lag("date").over(series).isNotNull() & F.lag("originalPrice").over(series).isNull()
    priced = (F.col("date") >= days_before(as_of, history_days)) & F.col("currentPrice").isNotNull()
    return unified.where(priced).withColumn("day_no", F.unix_date("date")).select(
        *keys,
        "date",
        "day_no",
        "currentPrice",
        "originalPrice",
        F.when(F.col("originalPrice").isNotNull() & had_no_claim, True).alias("first_day_origPrice"),
    )


def price_runs(
    unified: DataFrame,
    as_of: Day,
    valid_days: int = 90,
    history_days: int | None = None,
    points_days: int | None = None,
    calendar_days: int | None = None,
    keys: Sequence[str] = ITEM,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per price point: the days it was in force, its trend, and the lowest price before it.

    Columns: keys, `date`, `run_end`, `currentPrice`, `real` (scraped on that
    day), `first_day_origPrice`, `price_trend`, `min_30d`.

    The history window is `valid_days` + 30 days unless given. Points may be
    read from further back (`points_days`): then a price from before the window
    is carried into it. The calendar covers all points read, and `CALENDAR_DAYS` at
    least, unless `calendar_days` is given. Runs end at the next point or at the last day of the data.
    """
    history_days = history_days or valid_days + LOOKBACK_DAYS
    points_days = points_days or history_days
    calendar_days = calendar_days or max(CALENDAR_DAYS, history_days + 1, points_days + 1)
    series = _series(keys)

    points = _numbered_points(unified, as_of, points_days, keys)
    if by and not set(by) <= set(keys):
        raise ValueError("`by` columns must be part of `keys`")
    points = with_table_value(points, unified, F.max("date"), "last_day", by)
    runs = points.where(F.col("date") >= F.date_sub("last_day", calendar_days - 1)).withColumn(
        "run_end", F.coalesce(F.date_sub(F.lead("date").over(series), 1), F.col("last_day"))
    )
    start = days_before(as_of, history_days)
    if points_days > history_days:
        # A price is carried into the window only for items that were seen in it, priced or not.
        runs = (
            runs.join(active_items(unified, as_of, history_days, keys), list(keys), "left_semi")
            .where(F.col("run_end") >= start)
            .withColumn("real", F.col("date") >= start)
            .withColumn("date", F.greatest(F.col("date"), start))
            .withColumn("day_no", F.unix_date("date"))
        )
    else:
        runs = runs.withColumn("real", F.lit(True))

    # Prices in force on the 30 days before: points inside them, and the point
    # that was running when they began.
    frames = {
        "before": F.lag("currentPrice").over(series),
        "inside": F.min("currentPrice").over(series.rangeBetween(-LOOKBACK_DAYS, -1)),
        "running": F.last("currentPrice").over(
            series.rangeBetween(Window.unboundedPreceding, -LOOKBACK_DAYS)
        ),
    }
    trend = (
        F.when(F.col("currentPrice") < F.col("before"), "down")
        .when(F.col("currentPrice") > F.col("before"), "up")
        .when(F.col("currentPrice") == F.col("before"), "steady")
        .otherwise("price_init")
    )
    return runs.withColumns(frames).select(
        *keys,
        "date",
        "run_end",
        "currentPrice",
        "real",
        "first_day_origPrice",
        trend.alias("price_trend"),
        F.least("inside", "running").alias("min_30d"),
    )


def fill_days(runs: DataFrame, keys: Sequence[str] = ITEM) -> DataFrame:
    """One row per item and day; days without a scrape carry the last known price."""
    on_day = F.col("day") == F.col("date")
    return (
        runs.withColumn("day", F.explode(F.sequence("date", "run_end")))
        .select(
            *keys,
            F.col("day").alias("date"),
            "currentPrice",
            F.when(on_day & F.col("real"), "1").otherwise("0").alias("filled_row"),
            F.when(on_day, F.col("price_trend")).otherwise("steady").alias("price_trend"),
        )
    )


def gap_fill(runs: DataFrame, keys: Sequence[str] = ITEM) -> DataFrame:
    """`fill_days` without the trend label."""
    return fill_days(runs, keys).drop("price_trend")


def _days_in_force(since: Column) -> Column:
    """Days of a run on or after `since`, 0 when it ended before."""
    days = F.date_diff(F.col("run_end"), F.greatest(F.col("date"), since)) + 1
    return F.greatest(days, F.lit(0))


def _most_frequent(days: Column) -> Column:
    """Price with the most days; of equals the lowest."""
    return F.max_by(F.col("currentPrice"), F.struct(days, -F.col("currentPrice")))


def common_price(runs: DataFrame, since: Column, keys: Sequence[str] = ITEM) -> DataFrame:
    """Most frequent price of each item from `since` on, carried days included."""
    per_price = runs.groupBy(*keys, "currentPrice").agg(F.sum(_days_in_force(since)).alias("days"))
    return (
        per_price.where(F.col("days") > 0)
        .groupBy(*keys)
        .agg(_most_frequent(F.col("days")).alias("commonPrice"))
    )


def _is_change(since: Column | None) -> Column:
    moved = F.col("price_trend").isin("up", "down")
    return moved if since is None else moved & (F.col("date") >= since)


def price_changes(runs: DataFrame, since: Column | None = None, keys: Sequence[str] = ITEM) -> DataFrame:
    """Days on which the price went up or down, numbered from the newest."""
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("date"))
    return runs.where(_is_change(since)).select(
        *keys,
        "date",
        "currentPrice",
        "price_trend",
        F.row_number().over(newest_first).alias("row_number"),
        "first_day_origPrice",
        "min_30d",
    )


def _last_up(keys: Sequence[str], change: Column) -> Column:
    went_up = change & (F.col("price_trend") == "up")
    return F.max(F.when(went_up, F.col("date"))).over(Window.partitionBy(*keys))


def _after(last_up: str) -> Column:
    return F.col(last_up).isNull() | (F.col("date") > F.col(last_up))


def changes_since_up(changes: DataFrame, keys: Sequence[str] = ITEM) -> DataFrame:
    """Changes after the item's last rise; all of them when it never rose."""
    return (
        changes.withColumn("last_up", _last_up(keys, F.lit(True)))
        .where(_after("last_up"))
        .drop("last_up")
    )


def _candidates(row: Column, change: Column, since_up: Column, orig_break: str) -> dict[str, Column]:
    """Per item: the changes a rule may settle on. `row` starts with the date.

    Each is a plain max or min, so it can be built from partial aggregates.
    """
    first_claim = since_up & F.col("first_day_origPrice")
    pick_claim = F.max if orig_break == "min" else F.min
    return {
        "newest": F.max(F.when(change, row)),
        "oldest_since_up": F.min(F.when(since_up, row)),
        "at_first_claim": pick_claim(F.when(first_claim, row)),
    }


def _settle(rule: str, null_break: str, limit: Column | None) -> Column:
    """The valid change among the candidates.

    since_up    the newest change, unless the discount run since the last rise
                has a day on which a claimed price first appeared: then that
                day. With null_break='skip' a run without such a day is traced
                back to its first step; 'strict' leaves it at the newest.
    gradual_v2  the first step of the run since the last rise, else the newest.
    last_change the newest change.
    """
    order = {
        ("since_up", "strict"): ["at_first_claim"],
        ("since_up", "skip"): ["at_first_claim", "oldest_since_up"],
        ("gradual_v2", null_break): ["oldest_since_up"],
        ("last_change", null_break): [],
    }[rule, null_break]
    choices = [F.col(c) for c in order]
    if not choices:
        return _within(F.col("newest"), limit)
    # The first of them that the item has; only if that one is too old does
    # the newest change step in.
    return F.coalesce(_within(F.coalesce(*choices), limit), _within(F.col("newest"), limit))


def _within(row: Column, limit: Column | None) -> Column:
    return row if limit is None else F.when(row["date"] >= limit, row)


def _check_rule(rule: str, null_break: str, orig_break: str) -> None:
    if rule not in RULES or null_break not in ("strict", "skip") or orig_break not in ("min", "max"):
        raise ValueError(f"unknown rule {rule!r}, null_break {null_break!r} or orig_break {orig_break!r}")


def last_valid_change(
    changes: DataFrame,
    rule: str = "since_up",
    null_break: str = "strict",
    orig_break: str = "min",
    limit: Column | None = None,
    keys: Sequence[str] = ITEM,
) -> DataFrame:
    """The price change from which each item's current discount counts (see `_settle`).

    `orig_break` says which day counts when a claimed price appeared more than
    once in the run: the newest ('min' row number) or the oldest ('max').
    `limit` drops changes that are older.
    """
    _check_rule(rule, null_break, orig_break)
    row = F.struct("date", "currentPrice", "price_trend", "row_number", "min_30d")
    found = (
        changes.withColumn("last_up", _last_up(keys, F.lit(True)))
        .groupBy(*keys)
        .agg(*_named(_candidates(row, F.lit(True), _after("last_up"), orig_break)))
    )
    return (
        found.select(*keys, _settle(rule, null_break, limit).alias("valid"))
        .where(F.col("valid").isNotNull())
        .select(*keys, "valid.*")
    )


def min_price_before_sale(valid: DataFrame, keys: Sequence[str] = ITEM) -> DataFrame:
    """Lowest price of the 30 days before a valid change that lowered the price."""
    return valid.where(F.col("price_trend") == "down").select(
        *keys, "date", "currentPrice", "price_trend", F.col("min_30d").alias("min_currentPrice")
    )


def ref_prices(
    unified: DataFrame,
    as_of: Day,
    discount_valid_days: int = 90,
    common_price_days: int | None = 90,
    rule: str = "since_up",
    null_break: str = "strict",
    orig_break: str = "min",
    change_days: int | None = -1,
    limit_days: int | None = None,
    history_days: int | None = None,
    points_days: int | None = None,
    calendar_days: int | None = None,
    keys: Sequence[str] = ITEM,
    by: Sequence[str] = (),
) -> DataFrame:
    """commonPrice and minPrice of each item, stamped with `as_of`.

    The input holds one row per key and day. One exchange by item serves the
    whole plan: windows, then a sum by (item, price), then one row per item;
    the two grouping levels keep the distribution they find.

    `change_days` is the window in which changes count (-1: the discount
    window, None: no window); `limit_days` drops a valid change that is older.
    `common_price_days=None` counts the whole history window.
    """
    _check_rule(rule, null_break, orig_break)
    if change_days == -1:
        change_days = discount_valid_days
    runs = price_runs(
        unified, as_of, discount_valid_days, history_days, points_days, calendar_days, keys, by
    )
    change = _is_change(None if change_days is None else days_before(as_of, change_days))
    days = (
        F.date_diff("run_end", "date") + 1
        if common_price_days is None
        else _days_in_force(days_before(as_of, common_price_days))
    )
    row = F.struct("date", "price_trend", "min_30d")
    candidates = _candidates(row, change, change & _after("last_up"), orig_break)
    per_price = (
        runs.withColumn("last_up", _last_up(keys, change))
        .groupBy(*keys, "currentPrice")
        .agg(F.sum(days).alias("days"), *_named(candidates))
    )
    over = {"newest": F.max, "oldest_since_up": F.min, "at_first_claim": F.max if orig_break == "min" else F.min}
    per_item = per_price.groupBy(*keys).agg(
        _most_frequent(F.when(F.col("days") > 0, F.col("days"))).alias("commonPrice"),
        F.max("days").alias("days"),
        *[fold(name).alias(name) for name, fold in over.items()],
    )
    limit = None if limit_days is None else days_before(as_of, limit_days)
    valid = _settle(rule, null_break, limit)
    return (
        per_item.where(F.col("days") > 0)
        .withColumn("valid", valid)
        .select(
            *keys,
            "commonPrice",
            F.when(F.col("valid.price_trend") == "down", F.col("valid.min_30d")).alias("minPrice"),
            as_day(as_of).alias("date"),
        )
    )


def _named(columns: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in columns.items()]
