"""Price history per item: days with gaps made visible, then changes only.

A day without a price becomes an entry with no prices, once. The change-only
form is built straight from the real days: each yields itself when it differs
from the calendar day before it, and the first blank day after it when a gap
follows. So the dense calendar never has to exist, although `fill_history`
gives it on request.

Windows and the final list run over at most one row per item and calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.days import as_day
from ..functions.frames import nulls_last, with_table_value
from ..functions.prices import not_blank, plain_price_text, shop_domain
from ..sources.tables import in_set, newest_loads

ITEM = ("itemId",)
WIDE_PRICE = "decimal(20,2)"

Day = date | Column | None


def second_latest_load(complete: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Load time before the newest one; NULL when there is only one load.

    `complete` may be the table's rows or its side table (`tables.loads`): the loads are the same.
    """
    older = with_table_value(complete, complete, F.max("_timestamp"), "newest_load", by).where(
        F.col("_timestamp") < F.col("newest_load")
    )
    return older.groupBy(*by).agg(F.max("_timestamp").alias("load_limit"))


def _load_limits(complete: DataFrame, by: Sequence[str]) -> DataFrame:
    """`second_latest_load`: a scalar, or a row per group, whose join AQE plans by its size."""
    return second_latest_load(complete, by)


def _with_load_limit(rows: DataFrame, limits: DataFrame, by: Sequence[str]) -> DataFrame:
    if by:
        return rows.join(limits, list(by), "left")
    return rows.withColumn("load_limit", limits.scalar())


def items_changed_since(
    complete: DataFrame, keys: Sequence[str] = ITEM, by: Sequence[str] = (), loads: DataFrame | None = None
) -> DataFrame:
    """Items that took part in one of the last two loads; with the side table `loads` only the days of these are read."""
    limits = _load_limits(complete if loads is None else loads, by)
    if loads is not None:
        complete = in_set(complete, "date", newest_loads(loads, 2, by).select("date"))
    rows = _with_load_limit(complete, limits, by)
    return rows.where(F.col("_timestamp") >= F.col("load_limit")).select(*keys).distinct()


def _recent_span(
    complete: DataFrame, limits: DataFrame, keys: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Last day of each item of the last two loads."""
    items = complete.groupBy(*keys).agg(F.max("_timestamp").alias("last_load"), F.max("date").alias("date"))
    return _with_load_limit(items, limits, by).where(F.col("last_load") >= F.col("load_limit"))


def recent_items_only(
    complete: DataFrame, keys: Sequence[str] = ITEM, by: Sequence[str] = (), loads: DataFrame | None = None
) -> DataFrame:
    """All rows of the items that took part in one of the last two loads."""
    return complete.join(items_changed_since(complete, keys, by, loads), list(keys), "left_semi")


def dedupe_days(complete: DataFrame, keys: Sequence[str] = ITEM) -> DataFrame:
    """One price pair per item and day: the lowest selling price, then the highest claim."""
    return _days_with_load(complete, keys).drop("last_load")


def _days_with_load(complete: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`dedupe_days` with the newest load time of each day's rows."""
    o, c = F.col("originalPrice").cast(WIDE_PRICE), F.col("currentPrice").cast(WIDE_PRICE)
    order = F.struct(*nulls_last(c), *nulls_last(-o))
    pair = F.min_by(F.struct(o.alias("o"), c.alias("c")), order)
    days = complete.groupBy(*keys, "date").agg(pair.alias("pair"), F.max("_timestamp").alias("last_load"))
    return days.select(*keys, "date", "pair.*", "last_load")


def _recent_days(
    complete: DataFrame, limits: DataFrame, keys: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Days of the items that took part in one of the last two loads.

    Days are reduced to one row each before the items are told apart, and the
    test is a maximum over the item's own days: the windows that follow need
    that distribution anyway, so it costs no exchange of its own.
    """
    item_load = F.max("last_load").over(Window.partitionBy(*keys))
    days = _days_with_load(complete, keys).withColumn("item_load", item_load)
    return (
        _with_load_limit(days, limits, by)
        .where(F.col("item_load") >= F.col("load_limit"))
        .select(*keys, "date", "o", "c")
    )


def item_date_range(days: DataFrame, as_of: Day, keys: Sequence[str] = ITEM) -> DataFrame:
    """First and last day per item; the last moves on by one when it lies before `as_of`."""
    last = F.max("date")
    return days.groupBy(*keys).agg(
        F.min("date").alias("min_d"),
        F.when(last < as_day(as_of), F.date_add(last, 1)).otherwise(last).alias("max_d"),
    )


def _with_gap_end(
    days: DataFrame, as_of: Day, keys: Sequence[str], by: Sequence[str], span: DataFrame | None
) -> DataFrame:
    """Add `gap_end`: the last day before the item's next real day.

    The last real day of an item is followed by one blank day if it lies before
    `as_of` and the calendar, which ends at the last day of `span`, has it.
    """
    series = Window.partitionBy(*keys).orderBy("date")
    tail = F.when(
        F.col("date") < as_day(as_of), F.least(F.date_add("date", 1), F.col("last_real_day"))
    ).otherwise(F.col("date"))
    return with_table_value(days, days if span is None else span, F.max("date"), "last_real_day", by).withColumn(
        "gap_end", F.coalesce(F.date_sub(F.lead("date").over(series), 1), tail)
    )


def fill_history(
    days: DataFrame,
    as_of: Day,
    keys: Sequence[str] = ITEM,
    by: Sequence[str] = (),
    span: DataFrame | None = None,
) -> DataFrame:
    """Every day of each item's range; days without a price have no prices.

    `span` is a frame whose last `date` ends the calendar, by default `days`
    itself: give the table the days come from when that is cheaper to read.
    """
    unrolled = _with_gap_end(days, as_of, keys, by, span).withColumn(
        "d", F.explode(F.sequence("date", "gap_end"))
    )
    on_day = F.col("d") == F.col("date")
    return unrolled.select(*keys, "d", *[F.when(on_day, F.col(c)).alias(c) for c in ("o", "c")])


def history_changes(
    days: DataFrame,
    as_of: Day,
    keys: Sequence[str] = ITEM,
    by: Sequence[str] = (),
    span: DataFrame | None = None,
) -> DataFrame:
    """The days of `fill_history` on which a price differs from the day before, without building it."""
    series = Window.partitionBy(*keys).orderBy("date")
    previous = {f"previous_{c}": F.lag(c).over(series) for c in ("date", "o", "c")}

    first = F.col("previous_date").isNull()
    follows_on = F.col("previous_date") == F.date_sub("date", 1)
    blank = F.col("o").isNull() & F.col("c").isNull()
    same_pair = F.col("previous_o").eqNullSafe(F.col("o")) & F.col("previous_c").eqNullSafe(F.col("c"))
    # After a gap the day before has no prices, so only a blank day repeats it.
    changed = first | F.when(follows_on, ~same_pair).otherwise(~blank)
    gap_opens = (F.col("gap_end") > F.col("date")) & ~blank

    no_price = F.lit(None).cast(WIDE_PRICE)
    own = F.struct(F.col("date").alias("d"), "o", "c")
    gap = F.struct(F.date_add("date", 1).alias("d"), no_price.alias("o"), no_price.alias("c"))
    entries = (
        F.when(changed & gap_opens, F.array(own, gap))
        .when(changed, F.array(own))
        .when(gap_opens, F.array(gap))
    )
    return (
        _with_gap_end(days, as_of, keys, by, span)
        .withColumns(previous)
        .withColumn("entry", F.explode(entries))
        .select(*keys, "entry.*")
    )


def last_attributes(
    complete: DataFrame,
    keys: Sequence[str] = ITEM,
    by: Sequence[str] = (),
    recent_only: bool = True,
    need_slug: bool = True,
    skip_slugs_like: str | None = None,
    limits: DataFrame | None = None,
) -> DataFrame:
    """Newest slug, p_key and reference prices per item, and the shop's domain.

    Slug and p_key skip missing values; reference prices do not. All are the
    item's last ones, also where its shop changed its label; an item of
    several domains gets a row for each.
    """
    rows = complete
    if need_slug:
        rows = rows.where(not_blank("slug"))
    if skip_slugs_like:
        rows = rows.where(~F.col("slug").ilike(skip_slugs_like))
    if recent_only:
        limits = _load_limits(complete, by) if limits is None else limits
        rows = _with_load_limit(rows, limits, by).where(F.col("_timestamp") >= F.col("load_limit"))

    def last_known(name: str) -> Column:
        return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.struct("date", name)))

    newest_row = F.max(F.struct("date", "commonPrice", "minPrice"))
    found = rows.groupBy(*keys).agg(
        *[last_known(c).alias(c) for c in ("slug", "p_key") if c not in keys],
        newest_row.alias("newest_row"),
        F.collect_set(shop_domain() if "shop" not in keys else F.lit("")).alias("_domains"),
        F.max(F.when(shop_domain().isNull(), True)).alias("_unknown") if "shop" not in keys else F.lit(None).alias("_unknown"),
    )
    if "shop" in keys:
        found = found.withColumn("shop_id", shop_domain())
    else:
        # A set leaves NULL out; a domain that is not known is a row as well.
        unknown = F.when(F.col("_unknown"), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
        found = found.withColumn("shop_id", F.explode(F.concat("_domains", unknown)))
    return found.select(
        *keys,
        "shop_id",
        *[c for c in ("slug", "p_key") if c not in keys],
        "newest_row.commonPrice",
        "newest_row.minPrice",
    )


def _entries(d: str = "d", o: str | Column = "o", c: str | Column = "c") -> Column:
    """Entries in day order; a day occurs once per item, so the day alone decides."""
    entry = F.struct(
        F.col(d).alias("d"),
        (F.col(o) if isinstance(o, str) else o).alias("o"),
        (F.col(c) if isinstance(c, str) else c).alias("c"),
    )
    return F.sort_array(F.collect_list(entry))


def price_history(
    complete: DataFrame,
    as_of: Day,
    keys: Sequence[str] = ITEM,
    by: Sequence[str] = (),
    skip_slugs_like: str | None = None,
) -> DataFrame:
    """Change-only history of every item of the last two loads, with its last reference prices.

    Only items with a slug and a commonPrice get a history. `json` is an array
    of {d, o, c}; it becomes text at the sink.
    """
    limits = _load_limits(complete, by)
    days = _recent_days(complete, limits, keys, by)
    changes = history_changes(days, as_of, keys, by, span=_recent_span(complete, limits, keys, by))
    attributes = last_attributes(complete, keys, by, skip_slugs_like=skip_slugs_like, limits=limits)
    attributes = attributes.where(F.col("commonPrice").isNotNull() & not_blank("slug"))
    price = "decimal(12,2)"
    documents = changes.groupBy(*keys).agg(
        _entries(o=F.col("o").cast(price), c=F.col("c").cast(price)).alias("json")
    )
    return documents.join(attributes, list(keys)).select(
        *[c for c in keys if c != "slug"], "slug", "shop_id", "json", "commonPrice", "minPrice"
    )


def price_history_by_pkey(complete: DataFrame, as_of: Day, keys: Sequence[str] = ITEM) -> DataFrame:
    """Older document per p_key over all items: price texts, '' for a missing price."""
    changes = history_changes(dedupe_days(complete, keys), as_of, keys, span=complete)
    attributes = last_attributes(complete, keys, recent_only=False, need_slug=False)
    rows = changes.join(attributes.where(not_blank("p_key")).select(*keys, "p_key"), list(keys))
    return rows.groupBy("p_key").agg(_entries(o=plain_price_text("o"), c=plain_price_text("c")).alias("json"))


def price_history_plain(
    complete: DataFrame, as_of: Day, recent_days: int | None = None, keys: Sequence[str] = ITEM
) -> DataFrame:
    """Older document per item over all items, without reference prices.

    An item needs a slug and, where `recent_days` is given, a change after `as_of` - `recent_days`.
    """
    changes = history_changes(dedupe_days(complete, keys), as_of, keys, span=complete)
    price = "decimal(12,2)"
    documents = changes.groupBy(*keys).agg(
        _entries(o=F.col("o").cast(price), c=F.col("c").cast(price)).alias("json"),
        F.max("d").alias("last_change"),
    )
    if recent_days is not None:
        documents = documents.where(F.col("last_change") > F.date_sub(as_day(as_of), recent_days))
    attributes = last_attributes(complete, keys, recent_only=False, need_slug=False)
    return documents.join(attributes.where(not_blank("slug")), list(keys)).select(
        *[c for c in keys if c != "slug"], "slug", "shop_id", "json"
    )
