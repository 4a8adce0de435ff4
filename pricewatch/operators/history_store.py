"""Price history kept up to date: only what a touched day changes is computed and written.

The stored history is the change-only series of every item, one row for each day
on which its prices differ from the day before (`changes`), and one row per item with its
first and last real day and the prices of the last one (`items`).

An item's changes say what its prices were on any day: those of the last change up to
it, and none outside its days. So a touched day, new, late or corrected, is
compared with the day before it, and the day after it with the touched one. Those two
days, and the ends of the old series when it grows, are the only ones whose
change can come, go or be another; all other rows stay as they are.

What has to be read for that is one row per touched item, as long as the touched
days lie behind its last one. Only items with a day before their end need their stored
changes, and of these the ones up to that day. Days of the price table itself are
never read again.

The blank day behind an item's last real day hangs on today and on the last day of
all items, so it is not stored: `with_tails` adds it when histories are read.

Cases. A null price pair is a day without prices, like a gap. Null keys are an item, null days are
left out. Several rows of an item and day are one day (`dedupe_days`). No touched day changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.days import as_day
from ..functions.prices import not_blank
from ..sources import tables
from .history import ITEM, WIDE_PRICE, Day, _entries, _with_load_limit, dedupe_days, last_attributes, second_latest_load

PAIR = ("o", "c")
CHANGES, ITEMS = "changes", "items"


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda x, y: x & y, [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys])


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str = "_of_") -> DataFrame:
    return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys], *[c for c in df.columns if c not in keys])


def _no_price() -> list[Column]:
    return [F.lit(None).cast(WIDE_PRICE).alias(c) for c in PAIR]


def changed_entries(touched: DataFrame, items: DataFrame, changes: DataFrame | None, keys: Sequence[str] = ITEM) -> DataFrame:
    """Per item and day whose change may come, go or be another: (keys, d, o, c, is_change) with the touched days.

    `touched` has one row per item and day (keys, date, o, c), `items` a row for each stored item
    (keys, first_day, last_day, o, c), `changes` the stored changes of items with a touched day
    that is not behind their last one (keys, d, o, c); they may be more than that.
    """
    stored = _renamed(items.select(*keys, "first_day", "last_day", F.col("o").alias("last_o"), F.col("c").alias("last_c")), keys)
    spans = touched.groupBy(*keys).agg(F.min("date").alias("low"), F.max("date").alias("high"))
    spans = spans.join(stored, _same(spans, stored, keys, "_of_"), "left").drop(*[f"_of_{k}" for k in keys])
    spans = spans.withColumns(
        {"from_day": F.least("low", "first_day"), "to_day": F.greatest("high", "last_day"), "late": F.col("low") <= F.col("last_day")}
    )

    # Days whose change may come or go: the touched ones and those behind them, and the old ends when the series grows.
    around = touched.select(*keys, F.explode(F.array("date", F.date_add("date", 1))).alias("d"))
    ends = spans.select(
        *keys,
        F.explode(
            F.array(
                F.when(F.col("high") > F.col("last_day"), F.date_add("last_day", 1)),
                F.when(F.col("low") < F.col("first_day"), F.col("first_day")),
            )
        ).alias("d"),
    ).where("d is not null")
    asked = around.union(ends).distinct()
    days = asked.select(*keys, F.explode(F.array(F.date_sub("d", 1), F.col("d"))).alias("d")).distinct()

    # What the stored series says: it starts with its first change and ends behind its last day.
    ended = spans.where("last_day is not null")
    known = [
        ended.select(*keys, F.col("last_day").alias("d"), F.col("last_o").alias("o"), F.col("last_c").alias("c")),
        ended.select(*keys, F.date_add("last_day", 1).alias("d"), *_no_price()),
    ]
    if changes is not None:
        of_late = _renamed(spans.where("late").select(*keys), keys)
        known.append(changes.join(of_late, _same(changes, of_late, keys, "_of_"), "left_semi").select(*keys, "d", *PAIR))
    steps = reduce(DataFrame.unionByName, known)

    pair = F.struct(*PAIR)
    rows = (
        steps.select(*keys, "d", pair.alias("step"), F.lit(None).cast(_pair_type()).alias("own"), F.lit(False).alias("asked"))
        .unionByName(
            touched.select(
                *keys, F.col("date").alias("d"), F.lit(None).cast(_pair_type()).alias("step"), pair.alias("own"), F.lit(False).alias("asked")
            )
        )
        .unionByName(
            days.select(*keys, "d", *[F.lit(None).cast(_pair_type()).alias(c) for c in ("step", "own")], F.lit(True).alias("asked"))
        )
    )
    # A row per item and day, at most the days of a calendar per item.
    daily = rows.groupBy(*keys, "d").agg(
        F.max("asked").alias("asked"), F.max("step").alias("step"), F.max("own").alias("own")
    )
    series = Window.partitionBy(*keys).orderBy("d")
    stored_pair = F.last("step", ignorenulls=True).over(series)
    daily = daily.withColumn("now", F.coalesce("own", stored_pair, F.struct(*_no_price())))
    # Of each asked day the day before is asked for as well.
    daily = daily.where("asked").withColumn("before", F.lag("now").over(series))

    wanted = _renamed(asked, [*keys, "d"])
    daily = daily.join(wanted, _same(daily, wanted, [*keys, "d"], "_of_"), "left_semi")
    bounds = _renamed(spans.select(*keys, "from_day", "to_day"), keys)
    daily = daily.join(bounds, _same(daily, bounds, keys, "_of_"))
    first = F.col("d") == F.col("from_day")
    differs = ~F.col("now").eqNullSafe(F.col("before"))
    inside = daily.where(F.col("d").between(F.col("from_day"), F.col("to_day")))
    return inside.select(*keys, "d", "now.*", (first | differs).alias("is_change"))


def _pair_type() -> str:
    return f"struct<o:{WIDE_PRICE},c:{WIDE_PRICE}>"


def updated_items(touched: DataFrame, items: DataFrame, keys: Sequence[str] = ITEM) -> DataFrame:
    """The rows of `items` for touched items: first and last real day, and the prices of the last one."""
    old, of_touched = items.select(*keys, "first_day", "last_day", *PAIR), _renamed(touched.select(*keys).distinct(), keys)
    old = old.join(of_touched, _same(old, of_touched, keys, "_of_"), "left_semi")
    # On a day that is stored and touched the touched prices count.
    rows = touched.select(
        *keys, F.col("date").alias("first_day"), F.col("date").alias("last_day"), *PAIR, F.lit(1).alias("newer")
    ).unionByName(old.withColumn("newer", F.lit(0)))
    newest = F.max_by(F.struct(*PAIR), F.struct("last_day", "newer"))
    return (
        rows.groupBy(*keys)
        .agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), newest.alias("newest"))
        .select(*keys, "first_day", "last_day", "newest.*")
    )


ITEM_COLUMNS = f"first_day date, last_day date, o {WIDE_PRICE}, c {WIDE_PRICE}"


class HistoryStore:
    """The stored history below `root`: `changes` by day, `items` in buckets."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = ITEM, buckets: int = 64) -> None:
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), tuple(keys), buckets

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self) -> bool:
        return tables.table_exists(self.spark, self.path(ITEMS))

    def changes(self) -> DataFrame:
        return tables.read(self.spark, self.path(CHANGES))

    def items(self) -> DataFrame:
        return tables.read(self.spark, self.path(ITEMS))

    def take_loads(self, complete: DataFrame, loads: DataFrame) -> None:
        """Take in what was loaded into the price table since the last time; the days of these loads are all that is read."""
        marker = self.path("_taken")
        taken = tables.read_text(self.spark, marker)
        newer = F.lit(True) if taken is None else F.col("_timestamp") > F.lit(taken).cast("timestamp_ntz")
        new = loads.where(newer)
        newest = new.agg(F.max("_timestamp").cast("string")).first()[0]
        if newest is not None:
            self.update(tables.in_set(complete, "date", new.select("date")).where(newer))
            tables.write_text(self.spark, marker, newest)

    def update(self, rows: DataFrame) -> None:
        """Take in the rows of some days, each as the price table now holds it.

        Doing it again with the same rows changes nothing, so a run that was lost between the two tables is repeated.
        """
        keys, folder = list(self.keys), tables.scratch_dir(self.spark)
        touched = self._written(dedupe_days(rows.where(F.col("date").isNotNull()), keys), f"{folder}/touched")
        if not touched.isEmpty():
            items, changes = self._stored_of(touched)
            entries = self._written(changed_entries(touched, items, changes, keys), f"{folder}/entries")
            ends = self._written(updated_items(touched, items, keys), f"{folder}/ends")
            new = entries.where("is_change").drop("is_change")
            tables.upsert(new, self.path(CHANGES), [*keys, "d"], partition_by="d", keep_stamp=True, replaced=entries.select(*keys, "d"))
            # Last: until it is written, a repeated update sees the old ends.
            tables.upsert(ends, self.path(ITEMS), keys, keep_stamp=True, buckets=self.buckets)
        tables.remove(self.spark, folder)

    def _written(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _stored_of(self, touched: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """The touched items as they are stored, and the changes that late days need: none if there is no late day."""
        keys = self.keys
        if not self.exists():
            named = [f"`{k}` {touched.schema[k].dataType.simpleString()}" for k in keys]
            return self.spark.createDataFrame([], ", ".join([*named, ITEM_COLUMNS])), None
        items = tables.read_buckets(self.spark, self.path(ITEMS), keys, touched)
        ends = _renamed(items.select(*keys, "first_day", "last_day"), keys)
        late = touched.join(ends, _same(touched, ends, keys, "_of_")).where("date <= last_day")
        # The day behind a late one, and the old first day where the late one lies before it.
        last = late.agg(F.max(F.greatest(F.date_add("date", 1), "first_day"))).first()[0]
        return items, None if last is None else self.changes().where(F.col("d") <= F.lit(last))


def with_tails(changes: DataFrame, items: DataFrame, as_of: Day, calendar_end: Column | DataFrame, keys: Sequence[str] = ITEM, by: Sequence[str] = ()) -> DataFrame:
    """Changes with the blank day behind an item's last one, where it lies before `as_of` and the calendar has it.

    `calendar_end` is the last day of all items, or with `by` a row with it (`calendar_end`) for each group.
    """
    if by:
        ends = _renamed(calendar_end, by, "_end_")
        items = items.join(ends, _same(items, ends, by, "_end_"), "left").drop(*[f"_end_{c}" for c in by])
    else:
        items = items.withColumn("calendar_end", calendar_end)
    has_price = F.col("o").isNotNull() | F.col("c").isNotNull()
    open_end = items.where((F.col("last_day") < as_day(as_of)) & (F.col("last_day") < F.col("calendar_end")) & has_price)
    return changes.select(*keys, "d", *PAIR).unionByName(
        open_end.select(*keys, F.date_add("last_day", 1).alias("d"), *_no_price())
    )


def stored_price_history(
    store: HistoryStore,
    complete: DataFrame,
    as_of: Day,
    by: Sequence[str] = (),
    loads: DataFrame | None = None,
    skip_slugs_like: str | None = None,
) -> DataFrame:
    """`history.price_history` from the stored changes: of the price table only the last two loads are read."""
    keys = list(store.keys)
    items, recent, limits = store.items(), complete, second_latest_load(complete, by)
    if loads is not None:
        recent, limits = tables.in_set(complete, "date", tables.newest_loads(loads, 2, by).select("date")), second_latest_load(loads, by)
    attributes = last_attributes(recent, keys, by, skip_slugs_like=skip_slugs_like, limits=limits)
    attributes = attributes.where(F.col("commonPrice").isNotNull() & not_blank("slug"))
    # The calendar ends with the last day of the items of these loads.
    active = _renamed(_with_load_limit(recent, limits, by).where(F.col("_timestamp") >= F.col("load_limit")).select(*keys).distinct(), keys)
    ends = items.join(active, _same(items, active, keys, "_of_"), "left_semi")
    last = F.max("last_day").alias("calendar_end")
    entries = with_tails(store.changes(), items, as_of, ends.groupBy(*by).agg(last) if by else ends.agg(last).scalar(), keys, by)
    price = "decimal(12,2)"
    # The items are known before their entries are gathered.
    entries = entries.join(attributes.select(*keys).distinct(), keys, "left_semi")
    documents = entries.groupBy(*keys).agg(_entries(o=F.col("o").cast(price), c=F.col("c").cast(price)).alias("json"))
    return documents.join(attributes, keys).select(
        *[c for c in keys if c != "slug"], "slug", "shop_id", "json", "commonPrice", "minPrice"
    )
