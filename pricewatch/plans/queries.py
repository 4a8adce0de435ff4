"""The registered queries: one per operator, over the whole given tables.

Each takes (spark, sf_dir). "Today" is the last day of the data, read as a
scalar subquery, so results follow the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.days import days_before
from ..functions.frames import tune
from ..functions.prices import shop_domain
from ..operators import audit, complete, history, metadata, migrate, publish, refprice, unify
from ..operators.history_store import HistoryStore, stored_price_history, with_tails
from ..sources import checks, documents, offers, raw as raw_offers, tables
from ..streaming import stream_unify

VALID_DAYS = 15
COMMON_DAYS = 20
RECENT_DAYS = 10
ALL_DAYS = 40
ITEM = ("itemId",)
BY_SLUG = ("itemId", "slug")
BY_SHOP = ("shop", "itemId")

Query = Callable[[SparkSession, str], DataFrame]


def today(spark: SparkSession, sf: str) -> Column:
    events = offers.read_table(spark, sf, "events")
    return events.agg(F.max(F.to_date("ts")).alias("today")).scalar()


_stage_paths: dict[tuple, str] = {}


def _stored(spark: SparkSession, name: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage's result as a stored table, written once per application.

    Stages hand over stored tables, as in production, so a query's plan starts
    at a scan and the stages before it do not run again for each use.
    """
    key = (spark.sparkContext.applicationId, *name)
    path = _stage_paths.get(key)
    if path is None or not tables.path_exists(spark, f"{path}/_SUCCESS"):
        path = tables.scratch_dir(spark)
        build().write.parquet(path)
        _stage_paths[key] = path
    return spark.read.parquet(path)


def _unified_plan(spark: SparkSession, sf: str, keys=ITEM, shared=False) -> DataFrame:
    raw = offers.raw_offers(spark, sf, shared=shared)
    return unify.one_per_day(unify.unify(raw, "day", by=_groups(keys)), keys)


def _groups(keys) -> tuple[str, ...]:
    return ("shop",) if "shop" in keys else ()


def unified(spark: SparkSession, sf: str, keys=ITEM, shared=False) -> DataFrame:
    """One row per key and day; `shared`: of the feed whose shops use the same item ids."""
    return _stored(spark, ("unified", sf, keys, shared), lambda: _unified_plan(spark, sf, keys, shared))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return refprice.price_runs(unified(spark, sf), today(spark, sf), VALID_DAYS)


def changes(spark: SparkSession, sf: str) -> DataFrame:
    return refprice.price_changes(runs(spark, sf), days_before(today(spark, sf), VALID_DAYS))


def reference(spark: SparkSession, sf: str, keys=ITEM, by=(), shared=False, **options) -> DataFrame:
    options = {"discount_valid_days": VALID_DAYS, "common_price_days": COMMON_DAYS, **options}
    rows = unified(spark, sf, keys, shared)
    return refprice.ref_prices(rows, today(spark, sf), keys=keys, by=by, **options)


def completed(spark: SparkSession, sf: str, keys=ITEM, shared=False) -> DataFrame:
    """All days with the reference prices of the last day, as if they had held on every day."""
    return _stored(spark, ("completed", sf, keys, shared), lambda: _completed_plan(spark, sf, keys, shared))


def _completed_plan(spark: SparkSession, sf: str, keys, shared) -> DataFrame:
    events = offers.read_table(spark, sf, "events")
    span = events.agg(F.sequence(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).alias("days")).scalar()
    prices = reference(spark, sf, keys, _groups(keys) if shared else (), shared)
    every_day = prices.withColumn("date", F.explode(span))
    return complete.complete(unified(spark, sf, keys, shared), every_day, ALL_DAYS, today(spark, sf), keys)


def days(spark: SparkSession, sf: str) -> DataFrame:
    return history.dedupe_days(completed(spark, sf))


def json_text(df: DataFrame, column: str = "json") -> DataFrame:
    """JSON column as text; prices as plain numbers, which every engine writes alike."""
    entry = "array<struct<d:date,o:double,c:double>>"
    kind = df.schema[column].dataType.typeName()
    target = entry if kind == "array" else f"struct<entries:{entry},commonPrice:double,minPrice:double>"
    return df.withColumn(column, publish.as_json_text(F.col(column).cast(target)))


# --- stage 01 ---------------------------------------------------------------


def recent_rows(spark, sf):
    return unify.recent(offers.raw_offers(spark, sf), today(spark, sf), RECENT_DAYS)


def recent_rows_by_date(spark, sf):
    return unify.recent(offers.raw_offers(spark, sf), today(spark, sf), RECENT_DAYS, "date")


def unify_prices(spark, sf):
    return unify.unify(offers.raw_offers(spark, sf), "scrape")


def unify_prices_daily(spark, sf):
    return unify.unify(offers.raw_offers(spark, sf), "day")


def unify_prices_keyed(spark, sf):
    return _unified_plan(spark, sf)


def unify_prices_by_shop(spark, sf):
    """Shops that use the same item ids keep their own prices."""
    return _unified_plan(spark, sf, BY_SHOP, shared=True)


def unify_prices_used_goods(spark, sf):
    """A flag of the shop's own, here set where a price is claimed, passes through."""
    flag = F.when(F.col("originalPrice") == "", "false").otherwise("true")
    return unify.unify(offers.raw_offers(spark, sf).withColumn("usedGoods", flag), "day", extra=["usedGoods"])


def item_count_check(spark, sf):
    return unify.item_count_check(recent_rows(spark, sf), offers.raw_offers(spark, sf))


def item_count_check_by_shop(spark, sf):
    raw = offers.raw_offers(spark, sf, shared=True)
    return unify.item_count_check(unify.recent(raw, today(spark, sf), RECENT_DAYS), raw, by=("shop",))


def merge_feeds(spark, sf):
    second = unify.one_per_day(unify.unify(offers.second_feed(spark, sf), "day"))
    return unify.merge_feeds(unified(spark, sf), second)


def merge_feeds_extra(spark, sf):
    """Three feeds of one shop's items; the first two have a column of the shop's own."""
    raw = offers.raw_offers(spark, sf)
    flagged = raw.withColumn("usedGoods", F.when(F.col("originalPrice") == "", "false").otherwise("true"))
    clicks = offers.second_feed(spark, sf).withColumn("usedGoods", F.lit("click"))
    views = offers.raw_offers(spark, sf, price_shift=3, event_type="view")
    one = lambda feed, extra: unify.one_per_day(unify.unify(feed, "day", extra=extra))
    # The main feed is the smallest, so each column comes from every feed for some items.
    return unify.merge_all([one(clicks, ["usedGoods"]), one(views, []), one(flagged, ["usedGoods"])], extra=["usedGoods"])


# --- stage 02 ---------------------------------------------------------------


def active_items(spark, sf):
    return refprice.active_items(unified(spark, sf), today(spark, sf), VALID_DAYS + refprice.LOOKBACK_DAYS)


def calendar_days(spark, sf):
    return refprice.calendar(unified(spark, sf))


def date_item_grid(spark, sf):
    return refprice.date_item_grid(unified(spark, sf), active_items(spark, sf))


def price_points(spark, sf):
    return refprice.price_points(unified(spark, sf), today(spark, sf), VALID_DAYS + refprice.LOOKBACK_DAYS)


def gap_fill(spark, sf):
    return refprice.gap_fill(runs(spark, sf))


def price_trend(spark, sf):
    return refprice.fill_days(runs(spark, sf))


def common_price(spark, sf):
    return refprice.common_price(runs(spark, sf), days_before(today(spark, sf), COMMON_DAYS))


def price_changes(spark, sf):
    return changes(spark, sf).drop("min_30d")


def changes_since_up(spark, sf):
    return refprice.changes_since_up(changes(spark, sf)).drop("min_30d")


def _valid(**options) -> Query:
    def query(spark, sf):
        return refprice.last_valid_change(changes(spark, sf), **options).drop("min_30d")

    return query


def last_change_v1(spark, sf):
    as_of = today(spark, sf)
    old_runs = refprice.price_runs(
        unified(spark, sf), as_of, history_days=25, points_days=29, calendar_days=91
    )
    return refprice.last_valid_change(
        refprice.price_changes(old_runs), rule="last_change", limit=days_before(as_of, VALID_DAYS)
    ).drop("min_30d")


def min_price_30d(spark, sf):
    return refprice.min_price_before_sale(refprice.last_valid_change(changes(spark, sf)))


def _reference(keys=ITEM, by=(), **options) -> Query:
    return lambda spark, sf: reference(spark, sf, keys, by, **options)


# --- stage 03 ---------------------------------------------------------------


def latest_batch(spark, sf):
    return complete.latest_batch(unified(spark, sf))


def _by_day(spark, sf, keys=ITEM):
    """The unified table stored by day, with its side table of loads."""
    path = f"{tables.scratch_dir(spark)}/unified"
    tables.upsert(unified(spark, sf, keys), path, [*keys, "date"], partition_by="date", keep_stamp=True)
    return tables.read(spark, path).select(*unify.UNIFIED, "_timestamp"), tables.loads(spark, path)


def latest_batch_from_loads(spark, sf):
    """The newest load by the side table; only its days are read."""
    rows, loads = _by_day(spark, sf)
    return complete.latest_batch(rows, loads=loads)


def latest_batch_by_shop_from_loads(spark, sf):
    rows, loads = _by_day(spark, sf, BY_SHOP)
    return complete.latest_batch(rows, ("shop",), loads)


def suspicious_prices_from_loads(spark, sf):
    rows, loads = _by_day(spark, sf)
    return complete.suspicious_prices(rows, loads=loads)


def latest_batch_by_shop(spark, sf):
    return complete.latest_batch(unified(spark, sf, BY_SHOP), by=("shop",))


def complete_prices(spark, sf):
    return complete.complete(unified(spark, sf), reference(spark, sf))


def complete_prices_window(spark, sf):
    return complete.complete(unified(spark, sf), reference(spark, sf), ALL_DAYS, today(spark, sf))


def complete_prices_by_slug(spark, sf):
    """Also passes a column of its own through, as a shop with used goods does."""
    rows = unified(spark, sf, BY_SLUG).withColumn("usedGoods", F.lit("false"))
    return complete.complete(rows, reference(spark, sf, BY_SLUG), keys=BY_SLUG)


def suspicious_prices(spark, sf):
    return complete.suspicious_prices(unified(spark, sf))


def suspicious_prices_by_slug(spark, sf):
    return complete.suspicious_prices(unified(spark, sf, BY_SLUG), keys=BY_SLUG)


# --- stage 04 ---------------------------------------------------------------


def latest_metadata(spark, sf):
    return metadata.latest_metadata(completed(spark, sf), today(spark, sf), RECENT_DAYS)


def latest_metadata_by_slug(spark, sf):
    return metadata.latest_metadata(completed(spark, sf, BY_SLUG), today(spark, sf), RECENT_DAYS, BY_SLUG)


def latest_metadata_wide(spark, sf):
    return metadata.latest_metadata(completed(spark, sf), today(spark, sf), RECENT_DAYS, wide=True)


# --- stage 05 ---------------------------------------------------------------


def second_latest_load(spark, sf):
    return history.second_latest_load(completed(spark, sf))


def recent_items_semi(spark, sf):
    return history.recent_items_only(completed(spark, sf), keys=ITEM)


def dedupe_days(spark, sf):
    return days(spark, sf)


def item_date_range(spark, sf):
    return history.item_date_range(days(spark, sf), today(spark, sf))


def fill_history(spark, sf):
    return history.fill_history(days(spark, sf), today(spark, sf))


def history_changes(spark, sf):
    return history.history_changes(days(spark, sf), today(spark, sf))


def last_attributes(spark, sf):
    return history.last_attributes(completed(spark, sf))


def price_history(spark, sf):
    return json_text(history.price_history(completed(spark, sf), today(spark, sf)))


def price_history_by_shop(spark, sf):
    rows = completed(spark, sf, BY_SHOP)
    return json_text(history.price_history(rows, today(spark, sf), BY_SHOP, by=("shop",)))


def price_history_by_slug(spark, sf):
    rows = completed(spark, sf, BY_SLUG)
    return json_text(history.price_history(rows, today(spark, sf), BY_SLUG, skip_slugs_like="%-11%"))


def price_history_by_slug_whole(spark, sf):
    """No slug is left out."""
    rows = completed(spark, sf, BY_SLUG)
    return json_text(history.price_history(rows, today(spark, sf), BY_SLUG))


def price_history_by_pkey(spark, sf):
    rows = history.price_history_by_pkey(completed(spark, sf), today(spark, sf))
    return rows.withColumn("json", F.to_json("json"))


def price_history_plain(spark, sf):
    return json_text(history.price_history_plain(completed(spark, sf), today(spark, sf), RECENT_DAYS))


def price_history_plain_whole(spark, sf):
    return json_text(history.price_history_plain(completed(spark, sf), today(spark, sf)))


def _loaded(spark, sf):
    """The complete table loaded in three parts: old days, of which some come late and some wrong; ten days; the rest with the late and right ones.

    Returns the table's path and its parts, each as it was loaded.
    """
    rows, as_of = completed(spark, sf), today(spark, sf)
    # Late rows: the items of one of four hashes on every third day; wrong ones: another hash, five dearer at first.
    kind, old = F.pmod(F.xxhash64("itemId"), F.lit(4)), F.col("date") <= days_before(as_of, 12)
    late, wrong = old & (kind == 1) & (F.dayofmonth("date") % 3 == 0), old & (kind == 2)
    dearer = (F.col("currentPrice") + 5).cast("decimal(12,2)")
    parts = (
        rows.where(old & ~late).withColumn("currentPrice", F.when(wrong, dearer).otherwise(F.col("currentPrice"))),
        rows.where(~old & (F.col("date") <= days_before(as_of, 2))),
        rows.where(late | wrong | (F.col("date") > days_before(as_of, 2))),
    )
    path = f"{tables.scratch_dir(spark)}/complete"
    for part in parts:
        tables.upsert(part, path, ["itemId", "date"], partition_by="date", keep_stamp=True)
        yield path, part


def _incremental(spark, sf):
    """The stored history after each part was loaded, and the table."""
    store = None
    for path, part in _loaded(spark, sf):
        store = store or HistoryStore(spark, f"{path}-history", buckets=8)
        store.update(part)
    return store, path


def history_changes_incremental(spark, sf):
    """The changes that the touched days of three loads leave behind, late and corrected ones among them."""
    store, _ = _incremental(spark, sf)
    items = store.items()
    return with_tails(store.changes(), items, today(spark, sf), items.agg(F.max("last_day")).scalar())


def price_history_incremental(spark, sf):
    store, path = _incremental(spark, sf)
    documents = stored_price_history(store, tables.read(spark, path), today(spark, sf), loads=tables.loads(spark, path))
    return json_text(documents)


# --- stage 06 ---------------------------------------------------------------


def shop_domains(spark, sf):
    names = offers.raw_offers(spark, sf).select("shop").distinct()
    labels = offers.read_table(spark, sf, "documents").select(F.col("source").alias("shop")).distinct()
    return names.union(labels).distinct().select("shop", shop_domain().alias("shop_id"))


def _stamped_metadata(spark, sf, wide=False):
    return metadata.latest_metadata(
        completed(spark, sf), today(spark, sf), ALL_DAYS, wide=wide, extra=("_timestamp",)
    )


def publish_metadata(spark, sf):
    return publish.publish_metadata(_stamped_metadata(spark, sf), today(spark, sf), 1)


def publish_metadata_by_shop(spark, sf):
    """Slugs that several shops use: each shop needs a fresh load of its own."""
    rows = completed(spark, sf, BY_SHOP, shared=True)
    stamped = metadata.latest_metadata(rows, today(spark, sf), ALL_DAYS, BY_SHOP, extra=("_timestamp",))
    return publish.publish_metadata(stamped, today(spark, sf), 1, by=("shop",))


def publish_metadata_pkey(spark, sf):
    return publish.publish_metadata(_stamped_metadata(spark, sf, wide=True), today(spark, sf), 1, by_pkey=True)


def _stamped_history(spark, sf):
    """Histories as stored: stamped with the load of the item's newest row."""
    rows = completed(spark, sf)
    loads = rows.groupBy("itemId").agg(F.max("_timestamp").alias("_timestamp"))
    return history.price_history(rows, today(spark, sf)).join(loads, "itemId")


def publish_history(spark, sf):
    return json_text(publish.publish_history(_stamped_history(spark, sf), today(spark, sf), 1))


def publish_history_plain(spark, sf):
    return json_text(publish.publish_history(_stamped_history(spark, sf), today(spark, sf), 1, wrap=False))


# --- stage 07 ---------------------------------------------------------------


def _audit_inputs(spark, sf, settings):
    """Complete prices and raw offers; audits by shop take the feed whose shops share item ids."""
    shared = bool(settings.by)
    return completed(spark, sf, tuple(settings.keys), shared), offers.raw_offers(spark, sf, shared=shared)


def _audited(kind: str, settings=audit.DEFAULT):
    def frame(spark, sf):
        make = audit.audit_snapshot if kind == "snapshot" else audit.audit_window
        return make(*_audit_inputs(spark, sf, settings), settings)

    return frame


SHORT_WINDOW = audit.AuditSettings(window_days=12)


def audit_stamp(spark, sf):
    return audit.audit_stamp(offers.raw_offers(spark, sf))


def audit_stamp_by_shop(spark, sf):
    return audit.audit_stamp(offers.raw_offers(spark, sf, shared=True), by=("shop",))


def _on_snapshot(operator, settings=audit.DEFAULT) -> Query:
    return lambda spark, sf: operator(_audited("snapshot", settings)(spark, sf), settings)


def _raised(settings, with_partner=False) -> Query:
    def query(spark, sf):
        partner = offers.partner_feed(spark, sf, bool(settings.by)) if with_partner else None
        window = _audited("window", settings)(spark, sf)
        return audit.raised_reference_price(window, today(spark, sf), settings, partner)

    return query


def false_discounts_partner(spark, sf):
    return audit.false_discounts_with_partner(
        _audited("snapshot")(spark, sf), offers.partner_feed(spark, sf)
    )


def false_discounts_partner_by_shop(spark, sf):
    """Shops that sell the same items, each with its own partners, several a day."""
    partner = offers.partner_feed(spark, sf, shared=True)
    return audit.false_discounts_with_partner(_audited("snapshot", audit.BY_SHOP)(spark, sf), partner, audit.BY_SHOP)


def count_raised(spark, sf):
    return audit.count_raised(_raised(audit.DEFAULT)(spark, sf))


def _dashboard(settings) -> Query:
    def query(spark, sf):
        return audit.audit_dashboard(*_audit_inputs(spark, sf, settings), settings)

    return query


# --- migration, tables, checks, stream --------------------------------------


def migrate_unified(spark, sf):
    return migrate.migrate_unified(offers.legacy(unified(spark, sf)))


def migrate_reference(spark, sf):
    return migrate.migrate_reference(offers.legacy(completed(spark, sf)))


def migrate_complete(spark, sf):
    return migrate.migrate_complete(offers.legacy(completed(spark, sf)))


def create_if_absent(spark, sf):
    """Created from a CSV of all raw offers; the second call finds the table and leaves it."""
    root = tables.scratch_dir(spark)
    raw = offers.raw_offers(spark, sf).drop("_timestamp")
    raw.write.option("header", True).option("emptyValue", "").csv(f"{root}/template")
    raw.limit(0).write.option("header", True).csv(f"{root}/empty")
    tables.create_if_absent(spark, f"{root}/raw", f"{root}/template")
    tables.create_if_absent(spark, f"{root}/raw", f"{root}/empty")
    return tables.read(spark, f"{root}/raw").drop("_timestamp").na.fill("")


def _two_loads(spark, sf):
    """A first load up to ten days before the end; a second, ten cheaper, of the last 15 days, claimed or not.

    Every row, one without a day too, is in one of them; five days are in both.
    """
    rows = unified(spark, sf)
    as_of = today(spark, sf)
    first = rows.where((F.col("date") <= days_before(as_of, 10)) | F.col("date").isNull())
    cheaper = (F.col("currentPrice") - 10).cast("decimal(12,2)")
    return first, rows.where(F.col("date") >= days_before(as_of, 15)).withColumn("currentPrice", cheaper)


def upsert(spark, sf):
    path = f"{tables.scratch_dir(spark)}/unified"
    for load in _two_loads(spark, sf):
        tables.upsert(load, path, ["itemId", "date"], partition_by="date", keep_stamp=True)
    return tables.read(spark, path)


def upsert_unpartitioned(spark, sf):
    path = f"{tables.scratch_dir(spark)}/unified"
    for load in _two_loads(spark, sf):
        tables.upsert(load, path, ["itemId", "date"], keep_stamp=True)
    return tables.read(spark, path)


def replace_table(spark, sf):
    """The first load, then all rows in its place."""
    path = f"{tables.scratch_dir(spark)}/unified"
    for load in (_two_loads(spark, sf)[0], unified(spark, sf)):
        tables.replace(load, path)
    return tables.read(spark, path).drop("_timestamp")


def upsert_buckets(spark, sf):
    """An item table in buckets of its key's hash, loaded twice."""
    path = f"{tables.scratch_dir(spark)}/unified"
    for load in _two_loads(spark, sf):
        tables.upsert(load, path, ["itemId", "date"], keep_stamp=True, buckets=8)
    return tables.read(spark, path)


def dashboard_history(spark, sf):
    """The dashboard of two audits with different windows: same stamp, so the history keeps the second."""
    root = tables.scratch_dir(spark)
    for settings in (audit.OLDER, audit.DEFAULT):
        tables.snapshot_and_history(
            _dashboard(settings)(spark, sf), f"{root}/current", f"{root}/history", ["Aktualizace"]
        )
    return tables.read(spark, f"{root}/history").drop("_timestamp")


def json_sink_roundtrip(spark, sf):
    path = tables.scratch_dir(spark)
    documents.write_documents(publish_history(spark, sf), path, "pricehistory")
    return documents.read_documents(spark, path, "pricehistory")


def json_sink_metadata(spark, sf):
    path = tables.scratch_dir(spark)
    documents.write_documents(publish_metadata(spark, sf), path, "metadata")
    return documents.read_documents(spark, path, "metadata")


def _tables(spark, sf):
    return {
        "unified": unified(spark, sf),
        "raw": offers.raw_offers(spark, sf),
        "second": offers.second_feed(spark, sf),
    }


def table_inventory(spark, sf):
    return checks.table_inventory(_tables(spark, sf))


def row_count_drift(spark, sf):
    """Yesterday's inventory leaves out the last day's loads, and does not know the second feed."""
    now = _tables(spark, sf)
    cut = today(spark, sf).cast("timestamp_ntz")
    before = {
        "unified": now["unified"].where(F.col("_timestamp") < cut),
        "raw": now["raw"],
    }
    return checks.row_count_drift(
        checks.table_inventory(now), checks.table_inventory(before), today(spark, sf)
    )


def freshness(spark, sf):
    now = _tables(spark, sf)
    stale = now["raw"].where(F.col("_timestamp") < today(spark, sf).cast("timestamp_ntz"))
    return checks.freshness({**now, "stale": stale}, today(spark, sf))


def _landed(spark, sf, root, shared=False):
    """All raw offers, stored by day in two batches that share days."""
    offered = offers.raw_offers(spark, sf, shared=shared)
    odd = F.pmod(F.xxhash64("itemId", "date"), F.lit(2)) == 1
    for name, batch in (("one", offered.where(odd)), ("two", offered.where(~odd))):
        raw_offers.land(batch, f"{root}/raw", name)
    return raw_offers.read(spark, f"{root}/raw", offers.RAW_SCHEMA), raw_offers.loads(spark, f"{root}/raw")


def audit_stamp_landed(spark, sf):
    """The stamp by the side table: no offer is read."""
    return audit.audit_stamp(_landed(spark, sf, tables.scratch_dir(spark))[1])


def item_count_check_landed(spark, sf):
    """Counts over offers that are stored by day."""
    landed, _ = _landed(spark, sf, tables.scratch_dir(spark))
    return unify.item_count_check(unify.recent(landed, today(spark, sf), RECENT_DAYS), landed)


def stream_unify_by_day(spark, sf):
    """Each micro-batch reads the folders of its days."""
    root = tables.scratch_dir(spark)
    _landed(spark, sf, root)
    query = stream_unify(
        spark, f"{root}/raw", offers.RAW_SCHEMA, f"{root}/unified", f"{root}/checkpoint", files_per_batch=30, by_day=True
    )
    query.awaitTermination()
    return tables.read(spark, f"{root}/unified").select(*unify.UNIFIED, "_timestamp")


def stream_unified(spark, sf, keys=ITEM, shared=False):
    root = tables.scratch_dir(spark)
    raw = offers.raw_offers(spark, sf, shared=shared)
    raw.repartition(3).write.parquet(f"{root}/raw")
    query = stream_unify(
        spark,
        f"{root}/raw",
        offers.RAW_SCHEMA,
        f"{root}/unified",
        f"{root}/checkpoint",
        keys=keys,
        by=_groups(keys),
        files_per_batch=2,
    )
    query.awaitTermination()
    return tables.read(spark, f"{root}/unified").select(*unify.UNIFIED, "_timestamp")


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "last_valid_change": _valid(),
        "last_valid_change_skip": _valid(null_break="skip"),
        "last_valid_change_skip_oldest": _valid(null_break="skip", orig_break="max"),
        "last_valid_change_v2": _valid(rule="gradual_v2"),
        "ref_prices": _reference(),
        "ref_prices_skip": _reference(null_break="skip", orig_break="max"),
        "ref_prices_v2": _reference(rule="gradual_v2", change_days=None, limit_days=12),
        "ref_prices_v1": _reference(
            rule="last_change",
            change_days=None,
            limit_days=VALID_DAYS,
            common_price_days=None,
            history_days=25,
            points_days=29,
            calendar_days=91,
        ),
        "ref_prices_by_slug": _reference(BY_SLUG, orig_break="max"),
        "ref_prices_by_shop": _reference(BY_SHOP, by=("shop",)),
        "shop_domain": shop_domains,
        "audit_snapshot": _audited("snapshot"),
        "audit_window": _audited("window", SHORT_WINDOW),
        "discount_mismatch": _on_snapshot(audit.discount_mismatch),
        "count_items": _on_snapshot(audit.count_items),
        "count_discounted": _on_snapshot(audit.count_discounted),
        "count_false_discounts": _on_snapshot(audit.count_false_discounts),
        "avg_claimed_discount": _on_snapshot(audit.avg_claimed_discount),
        "avg_real_discount": _on_snapshot(audit.avg_real_discount),
        "false_discounts": _on_snapshot(audit.false_discounts),
        "raised_ref_price": _raised(audit.DEFAULT),
        "raised_ref_price_partner": _raised(audit.DEFAULT, with_partner=True),
        "audit_dashboard": _dashboard(audit.DEFAULT),
        "audit_dashboard_by_slug": _dashboard(audit.BY_SLUG),
        "audit_dashboard_older": _dashboard(audit.OLDER),
        "false_discounts_by_slug": _on_snapshot(audit.false_discounts, audit.BY_SLUG),
        "raised_ref_price_by_slug": _raised(audit.BY_SLUG),
        "false_discounts_older": _on_snapshot(audit.false_discounts, audit.OLDER),
        "audit_snapshot_by_shop": _audited("snapshot", audit.BY_SHOP),
        "false_discounts_by_shop": _on_snapshot(audit.false_discounts, audit.BY_SHOP),
        "raised_ref_price_by_shop": _raised(audit.BY_SHOP),
        "raised_ref_price_partner_by_shop": _raised(audit.BY_SHOP, with_partner=True),
        "audit_dashboard_by_shop": _dashboard(audit.BY_SHOP),
        # Names of an earlier round, when the plain ones left rows out.
        "upsert_whole": upsert,
        "upsert_unpartitioned_whole": upsert_unpartitioned,
        "replace_table_whole": replace_table,
        "stream_unify": stream_unified,
        "stream_unify_by_shop": lambda spark, sf: stream_unified(spark, sf, BY_SHOP, shared=True),
    }
    for query in (
        recent_rows, recent_rows_by_date, unify_prices, unify_prices_daily, unify_prices_keyed,
        unify_prices_by_shop, unify_prices_used_goods, item_count_check, item_count_check_by_shop, merge_feeds, merge_feeds_extra,
        active_items, calendar_days, date_item_grid, price_points, gap_fill, price_trend, common_price,
        price_changes, changes_since_up, last_change_v1, min_price_30d,
        latest_batch, latest_batch_by_shop, complete_prices, complete_prices_window,
        complete_prices_by_slug, suspicious_prices, suspicious_prices_by_slug,
        latest_metadata, latest_metadata_by_slug, latest_metadata_wide,
        second_latest_load, recent_items_semi, dedupe_days, item_date_range, fill_history,
        history_changes, last_attributes, price_history, price_history_by_shop, price_history_by_slug,
        price_history_by_pkey, price_history_plain, price_history_by_slug_whole, price_history_plain_whole,
        publish_metadata, publish_metadata_by_shop, publish_metadata_pkey, publish_history, publish_history_plain,
        audit_stamp, audit_stamp_by_shop, false_discounts_partner, false_discounts_partner_by_shop, count_raised,
        migrate_unified, migrate_reference, migrate_complete,
        create_if_absent, upsert, upsert_unpartitioned, replace_table,
        dashboard_history,
        json_sink_roundtrip, json_sink_metadata, table_inventory, row_count_drift, freshness,
        history_changes_incremental, price_history_incremental, latest_batch_from_loads, latest_batch_by_shop_from_loads,
        suspicious_prices_from_loads, upsert_buckets, audit_stamp_landed, item_count_check_landed, stream_unify_by_day,
    ):
        named[query.__name__] = query
    return {name: _tuned(query) for name, query in sorted(named.items())}


def _tuned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return query(spark, sf_dir)

    return run
