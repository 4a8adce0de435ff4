"""The daily run: eight stages, one after the other, each over stored tables.

A stage reads what the stages before it have stored and stores its own result,
by key where the table is incremental. So each plan starts at a scan, a failed
run can start again at any stage, and nothing is computed twice. The newest loads and
their days come from the side tables, so a run reads the days it touches
and not the years before.

Tables below `root`:

    raw                 offers as they came  by day and batch, if they are landed here
    unified             (item, date)         partitioned by date
    item_count_check    (shopOrigin, date)   partitioned by date; with the shop where a table holds several
    reference_prices    (item, date)         partitioned by date
    complete            (item, date)         partitioned by date
    suspicious_prices   (item, date, shop)   partitioned by date
    metadata            (item)               in buckets
    price_history       (item)               in buckets
    history             changes by day, items in buckets: what price_history is made of
    published_metadata, published_pricehistory     replaced, one row per (shop_id, slug)
    dashboard, false_discounts, raised_prices      replaced, each with a _history table
    inventory, row_count_drift                     replaced: this check's counts, and what they are against the last one's

"item" is `keys`: itemId, with the slug or the shop in front where a table
holds several of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from ..functions.days import local_today
from ..functions.frames import tune
from ..functions.prices import not_blank
from ..operators import audit, complete, metadata, publish, refprice, unify
from ..operators.history_store import HistoryStore, stored_price_history
from ..sources import checks, documents, raw as raw_offers, tables
from ..sources.offers import RAW_SCHEMA

#: Tables the checks count: those by day have a side table of loads.
BY_DAY = ("unified", "item_count_check", "reference_prices", "complete", "suspicious_prices")
WHOLE = ("metadata", "price_history", "published_metadata", "published_pricehistory", "dashboard", "false_discounts", "raised_prices")


@dataclass(frozen=True)
class Settings:
    """Parameters of the stages.

    `by=("shop",)` says that the tables hold several shops (`keys` then starts with
    the shop): each has its own calendar, loads and dashboard row.
    """

    days_back: int = 2
    discount_valid_days: int = 90
    common_price_days: int = 90
    min_scope: str = "day"
    keys: Sequence[str] = ("itemId",)
    by: Sequence[str] = ()
    extra: Sequence[str] = ()
    buckets: int = 64
    audit: audit.AuditSettings = field(default_factory=audit.AuditSettings)


class Pipeline:
    """Stages over tables below `root`, as of one day."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        settings: Settings = Settings(),
        as_of: date | None = None,
        loaded_at: datetime | None = None,
    ) -> None:
        if not set(settings.by) <= set(settings.keys):
            raise ValueError("keys must hold the columns of by")
        tune(spark)
        self.spark = spark
        self.root = root.rstrip("/")
        self.settings = settings
        self.as_of = as_of or local_today()
        self.loaded_at = loaded_at or datetime.now()
        self.keys = list(settings.keys)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return tables.read(self.spark, self.path(name))

    def loads(self, name: str) -> DataFrame:
        return tables.loads(self.spark, self.path(name))

    def _upsert(self, df: DataFrame, name: str, keys: Sequence[str], partition_by: str | None = None) -> None:
        """By partition, or, for a table of items, in buckets."""
        buckets = None if partition_by else self.settings.buckets
        tables.upsert(df, self.path(name), keys, partition_by=partition_by, loaded_at=self.loaded_at, buckets=buckets)

    def land(self, offers: DataFrame, batch: str) -> None:
        """Store a batch of raw offers by day; `run` without offers takes what is landed."""
        raw_offers.land(offers, self.path("raw"), batch)

    def landed(self, schema: str = RAW_SCHEMA) -> DataFrame:
        return raw_offers.read(self.spark, self.path("raw"), schema)

    def _recent_raw(self, raw: DataFrame) -> DataFrame:
        """Offers of the last days' loads; of stored ones only the days these loads have."""
        if raw_offers.DAY in raw.columns:
            lines = unify.recent(raw_offers.loads(self.spark, self.path("raw")), self.as_of, self.settings.days_back)
            raw = tables.in_set(raw, raw_offers.DAY, lines.select(raw_offers.DAY))
        return unify.recent(raw, self.as_of, self.settings.days_back)

    def unify(self, raw: DataFrame, second: DataFrame | Sequence[DataFrame] | None = None) -> None:
        """Recent offers into the unified table; `second` is another feed of the same items, or several in order."""
        s = self.settings
        recent = self._recent_raw(raw)
        others = [] if second is None else [second] if isinstance(second, DataFrame) else list(second)
        feeds = [recent, *[unify.recent(feed, self.as_of, s.days_back) for feed in others]]
        rows = [self._one_per_day(feed, [c for c in s.extra if c in feed.columns]) for feed in feeds]
        rows = unify.merge_all(rows, self.keys, s.extra) if others else rows[0]
        self._upsert(rows, "unified", [*self.keys, "date"], "date")
        check = unify.item_count_check(recent, self._rows_to_count(raw, recent), s.by)
        self._upsert(check, "item_count_check", [*s.by, "shopOrigin", "date"], "date")

    def _one_per_day(self, offers: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        s = self.settings
        return unify.one_per_day(unify.unify(offers, s.min_scope, s.by, extra), self.keys)

    def _rows_to_count(self, raw: DataFrame, recent: DataFrame) -> DataFrame:
        """Raw rows of the days that have new ones; all of them while an origin has no counts yet."""
        if not tables.table_exists(self.spark, self.path("item_count_check")):
            return raw
        origin = [*self.settings.by, "shopOrigin"]
        counted = self.table("item_count_check").select(*origin).distinct()
        if not recent.where(not_blank("shopOrigin")).select(*origin).distinct().join(counted, origin, "left_anti").isEmpty():
            return raw
        return unify.rows_of_days(raw, recent)

    def reference_prices(self) -> None:
        s = self.settings
        rows = refprice.ref_prices(
            self.table("unified"),
            self.as_of,
            s.discount_valid_days,
            s.common_price_days,
            keys=self.keys,
            by=s.by,
        )
        self._upsert(rows, "reference_prices", [*self.keys, "date"], "date")

    def complete(self) -> None:
        by = self.settings.by
        unified, loads = self.table("unified"), self.loads("unified")
        rows = complete.complete(unified, self.table("reference_prices"), keys=self.keys, by=by, loads=loads)
        self._upsert(rows, "complete", [*self.keys, "date"], "date")
        jumps = complete.suspicious_prices(unified, keys=self.keys, by=by, loads=loads)
        item_day_shop = [*dict.fromkeys([*self.keys, "date", "shop"])]
        self._upsert(jumps, "suspicious_prices", item_day_shop, "date")

    def metadata(self) -> None:
        rows = metadata.latest_metadata(
            self.table("complete"), self.as_of, self.settings.days_back, self.keys
        )
        self._upsert(rows, "metadata", self.keys)

    def price_history(self) -> None:
        """What was loaded since the last time goes into the stored history; items of the last two loads get new documents."""
        store = HistoryStore(self.spark, self.path("history"), self.keys, self.settings.buckets)
        store.take_loads(self.table("complete"), self.loads("complete"))
        rows = stored_price_history(store, self.table("complete"), self.as_of, self.settings.by, self.loads("complete"))
        self._upsert(rows, "price_history", self.keys)

    def publish(self, documents_path: str | None = None) -> None:
        days = self.settings.days_back
        meta = publish.publish_metadata(self.table("metadata"), self.as_of, days, by=self.settings.by)
        prices = publish.publish_history(self.table("price_history"), self.as_of, days)
        for name, rows in (("metadata", meta), ("pricehistory", prices)):
            tables.replace(rows, self.path(f"published_{name}"), self.loaded_at, ["shop_id", "slug"])
            if documents_path:
                stored = self.table(f"published_{name}").drop("_timestamp")
                documents.write_documents(stored, documents_path, name)

    def audit(self, raw: DataFrame, partner: DataFrame | None = None) -> None:
        """Dashboard and lists of the last day, of all shops in one pass; `partner` says who sold an item that day.

        Of the raw offers only the newest scrape and its origin count, which the side table of stored ones has.
        """
        by = tuple(self.settings.by)
        s = replace(self.settings.audit, by=by, keys=tuple(self.keys)) if by else self.settings.audit
        rows = self.table("complete")
        snapshot = audit.audit_snapshot(rows, raw, s)
        raised = audit.raised_reference_price(audit.audit_window(rows, raw, s), audit.last_day(rows), s, partner)
        if partner is None:
            falsely = audit.false_discounts(snapshot, s)
        else:
            falsely = audit.false_discounts_with_partner(snapshot, partner, s)
        for name, result, keys, partition_by in (
            ("dashboard", audit.audit_dashboard(rows, raw, s), [*["Shop"][: len(by)], "Aktualizace"], None),
            ("false_discounts", falsely, [*s.keys, "datum"], "datum"),
            ("raised_prices", raised, [*s.keys, "datum_zmeny_refCeny"], "datum_zmeny_refCeny"),
        ):
            path = self.path(name)
            tables.snapshot_and_history(
                result, path, f"{path}_history", keys, self.loaded_at, partition_by
            )

    def check(self, min_rows_drop: int = 1000) -> None:
        """Count the stored tables, hold the counts against those of the last check, and keep them for the next.

        Tables by day are counted from their side tables. The last inventory stays until the drift is stored.
        """
        known = [name for name in (*BY_DAY, *WHOLE) if tables.table_exists(self.spark, self.path(name))]
        counted = {name: self.table(name) for name in known}
        now = checks.table_inventory(counted, loads={name: self.loads(name) for name in known if name in BY_DAY})
        before = self.table("inventory") if tables.table_exists(self.spark, self.path("inventory")) else now.limit(0)
        tables.replace(checks.row_count_drift(now, before, self.as_of, min_rows_drop), self.path("row_count_drift"), self.loaded_at)
        tables.replace(now, self.path("inventory"), self.loaded_at)

    def run(
        self,
        raw: DataFrame | None = None,
        documents_path: str | None = None,
        second: DataFrame | Sequence[DataFrame] | None = None,
        partner: DataFrame | None = None,
    ) -> None:
        """All stages in order, over the given offers or those that are landed."""
        stamped = raw
        if raw is None:
            raw, stamped = self.landed(), raw_offers.loads(self.spark, self.path("raw"))
        self.unify(raw, second)
        self.reference_prices()
        self.complete()
        self.metadata()
        self.price_history()
        self.publish(documents_path)
        self.audit(stamped, partner)
        self.check()
