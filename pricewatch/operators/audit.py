"""Discount audit: claimed against real discounts of one shop, or of every shop in one pass.

The snapshot holds one row per key, so the pairs that match a mismatch with a
discounted mismatch of the same item are the discounted mismatches themselves,
and no self-join is needed. All counts of the dashboard come from one pass:
first per item, then over all items, so no row is expanded for several
distinct counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.days import LOCAL_ZONE
from ..functions.frames import newest, with_table_value
from ..functions.prices import not_blank, percent_off, rounded_mean, whole_number

ITEM = ("itemId",)

# Label texts of the mismatch types; {name} is the engine's own name.
MISMATCH_TYPES = {
    1: "1 - shop sleva, {name} zdražení",
    2: "2 - shop sleva, {name} bez slevy",
    3: "3 - shop sleva vyšší než sleva {name}",
    4: "4 - shop sleva nižší než sleva {name}",
}


@dataclass(frozen=True)
class AuditSettings:
    """Thresholds in percent, the window in days, and the name that labels the engine's own figures.

    `whole_percents` rounds claimed discounts to whole percents before they are
    averaged, counted as false or tested for "discounted now"; `exclude_type_4`
    leaves type 4 (real discount above the claimed one) out of count and list.
    `by=("shop",)`, with the shop in `keys`, audits all shops of the tables at once,
    each with its own last day, window and stamp; `shop` is then the shop itself.
    """

    discount_threshold: int = 3
    tolerance: int = 3
    window_days: int = 90
    max_false_discounts: int | None = None
    own_name: str = "Reference"
    keys: Sequence[str] = ITEM
    whole_percents: bool = True
    exclude_type_4: bool = True
    by: Sequence[str] = ()

    @property
    def own_price(self) -> str:
        return f"refCena_dle_{self.own_name}"

    @property
    def own_discount(self) -> str:
        return f"sleva_dle_{self.own_name}"

    def label(self, number: int) -> str:
        return MISMATCH_TYPES[number].format(name=self.own_name)

    @property
    def count_key(self) -> str:
        """Column whose distinct values are counted: the slug when it is part of the key."""
        return "slug" if "slug" in self.keys else "itemId"


DEFAULT = AuditSettings()
BY_SLUG = AuditSettings(window_days=30, keys=("itemId", "slug"))
BY_SHOP = AuditSettings(keys=("shop", "itemId"), by=("shop",))
OLDER = AuditSettings(window_days=30, whole_percents=False, exclude_type_4=False)


def audit_stamp(raw: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row: newest scrape minute, and the origin whose offers carry it; with `by` a row per shop with its minute.

    `raw` may be the raw offers or the side table of stored ones (`raw.loads`), which has the newest
    scrape of each load. Several origins in one minute are several shops: that is an error, give `by`.
    """
    scraped = "last_scrape" if "last_scrape" in raw.columns else "date"
    minute = F.left(scraped, F.lit(16))
    if by:
        return raw.where(not_blank(scraped)).groupBy(*by).agg(F.max(minute).alias("aktualizace"))
    latest = raw.agg(F.max(minute)).scalar()
    origin = F.when(not_blank("shopOrigin"), F.col("shopOrigin"))
    several = F.concat(F.lit("several origins in the last minute: "), F.min(origin), F.lit(", "), F.max(origin))
    return (
        raw.where(F.col(scraped) >= latest)
        .where(minute == latest)
        .agg(
            F.when(F.min(origin) < F.max(origin), F.raise_error(several)).otherwise(F.min(origin)).alias("shop"),
            F.max(minute).alias("aktualizace"),
        )
    )


def _audit_rows(complete: DataFrame, raw: DataFrame, settings: AuditSettings) -> DataFrame:
    shop = F.col("shop") if settings.by else audit_stamp(raw).select("shop").scalar()
    claimed = F.coalesce(percent_off(F.col("currentPrice"), F.col("originalPrice")), F.lit(0))
    return complete.select(
        shop.alias("shop"),
        *[c for c in ("itemId", "slug") if c in settings.keys or c == "itemId"],
        "itemName",
        F.col("currentPrice").alias("prodejni_cena"),
        F.col("originalPrice").alias("refCena_dle_shopu"),
        F.col("originalPriceHS").alias(settings.own_price),
        claimed.cast("decimal(18,2)").alias("sleva_dle_shopu"),
        F.col("newSale").alias(settings.own_discount),
        F.col("date").alias("datum"),
        "itemUrl",
    )


def last_day(complete: DataFrame) -> Column:
    return complete.agg(F.max("date")).scalar()


def audit_snapshot(complete: DataFrame, raw: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """Rows of the last day, claimed discount recomputed (0 when there is none)."""
    rows = with_table_value(complete, complete, F.max("date"), "_last", settings.by)
    return _audit_rows(rows.where(F.col("date") == F.col("_last")), raw, settings)


def audit_window(complete: DataFrame, raw: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """The same projection over the last `window_days` days."""
    start = F.date_sub(F.max("date"), settings.window_days)
    rows = with_table_value(complete, complete, start, "_start", settings.by)
    return _audit_rows(rows.where(F.col("date") >= F.col("_start")), raw, settings)


def _whole(name: str) -> Column:
    return whole_number(F.col(name))


def _gap(settings: AuditSettings) -> Column:
    return F.abs(F.col("sleva_dle_shopu") - F.col(settings.own_discount))


def _mismatched(settings: AuditSettings) -> Column:
    return (_gap(settings) >= settings.tolerance) & (_whole("sleva_dle_shopu") != 0)


def _mismatch_type(settings: AuditSettings) -> Column:
    """Type 1 to 4 from whole percents; NULL when none applies."""
    claimed, own = _whole("sleva_dle_shopu"), _whole(settings.own_discount)
    return (
        F.when((claimed > own) & (own < 0), 1)
        .when((claimed > own) & (own == 0), 2)
        .when((claimed > own) & (own > 0), 3)
        .when((claimed < own) & (own > 0), 4)
    )


def _type_label(number: Column, settings: AuditSettings) -> Column:
    label = F.when(number == 1, settings.label(1))
    for n in (2, 3, 4):
        label = label.when(number == n, settings.label(n))
    return label


def discount_mismatch(snapshot: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """Snapshot rows whose claimed and real discount differ by the tolerance or more."""
    return snapshot.where(_mismatched(settings)).select(
        _type_label(_mismatch_type(settings), settings).alias("typ_neshody"), "*"
    )


def _whole_claim_discounted(settings: AuditSettings) -> Column:
    return _whole("sleva_dle_shopu") > settings.discount_threshold


def _claim(settings: AuditSettings) -> Column:
    return _whole("sleva_dle_shopu") if settings.whole_percents else F.col("sleva_dle_shopu")


def _false_discount(settings: AuditSettings) -> Column:
    falsely = _mismatched(settings) & (_claim(settings) > settings.discount_threshold)
    return falsely & (_mismatch_type(settings) != 4) if settings.exclude_type_4 else falsely


def false_discounts(snapshot: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """Discounted mismatches without type 4: all of them.

    A report that asks for a top list sets `max_false_discounts`. Its limit then comes
    before the type filter; the widest gaps are taken, equal gaps by key.
    """
    return _widest_gaps(_discounted_mismatches(snapshot, settings), settings)


def _discounted_mismatches(snapshot: DataFrame, settings: AuditSettings) -> DataFrame:
    return (
        discount_mismatch(snapshot, settings)
        .where(_whole_claim_discounted(settings))
        .withColumn("rozdil_slev", _gap(settings))
    )


def _widest_gaps(rows: DataFrame, settings: AuditSettings, tie_break: Sequence[str] = ()) -> DataFrame:
    if settings.max_false_discounts is not None:
        order = [F.desc("rozdil_slev"), *settings.keys, *tie_break]
        rows = rows.orderBy(*order).limit(settings.max_false_discounts)
    return rows.where(F.col("typ_neshody") != settings.label(4)) if settings.exclude_type_4 else rows


def partner_of_day(partner: DataFrame, days: int, exact: bool, by: Sequence[str] = ()) -> DataFrame:
    """One partner per item and day: (by, itemId, datum, PARTNER), `days` before the feed's last day exactly, or from then on.

    A feed may name several partners of an item on a day; the first by name counts, a missing name only if there
    is no other. So no row of an audit is doubled. With `by` each shop's feed has its own items and last day.
    """
    created = F.left("CREATED", F.lit(10))
    first = F.date_sub(F.max(created).cast("date"), days).cast("string")
    rows = with_table_value(partner, partner, first, "_first", by)
    wanted = created == F.col("_first") if exact else created >= F.col("_first")
    item = [*by, F.col("ITEM_ID").alias("itemId"), F.to_date(created).alias("datum")]
    return rows.where(wanted).groupBy(*item).agg(F.min("PARTNER").alias("PARTNER"))


def false_discounts_with_partner(
    snapshot: DataFrame, partner: DataFrame, settings: AuditSettings = DEFAULT
) -> DataFrame:
    """`false_discounts` with the partner who sold the item on the feed's last full day."""
    sold = partner_of_day(partner, 1, exact=True, by=settings.by).withColumnRenamed("PARTNER", "partnersky_prodej")
    rows = _discounted_mismatches(snapshot, settings).join(sold, [*settings.by, "itemId", "datum"], "left")
    return _widest_gaps(rows, settings, ["partnersky_prodej"])


def raised_reference_price(
    window: DataFrame,
    snapshot_day: Column | None = None,
    settings: AuditSettings = DEFAULT,
    partner: DataFrame | None = None,
) -> DataFrame:
    """Items now on discount whose claimed price was last changed upwards, by more than 3 %.

    `snapshot_day` is the last day of the data; the snapshot is the part of the
    window on that day, so whether an item is discounted now is a flag within
    its own rows. Left out, or with `by`, it is the last day of the window itself.
    The newest change is picked before the other tests.
    """
    keys = list(settings.keys)
    if settings.by or snapshot_day is None:
        window = with_table_value(window, window, F.max("datum"), "_last", settings.by)
        snapshot_day = F.col("_last")
    series = Window.partitionBy(*keys).orderBy("datum")
    discounted = (F.col("datum") == snapshot_day) & (_claim(settings) >= settings.tolerance)
    # A previous claim exists or the row does not count, so skipping missing
    # claims makes no difference to the direction.
    changes = (
        window.withColumn("refCena_puvodni", F.lag("refCena_dle_shopu").over(series))
        .withColumn("now_discounted", F.max(discounted).over(Window.partitionBy(*keys)))
        .where(F.col("now_discounted") & (F.col("refCena_dle_shopu") != F.col("refCena_puvodni")))
    )
    columns = ["shop", "itemName", "prodejni_cena", "refCena_dle_shopu", "refCena_puvodni", "datum"]
    columns += [settings.own_price, "sleva_dle_shopu", settings.own_discount, "itemUrl"]
    last_change = F.max_by(F.struct(*[c for c in columns if c not in keys]), F.col("datum"))
    now, before = F.col("refCena_dle_shopu"), F.col("refCena_puvodni")
    growth = now.cast("double") / F.nullif(before.cast("double"), F.lit(0.0)) * 100 - 100
    found = (
        changes.groupBy(*keys)
        .agg(last_change.alias("change"))
        .select(*keys, "change.*")
        .where((now > before) & (growth > 3) & (_gap(settings) >= settings.tolerance))
    )
    partner_columns = []
    if partner is not None:
        sold = partner_of_day(partner, 30, exact=False, by=settings.by)
        found = found.join(sold, [*settings.by, "itemId", "datum"], "left")
        partner_columns = ["PARTNER"]
    return found.select(
        "shop",
        *[k for k in keys if k != "shop"],
        "itemName",
        "prodejni_cena",
        now.alias("refCena_aktualni"),
        before.alias("refCena_puvodni"),
        F.col("datum").alias("datum_zmeny_refCeny"),
        settings.own_price,
        "sleva_dle_shopu",
        settings.own_discount,
        "itemUrl",
        (now - before).cast("decimal(18,2)").alias("rozdil_refCen"),
        *partner_columns,
    )


def snapshot_counts(snapshot: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """One row with the item counts and mean discounts of the snapshot."""
    discounted = F.col("sleva_dle_shopu") > settings.discount_threshold
    claimed = F.when(discounted, _claim(settings))
    real = F.when(_whole_claim_discounted(settings), F.col(settings.own_discount))
    key = settings.count_key
    # Numbers and flags per item first: sums stay exact decimals, and the
    # distinct counts become plain sums.
    per_item = snapshot.groupBy("shop", key).agg(
        F.max(discounted).alias("discounted"),
        F.max(_false_discount(settings)).alias("false"),
        F.sum(claimed).alias("claimed_sum"),
        F.count(claimed).alias("claimed_n"),
        F.sum(real).alias("real_sum"),
        F.count(real).alias("real_n"),
    )
    return per_item.groupBy("shop").agg(
        F.count(key).alias("Produktu_celkem"),
        F.count(F.when(F.col("discounted"), F.col(key))).alias("Produktu_ve_sleve"),
        F.nullif(F.count(F.when(F.col("false"), F.col(key))), F.lit(0)).alias("Produktu_s_chybnou_slevou"),
        rounded_mean(F.sum("claimed_sum"), F.sum("claimed_n")).alias("Prumerna_uvadena_sleva"),
        rounded_mean(F.sum("real_sum"), F.sum("real_n")).alias("Prumerna_realna_sleva"),
    )


def count_items(snapshot: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """Distinct items of the snapshot, with its shop and day."""
    return snapshot.groupBy("shop", F.col("datum").alias("aktualizace")).agg(
        F.count_distinct(settings.count_key).alias("Produktu_celkem")
    )


def count_discounted(snapshot: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """Distinct items with a claimed discount above the threshold; 0 when there is none."""
    return snapshot.where(F.col("sleva_dle_shopu") > settings.discount_threshold).agg(
        F.count_distinct(settings.count_key).alias("Produktu_ve_sleve")
    )


def count_false_discounts(snapshot: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """Distinct discounted items with a mismatch other than type 4; NULL when there is none."""
    rows = snapshot.where(_false_discount(settings))
    n = F.count_distinct(settings.count_key)
    return rows.agg(F.nullif(n, F.lit(0)).alias("Neshoda_ve_sleve"))


def avg_claimed_discount(snapshot: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """Mean claimed discount of the discounted rows, in whole percents unless set otherwise."""
    claim = _claim(settings)
    rows = snapshot.where(F.col("sleva_dle_shopu") > settings.discount_threshold)
    return rows.agg(rounded_mean(F.sum(claim), F.count(claim)).alias("Prumerna_uvadena_sleva"))


def avg_real_discount(snapshot: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """Mean real discount of the rows whose whole claimed percent is above the threshold."""
    own = F.col(settings.own_discount)
    rows = snapshot.where(_whole_claim_discounted(settings))
    return rows.agg(rounded_mean(F.sum(own), F.count(own)).alias("Prumerna_realna_sleva"))


def count_raised(raised: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """Distinct items with a raised claimed price; 0 when there is none (with `by`, such a shop has no row)."""
    return raised.groupBy(*settings.by).agg(F.count_distinct(settings.count_key).alias("Produktu_s_navysenou_refCenou"))


def audit_dashboard(complete: DataFrame, raw: DataFrame, settings: AuditSettings = DEFAULT) -> DataFrame:
    """The dashboard row of the last day, with `by` one per shop; figures about discounts are NULL when nothing is discounted."""
    counts = snapshot_counts(audit_snapshot(complete, raw, settings), settings)
    window = audit_window(complete, raw, settings)
    if settings.by:
        raised_n = count_raised(raised_reference_price(window, settings=settings), settings)
        stamps = audit_stamp(raw, settings.by)
        counts = counts.join(raised_n, list(settings.by), "left").join(stamps, list(settings.by), "left")
        n_raised, stamp = F.coalesce("Produktu_s_navysenou_refCenou", F.lit(0)), F.col("aktualizace")
    else:
        n_raised = count_raised(raised_reference_price(window, last_day(complete), settings), settings).scalar()
        stamp = audit_stamp(raw).select("aktualizace").scalar()
    local = F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), F.to_timestamp_ntz(stamp, F.lit("yyyy-MM-dd HH:mm")))
    any_discount = F.col("Produktu_ve_sleve") != 0
    return counts.select(
        F.col("shop").alias("Shop"),
        "Produktu_celkem",
        "Produktu_ve_sleve",
        *[
            F.when(any_discount, value).alias(name)
            for name, value in {
                "Produktu_s_chybnou_slevou": F.col("Produktu_s_chybnou_slevou"),
                "Produktu_s_navysenou_refCenou": n_raised,
                "Prumerna_uvadena_sleva": F.col("Prumerna_uvadena_sleva"),
                "Prumerna_realna_sleva": F.col("Prumerna_realna_sleva"),
            }.items()
        ],
        local.alias("Aktualizace"),
    )
