from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricewatch.operators import audit
from pricewatch.sources.offers import RAW_SCHEMA
from tests.conftest import completed, day, price, unified_row
from tests.test_unify import offer


def raw(spark):
    rows = [
        offer(date="2024-01-05 10:30:10", shopOrigin="alfa"),
        offer(date="2024-01-05 10:30:59", shopOrigin=""),
        offer(date="2024-01-04 23:00:00", shopOrigin="other"),
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def row(item, on, current, original=None, sale=None, **changes):
    return {
        **unified_row(item, on, current, original, **changes),
        "newSale": None if sale is None else Decimal(str(sale)),
        "originalPriceHS": price(original),
    }


def labels(spark, pairs):
    df = spark.createDataFrame(
        [(f"i{n}", Decimal(a), Decimal(b)) for n, (a, b) in enumerate(pairs)],
        "itemId string, sleva_dle_shopu decimal(18,2), sleva_dle_Reference decimal(18,2)",
    )
    got = audit.discount_mismatch(df).collect()
    return {r["itemId"]: r["typ_neshody"] and r["typ_neshody"][0] for r in got}


def test_mismatch_types(spark):
    pairs = [("20", "-5"), ("20", "0.4"), ("20", "10"), ("10", "20"), ("-10", "-2")]
    assert labels(spark, pairs) == {"i0": "1", "i1": "2", "i2": "3", "i3": "4", "i4": None}


def test_mismatch_needs_the_tolerance_and_a_whole_percent(spark):
    assert labels(spark, [("20", "17.01"), ("20", "17"), ("0.4", "50"), ("0.5", "50")]) == {"i1": "3", "i3": "4"}


def test_stamp_takes_the_newest_minute_and_its_named_origin(spark):
    (stamp,) = audit.audit_stamp(raw(spark)).collect()
    assert (stamp["shop"], stamp["aktualizace"]) == ("alfa", "2024-01-05 10:30")


def history_rows():
    return [
        # raised 100 -> 150, discounted now, real discount far off
        row("up", "2024-01-01", 90, 100), row("up", "2024-01-03", 90, 150, sale=10), row("up", "2024-01-05", 90, 150, sale=10),
        # last change was downwards
        row("down", "2024-01-01", 90, 100), row("down", "2024-01-03", 90, 150, sale=10), row("down", "2024-01-05", 90, 140, sale=10),
        # raised, but not on discount now
        row("off", "2024-01-03", 90, 100), row("off", "2024-01-04", 90, 150, sale=10), row("off", "2024-01-05", 90),
        # claim appears after a day without one: no previous claim to compare
        row("new", "2024-01-04", 90), row("new", "2024-01-05", 90, 150, sale=40),
        row("true", "2024-01-05", 60, 100, sale=40),
        row("type4", "2024-01-05", 90, 100, sale=40),
    ]


def test_raised_reference_price(spark):
    window = audit.audit_window(completed(spark, history_rows()), raw(spark))
    (r,) = audit.raised_reference_price(window, F.lit(day("2024-01-05"))).collect()
    assert (r["itemId"], r["refCena_puvodni"], r["refCena_aktualni"]) == ("up", price(100), price(150))
    assert str(r["datum_zmeny_refCeny"]) == "2024-01-03" and r["rozdil_refCen"] == price(50)


def test_dashboard(spark):
    (r,) = audit.audit_dashboard(completed(spark, history_rows()), raw(spark)).collect()
    assert r["Shop"] == "alfa" and r["Produktu_celkem"] == 6 and r["Produktu_ve_sleve"] == 5
    assert r["Produktu_s_chybnou_slevou"] == 2  # up and down; type 4 does not count, new and true agree
    assert r["Produktu_s_navysenou_refCenou"] == 1
    assert str(r["Aktualizace"]) == "2024-01-05 11:30:00"
    assert r["Prumerna_uvadena_sleva"] == Decimal("33.20")
    assert r["Prumerna_realna_sleva"] == Decimal("28.00")


def test_single_counts_agree_with_the_dashboard(spark):
    frame, feed = completed(spark, history_rows()), raw(spark)
    for settings in (audit.DEFAULT, audit.OLDER, audit.BY_SLUG):
        snapshot = audit.audit_snapshot(frame, feed, settings)
        (counts,) = audit.snapshot_counts(snapshot, settings).collect()
        assert audit.count_items(snapshot, settings).first()["Produktu_celkem"] == counts["Produktu_celkem"]
        for operator, column in (
            (audit.count_discounted, "Produktu_ve_sleve"),
            (audit.count_false_discounts, "Produktu_s_chybnou_slevou"),
            (audit.avg_claimed_discount, "Prumerna_uvadena_sleva"),
            (audit.avg_real_discount, "Prumerna_realna_sleva"),
        ):
            assert operator(snapshot, settings).first()[0] == counts[column], (settings, column)


def test_nothing_discounted_leaves_figures_empty(spark):
    (r,) = audit.audit_dashboard(completed(spark, [row("a", "2024-01-05", 10)]), raw(spark)).collect()
    assert r["Produktu_celkem"] == 1 and r["Produktu_ve_sleve"] == 0
    assert r["Produktu_s_chybnou_slevou"] is None and r["Produktu_s_navysenou_refCenou"] is None
    assert r["Prumerna_uvadena_sleva"] is None


def test_limit_of_the_list_comes_before_the_type_filter(spark):
    rows = [row("a", "2024-01-05", 90, 100, sale=80), row("b", "2024-01-05", 50, 100, sale=10)]
    snapshot = audit.audit_snapshot(completed(spark, rows), raw(spark))
    ids = lambda n: [r["itemId"] for r in audit.false_discounts(snapshot, audit.AuditSettings(max_false_discounts=n)).collect()]
    assert ids(1) == []  # the widest gap is a type 4
    assert ids(2) == ["b"]


def test_own_name_labels_columns_and_types(spark):
    settings = audit.AuditSettings(own_name="Tracker")
    rows = [row("b", "2024-01-05", 50, 100, sale=10)]
    (r,) = audit.discount_mismatch(audit.audit_snapshot(completed(spark, rows), raw(spark), settings), settings).collect()
    assert r["sleva_dle_Tracker"] == price(10) and r["typ_neshody"].endswith("sleva Tracker")


def test_one_partner_per_shop_item_and_day(spark):
    rows = [
        ("x", "a", "2024-03-09 10:00", "zeta"), ("x", "a", "2024-03-09 11:00", "beta"), ("x", "a", "2024-03-09", None),
        ("x", "b", "2024-03-09", None), ("x", "a", "2024-03-10", "late"), ("y", "a", "2024-03-08", "other"), ("y", "c", "2024-03-07", "old"),
    ]
    feed = spark.createDataFrame(rows, "shop string, ITEM_ID string, CREATED string, PARTNER string")
    found = lambda **options: sorted(map(tuple, audit.partner_of_day(feed, 1, **options).collect()), key=str)
    assert found(exact=True, by=("shop",)) == [("x", "a", day("2024-03-09"), "beta"), ("x", "b", day("2024-03-09"), None), ("y", "c", day("2024-03-07"), "old")]
    assert found(exact=True) == [("a", day("2024-03-09"), "beta"), ("b", day("2024-03-09"), None)]
    assert len(found(exact=False, by=("shop",))) == 5


def test_several_origins_in_the_last_minute_are_refused(spark):
    rows = [("x", "one", "2024-03-09 10:00:01"), ("y", "two", "2024-03-09 10:00:59"), ("x", "one", "2024-03-08 10:00:00"), ("z", "", "2024-03-09 10:00:30")]
    raw = spark.createDataFrame(rows, "shop string, shopOrigin string, date string")
    with pytest.raises(Exception, match="several origins in the last minute: one, two"):
        audit.audit_stamp(raw).collect()
    assert audit.audit_stamp(raw.where("shop != 'y'")).first()["shop"] == "one"
    assert audit.audit_stamp(raw, by=("shop",)).count() == 3
