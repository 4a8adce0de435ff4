import datetime
from decimal import Decimal

from pricewatch.operators import complete, metadata, migrate, publish
from pricewatch.sources import offers
from tests.conftest import completed, day, price, unified, unified_row


def reference(spark, rows):
    schema = "itemId string, commonPrice decimal(12,2), minPrice decimal(12,2), date date"
    return spark.createDataFrame([(i, price(c), price(m), day(d)) for i, c, m, d in rows], schema)


def test_latest_batch_with_reference_prices(spark):
    rows = [
        unified_row("a", "2024-01-05", 80), unified_row("b", "2024-01-05", 80), unified_row("c", "2024-01-05", 80),
        unified_row("a", "2024-01-04", 70),
    ]
    refs = reference(spark, [("a", 100, 90, "2024-01-05"), ("b", 100, None, "2024-01-05"), ("c", 100, 90, "2024-01-04")])
    got = {r["itemId"]: (r["originalPriceHS"], r["newSale"]) for r in complete.complete(unified(spark, rows), refs).collect()}
    assert got == {"a": (price(90), Decimal("11.11")), "b": (price(100), price(20)), "c": (None, None)}


def test_window_scope_joins_each_day_with_its_own_reference(spark):
    rows = [unified_row("a", f"2024-01-0{i}", 80) for i in (1, 3, 4)]
    refs = reference(spark, [("a", 100, None, "2024-01-03"), ("a", 160, None, "2024-01-04")])
    frame = complete.complete(unified(spark, rows), refs, 2, day("2024-01-05"))
    assert {str(r["date"]): r["newSale"] for r in frame.collect()} == {"2024-01-03": price(20), "2024-01-04": price(50)}


def test_suspicious_prices_count_back_from_the_load_time(spark):
    late = datetime.datetime(2024, 1, 5, 23)
    rows = [
        unified_row("a", "2024-01-03", 1), unified_row("a", "2024-01-04", 900), unified_row("a", "2024-01-05", 5, loaded=late),
        unified_row("b", "2024-01-04", 1), unified_row("b", "2024-01-05", 101), unified_row("c", "2024-01-04", 1),
        unified_row("c", "2024-01-05", 100), unified_row("d", "2024-01-04", 0), unified_row("d", "2024-01-05", 7),
    ]
    got = complete.suspicious_prices(unified(spark, rows)).collect()
    # The 3rd lies before the limit (3 January, 23:00), so a has no jump up.
    assert {r["itemId"]: (r["prev"], float(r["narust"])) for r in got} == {
        "a": (Decimal(900), 5 / 900), "b": (Decimal(1), 101.0),
    }
    midnight = [{**r, "_timestamp": datetime.datetime(2024, 1, 5)} for r in rows]
    items = {r["itemId"] for r in complete.suspicious_prices(unified(spark, midnight)).collect()}
    assert items == {"a", "b"}
    jumps = [r for r in complete.suspicious_prices(unified(spark, midnight)).collect() if r["itemId"] == "a"]
    assert len(jumps) == 2


def test_newest_metadata(spark):
    rows = [
        {**unified_row("a", "2024-01-04", 1, itemName="old"), "commonPrice": price(1)},
        {**unified_row("a", "2024-01-05", 1, itemName=" "), "commonPrice": price(1)},
        {**unified_row("b", "2024-01-05", 1, slug=""), "commonPrice": price(1)},
        unified_row("c", "2024-01-05", 1),
    ]
    frame = completed(spark, rows)
    (row,) = metadata.latest_metadata(frame, day("2024-01-05"), 2).collect()
    assert (row["itemId"], row["itemName"]) == ("a", "null")
    wide = {r["itemId"]: r for r in metadata.latest_metadata(frame, day("2024-01-05"), 2, wide=True).collect()}
    assert set(wide) == {"a", "b", "c"}
    assert (wide["b"]["pkey"], wide["b"]["commonPrice"], wide["c"]["commonPrice"]) == ("alfa_cz:", "1.00", "null")


def test_published_rows_are_those_of_recent_slugs(spark):
    schema = "shop string, slug string, itemId string, itemName string, itemImage string, _timestamp timestamp_ntz"
    at = lambda d: datetime.datetime(2024, 1, d, 0, 0)
    rows = [("alfa_cz", "s", "1", "n", "i", at(5)), ("alfa_cz", "s", "2", "n", "i", at(1)),
            ("alfa_cz", "t", "3", "n", "i", at(3)), ("alfa_cz", "null", "4", "n", "i", at(5))]
    got = publish.publish_metadata(spark.createDataFrame(rows, schema), day("2024-01-05"), 2).collect()
    assert sorted(r["itemId"] for r in got) == ["1", "2"]  # the 3rd is the reference day itself: not after it


def test_documents_keep_nulls_and_merge_copies(spark):
    schema = (
        "itemId string, slug string, shop_id string, json array<struct<d:date,o:decimal(12,2),c:decimal(12,2)>>, "
        "commonPrice decimal(12,2), minPrice decimal(12,2), _timestamp timestamp_ntz"
    )
    row = ("a", "s", "x.cz", [(day("2024-01-01"), None, price(5))], price(5), None, datetime.datetime(2024, 1, 5))
    frame = publish.publish_history(spark.createDataFrame([row, row], schema), day("2024-01-05"), 2)
    (text,) = [r[0] for r in frame.select(publish.as_json_text("json")).collect()]
    assert text == '{"entries":[{"d":"2024-01-01","o":null,"c":5.00}],"commonPrice":5.00,"minPrice":null}'


def test_migration_renames_and_recomputes(spark):
    rows = [unified_row("a", "2024-01-01", 80, 100), unified_row("b", "2024-01-01", 80, 80)]
    old = offers.legacy(unified(spark, rows))
    got = {r["itemId"]: (r["slug"], r["originalPrice"], r["officialSale"]) for r in migrate.migrate_unified(old).collect()}
    assert got == {"a": ("p-a", price(100), price(20)), "b": ("p-b", None, None)}
