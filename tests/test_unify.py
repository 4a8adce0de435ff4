import datetime
from decimal import Decimal

from pricewatch.operators import unify
from pricewatch.sources.offers import RAW_SCHEMA
from tests.conftest import UNIFIED_SCHEMA, day, price


def offer(item="a", current="100", original="", date="2024-01-05 10:00:00", **changes):
    row = {
        "shop": "alfa_cz",
        "shopOrigin": "alfa",
        "itemId": item,
        "itemName": f"Item {item}",
        "itemUrl": "u",
        "slug": f"p-{item}",
        "currentPrice": current,
        "originalPrice": original,
        "img": "i",
        "date": date,
        "inStock": "true",
        "_timestamp": datetime.datetime(2024, 1, 5, 23),
    }
    row.update(changes)
    return row


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_claim_not_above_the_price_is_dropped(spark):
    rows = [offer("a", original="100"), offer("b", original="90"), offer("c", original="120"), offer("d")]
    got = {r["itemId"]: r["originalPrice"] for r in unify.unify(raw(spark, rows)).collect()}
    assert got == {"a": None, "b": None, "c": Decimal("120.00"), "d": None}


def test_blank_price_drops_the_row_and_unreadable_keeps_it(spark):
    rows = [offer("a", ""), offer("b", "abc"), offer("c", " 5 "), offer("d", "12.345"), offer("", "1"), offer("e", date="")]
    got = {r["itemId"]: r["currentPrice"] for r in unify.unify(raw(spark, rows)).collect()}
    assert got == {"b": None, "c": Decimal("5.00"), "d": Decimal("12.35")}


def test_scope_of_the_lowest_price(spark):
    rows = [
        offer("a", "100", "150", "2024-01-05 10:00:00"),
        offer("a", "80", "160", "2024-01-05 18:00:00"),
        offer("a", "90", "170", "2024-01-05 18:00:00"),
    ]
    scrape = unify.unify(raw(spark, rows), "scrape").collect()
    assert sorted(r["currentPrice"] for r in scrape) == [Decimal(80), Decimal(80), Decimal(100)]
    assert {r["originalPrice"] for r in scrape} == {Decimal(170)}
    daily = unify.unify(raw(spark, rows), "day").collect()
    assert {r["currentPrice"] for r in daily} == {Decimal(80)}
    assert unify.one_per_day(unify.unify(raw(spark, rows), "day")).count() == 1


def test_copies_merge_and_keep_the_latest_load(spark):
    later = datetime.datetime(2024, 1, 6, 23)
    rows = [offer(), offer(), offer(_timestamp=later)]
    (row,) = unify.unify(raw(spark, rows)).collect()
    assert row["_timestamp"] == later


def test_recent_by_load_time_and_by_date(spark):
    rows = [offer("a"), offer("b", date="2024-01-02 09:00:00", _timestamp=datetime.datetime(2024, 1, 2, 0, 0))]
    as_of = datetime.date(2024, 1, 5)
    frame = raw(spark, rows)
    assert unify.recent(frame, as_of, 3).count() == 2
    assert unify.recent(frame, as_of, 2).count() == 1
    assert unify.recent(frame, as_of, 3, "date").count() == 2
    assert unify.recent(frame, as_of, 2, "date").count() == 1


def test_counts_repeat_for_each_origin_and_skip_unpriced_rows(spark):
    rows = [
        offer("a", original="150"), offer("a"), offer("b"), offer("c", current=""),
        offer("d", shopOrigin="beta"), offer("e", date="2024-01-04 01:00:00"),
    ]
    frame = raw(spark, rows)
    got = {
        (r["shopOrigin"], str(r["date"])): (r["count_itemId_with_curPrice"], r["count_itemId_with_origPrice"])
        for r in unify.item_count_check(frame, frame).collect()
    }
    one_day, other = (3, 1), (1, 0)
    assert got == {
        ("alfa", "2024-01-05"): one_day, ("beta", "2024-01-05"): one_day,
        ("alfa", "2024-01-04"): other, ("beta", "2024-01-04"): other,
    }


def test_merge_feeds(spark):
    main = unify.unify(raw(spark, [offer("a", "100", "150"), offer("b", "50")]), "day")
    second = unify.unify(raw(spark, [offer("a", "90", "200", itemName="Other"), offer("c", "7")]), "day")
    got = {r["itemId"]: r for r in unify.merge_feeds(main, second).collect()}
    assert set(got) == {"a", "b", "c"}
    assert (got["a"]["currentPrice"], got["a"]["originalPrice"]) == (Decimal(90), Decimal(200))
    assert got["a"]["itemName"] == "Item a"
    assert got["a"]["officialSale"] == Decimal("55.00")


def test_a_hot_item_gives_the_same_result(spark):
    """A third of the offers belong to one item and day, many of them copies."""
    rows = [offer("hot", str(100 + i % 7), str(200 + i % 5), f"2024-01-05 10:00:{i % 50:02d}") for i in range(1000)]
    rows += [offer(f"i{i}", "10", "20") for i in range(2000)]
    got = {r["itemId"]: r for r in unify.one_per_day(unify.unify(raw(spark, rows), "day")).collect()}
    assert len(got) == 2001
    assert (got["hot"]["currentPrice"], got["hot"]["originalPrice"]) == (Decimal(100), Decimal(204))


def test_any_number_of_feeds_with_columns_of_their_own(spark):
    """Lowest price, last claim, first other value; equal to merging one after the other."""
    base = {"shop": "s", "itemName": None, "itemUrl": None, "slug": None, "originalPrice": None, "itemImage": None, "inStock": None}
    feeds = [
        [("a", 5, {"itemName": "first", "own": None}), ("b", 1, {"own": "main"})],
        [("a", 3, {"originalPrice": price(9), "slug": "second"}), ("c", 2, {"itemName": "only"})],
        [("a", 4, {"itemName": "third", "own": "third"}), ("b", None, {"originalPrice": price(8), "own": "late"}), ("c", 7, {"originalPrice": price(6)})],
    ]
    kinds = UNIFIED_SCHEMA.replace(", _timestamp", ", own string, _timestamp")
    frames = []
    for n, feed in enumerate(feeds):
        rows = [
            {**base, "own": None, **more, "itemId": i, "currentPrice": price(c), "date": day("2024-01-05"), "p_key": "k", "officialSale": None,
             "_timestamp": datetime.datetime(2024, 1, 5 + n)}
            for i, c, more in feed
        ]
        frame = spark.createDataFrame(rows, kinds)
        frames.append(frame.drop("own") if n == 1 else frame)
    got = {r["itemId"]: r for r in unify.merge_all(frames, extra=["own"]).collect()}
    assert {i: (r["currentPrice"], r["originalPrice"], r["itemName"], r["slug"], r["own"], r["_timestamp"].day) for i, r in got.items()} == {
        "a": (price(3), price(9), "first", "second", "third", 7),
        "b": (price(1), price(8), None, None, "main", 7),
        "c": (price(2), price(6), "only", None, None, 7),
    }
    plain = [f.drop("own") for f in frames]
    step = unify.merge_feeds(unify.merge_feeds(plain[0], plain[1]), plain[2])
    assert sorted(unify.merge_all(plain).collect(), key=str) == sorted(step.collect(), key=str)
