import datetime
import random

from pyspark.sql import functions as F

from pricewatch.operators import history
from pricewatch.plans import queries as registered
from tests.conftest import SF, completed, day, price, unified_row

ONE = datetime.timedelta(1)


def days_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["itemId"], {})[r["d"]] = (r["o"], r["c"])
    return out


def test_changes_only(spark):
    d = [day("2024-01-01") + i * ONE for i in range(6)]
    rows = [unified_row("a", d[0], 100), unified_row("a", d[1], 100), unified_row("a", d[3], 90)]
    later = unified_row("b", d[4], 5)
    days = lambda *r: history.dedupe_days(completed(spark, list(r)))
    alone = days_of(history.history_changes(days(*rows), d[5]))["a"]
    assert alone == {d[0]: (None, price(100)), d[2]: (None, None), d[3]: (None, price(90))}
    with_other = days_of(history.history_changes(days(*rows, later), d[5]))["a"]
    assert with_other == {**alone, d[4]: (None, None)}
    still_fresh = days_of(history.history_changes(days(*rows, later), d[3]))["a"]
    assert still_fresh == alone


def random_complete(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        for n in range(40):
            if rng.random() < rng.choice([0.3, 0.9]):
                claim = rng.choice([None, 30])
                rows.append(unified_row(f"i{i}", day("2024-01-01") + n * ONE, rng.choice([None, 10, 10, 20]), claim))
    return rows, completed(spark, rows)


def test_changes_equal_the_dense_days_that_differ(spark):
    _, frame = random_complete(spark, 3)
    as_of = day("2024-02-20")
    days = history.dedupe_days(frame)
    dense = days_of(history.fill_history(days, as_of))
    kept = days_of(history.history_changes(days, as_of))
    for item, values in dense.items():
        expected, before = {}, "nothing yet"
        for on in sorted(values):
            if values[on] != before:
                expected[on] = values[on]
            before = values[on]
        assert kept[item] == expected


def test_decompressing_gives_back_every_day(spark):
    _, frame = random_complete(spark, 4)
    as_of = day("2024-02-20")
    days = history.dedupe_days(frame)
    dense = days_of(history.fill_history(days, as_of))
    kept = days_of(history.history_changes(days, as_of))
    for item, values in dense.items():
        now = None
        for on in sorted(values):
            now = kept[item].get(on, now)
            assert now == values[on]


def test_filled_range(spark):
    rows, frame = random_complete(spark, 5)
    as_of = day("2024-02-20")
    last = max(r["date"] for r in rows)
    ranges = {r["itemId"]: r for r in history.item_date_range(history.dedupe_days(frame), as_of).collect()}
    for item, values in days_of(history.fill_history(history.dedupe_days(frame), as_of)).items():
        assert min(values) == ranges[item]["min_d"]
        assert max(values) == min(ranges[item]["max_d"], last)
        assert len(values) == (max(values) - min(values)).days + 1


def test_lowest_price_of_a_day_wins(spark):
    rows = [
        unified_row("a", "2024-01-01", 12, 30), unified_row("a", "2024-01-01", 10),
        unified_row("a", "2024-01-01", 10, 25), unified_row("a", "2024-01-01", None, 90),
    ]
    (row,) = history.dedupe_days(completed(spark, rows)).collect()
    assert (row["c"], row["o"]) == (price(10), price(25))


def with_price(row, common=5):
    return {**row, "commonPrice": price(common)}


def test_one_load_gives_no_limit_and_no_history(spark):
    frame = completed(spark, [with_price(unified_row("a", "2024-01-01", 10))])
    assert history.second_latest_load(frame).collect()[0]["load_limit"] is None
    assert history.price_history(frame, day("2024-01-05")).count() == 0


def test_history_of_recent_items_only(spark):
    rows = [
        unified_row("gone", "2024-01-01", 10), unified_row("a", "2024-01-01", 10, slug="old"),
        unified_row("a", "2024-01-03", 11, slug="new"), unified_row("b", "2024-01-04", 7, slug=""),
        unified_row("c", "2024-01-04", 8),
    ]
    frame = completed(spark, [with_price(r) for r in rows[:-1]] + [rows[-1]])
    got = history.price_history(frame, day("2024-01-09")).collect()
    assert [r["itemId"] for r in got] == ["a"]
    assert got[0]["slug"] == "new" and got[0]["shop_id"] == "alfa.cz"
    entries = [(str(e["d"])[-2:], e["c"]) for e in got[0]["json"]]
    assert entries == [("01", price(10)), ("02", None), ("03", price(11)), ("04", None)]


def test_shops_have_their_own_loads(spark):
    rows = [with_price(unified_row("a", f"2024-01-0{i}", 10 + i, shop="x")) for i in (1, 2)]
    rows += [with_price(unified_row("a", f"2024-02-0{i}", 20 + i, shop="y")) for i in (1, 2, 3)]
    got = history.price_history(completed(spark, rows), day("2024-03-01"), ("shop", "itemId"), by=("shop",))
    assert {r["shop"]: len(r["json"]) for r in got.collect()} == {"x": 2, "y": 3}


def test_documents_by_p_key_are_texts(spark):
    rows = [unified_row("a", "2024-01-01", 1240), unified_row("a", "2024-01-03", "99.50", "120")]
    (row,) = history.price_history_by_pkey(completed(spark, rows), day("2024-01-03")).collect()
    assert row["p_key"] == "key-a"
    assert [(e["o"], e["c"]) for e in row["json"]] == [("", "1240"), ("", ""), ("120", "99.50")]


def test_last_attributes_skip_missing_slugs_but_not_missing_prices(spark):
    rows = [
        with_price(unified_row("a", "2024-01-01", 1, slug="s1")),
        {**unified_row("a", "2024-01-02", 1), "slug": None},
    ]
    frame = completed(spark, rows)
    (row,) = history.last_attributes(frame, recent_only=False, need_slug=False).collect()
    assert row["slug"] == "s1" and row["commonPrice"] is None


def test_relabelled_shop_is_one_row_with_the_last_values(spark):
    rows = [unified_row("i", "2024-01-01", 10, shop="alfa_cz", slug="old"), unified_row("i", "2024-01-02", 11, shop="alfa.cz", slug="new")]
    (r,) = history.last_attributes(completed(spark, rows), recent_only=False).collect()
    assert r["slug"] == "new"


def test_whole_histories_keep_every_item_with_a_slug(spark):
    """Ordinary items such as p-11, and items without a recent change, are in the whole forms."""
    found = {r["slug"] for r in registered.queries()["price_history_by_slug_whole"](spark, SF).collect()}
    cut = {r["slug"] for r in registered.queries()["price_history_by_slug"](spark, SF).collect()}
    assert cut < found and {s for s in found if "-11" in s} == found - cut
    items = {r["itemId"] for r in registered.completed(spark, SF).where("slug <> ''").select("itemId").collect()}
    assert {r["itemId"] for r in registered.queries()["price_history_plain_whole"](spark, SF).collect()} == items
