"""The stored history against the full build, over late, corrected and repeated days."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from pricewatch.operators import history
from pricewatch.operators.complete import latest_batch, suspicious_prices
from pricewatch.operators.history_store import HistoryStore, changed_entries, stored_price_history, with_tails
from pricewatch.sources import tables
from tests.conftest import completed, day, price, unified_row

AS_OF = day("2024-02-20")


def series(store, keys=("itemId",), by=()):
    items = store.items()
    last = F.max("last_day").alias("calendar_end")
    end = items.groupBy(*by).agg(last) if by else items.agg(last).scalar()
    return sorted(with_tails(store.changes(), items, AS_OF, end, keys, by).collect(), key=str)


def full(spark, rows, keys=("itemId",), by=()):
    days = history.dedupe_days(completed(spark, rows), keys)
    return sorted(history.history_changes(days, AS_OF, keys, by).select(*keys, "d", "o", "c").collect(), key=str)


def price_row(item, on, c, o=None, **more):
    return unified_row(item, on, c, o, **more)


def test_equal_to_the_full_build_after_every_load(spark, tmp_path):
    pick = random.Random(3)
    store = HistoryStore(spark, str(tmp_path), buckets=4)
    table = {}
    start = day("2024-01-10")
    for load in range(5):
        batch = {}
        for _ in range(pick.choice([1, 6, 25])):
            item = pick.choice(["a", "b", "c", None, f"new-{load}"])
            # Late, corrected, earlier than the first and later than the last day, with gaps and repeats.
            on = start + datetime.timedelta(pick.randint(-3 * load, 4 + 3 * load))
            batch[item, on] = price_row(item, on, pick.choice([None, 1, 2, 2]), pick.choice([None, None, 3]))
        table |= batch
        rows = completed(spark, list(batch.values()))
        store.update(rows)
        expected = full(spark, list(table.values()))
        assert series(store) == expected
        if load == 3:
            store.update(rows)
            assert series(store) == expected


STEPS = [
    ([1], [3]),  # a gap opens
    ([1, 3], [2]),  # and closes
    ([1], [2]),
    ([5, 9], [1]),  # before the first day, far from it
    ([5], [4]),
    ([1, 2, 3, 4], [2, 3]),
    ([1, 8], [3, 12]),  # late and behind the end at once
    ([3, 9], [1, 5, 20]),
]
PRICES = [(1, 1), (1, 2), (None, 1), (1, None), (None, None)]


def test_single_steps(spark):
    """Each step and price pair is an item of its own; what is kept and what is found make the full build."""
    on = lambda n: day("2024-02-01") + datetime.timedelta(n)
    old, new = [], []
    for i, (before, batch) in enumerate(STEPS):
        for j, prices in enumerate(PRICES):
            old += [price_row(f"{i}-{j}", on(n), prices[0]) for n in before]
            new += [price_row(f"{i}-{j}", on(n), prices[1]) for n in batch]
    touched = history.dedupe_days(completed(spark, new))
    stored_days = history.dedupe_days(completed(spark, old)).cache()
    newest = F.max_by(F.struct("o", "c"), "date").alias("p")
    ends = stored_days.groupBy("itemId").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), newest)
    # As of an early day there is no blank day behind the last one; it is not stored.
    early = day("2024-01-01")
    changes = history.history_changes(stored_days, early).cache()
    kept = {(r["itemId"], r["d"]): (r["o"], r["c"]) for r in changes.collect()}
    for r in changed_entries(touched, ends.select("itemId", "first_day", "last_day", "p.*"), changes).collect():
        kept.pop((r["itemId"], r["d"]), None)
        if r["is_change"]:
            kept[r["itemId"], r["d"]] = (r["o"], r["c"])
    table = {(r["itemId"], r["date"]): r for r in [*old, *new]}
    wanted = history.history_changes(history.dedupe_days(completed(spark, list(table.values()))), early).collect()
    assert kept == {(r["itemId"], r["d"]): (r["o"], r["c"]) for r in wanted}


def test_shops_with_the_same_items(spark, tmp_path):
    store = HistoryStore(spark, str(tmp_path), ("shop", "itemId"), buckets=2)
    rows = []
    for n, shop in enumerate(("alfa_cz", "beta.cz")):
        for on in range(1, 6 + n):
            rows.append(price_row("a", f"2024-02-{on:02d}", 10 * n + on // 3, shop=shop))
    for part in (rows[::2], rows[1::2]):
        store.update(completed(spark, part))
    assert series(store, ("shop", "itemId"), ("shop",)) == full(spark, rows, ("shop", "itemId"), ("shop",))


def test_documents_from_the_store(spark, tmp_path):
    """Loads are taken from the price table by their time, and the documents are those of the full build."""
    root = str(tmp_path)
    store = HistoryStore(spark, f"{root}/history", buckets=2)
    rows = []
    for n in range(1, 9):
        for item in "abc":
            if not (item == "c" and n > 4) and not (item == "b" and n == 5):
                rows.append(price_row(item, f"2024-02-{n:02d}", 10 + n // 3, commonPrice=price(12), minPrice=None, originalPriceHS=None, newSale=None))
    for n in range(1, 9):
        load = [r for r in rows if r["date"] == day(f"2024-02-{n:02d}")]
        tables.upsert(completed(spark, load), f"{root}/complete", ["itemId", "date"], partition_by="date", keep_stamp=True)
        if n % 3 != 1:  # two loads are taken at once now and then
            store.take_loads(tables.read(spark, f"{root}/complete"), tables.loads(spark, f"{root}/complete"))
    complete, loads = tables.read(spark, f"{root}/complete"), tables.loads(spark, f"{root}/complete")
    store.take_loads(complete, loads)
    full_build = history.price_history(complete, AS_OF)
    found = stored_price_history(store, complete, AS_OF, loads=loads)
    assert sorted(found.collect()) == sorted(full_build.select(found.columns).collect())
    assert {r["itemId"] for r in found.collect()} == {"a", "b"}


def spoil(folder):
    """Overwrite the pages of Parquet files; their schema can still be read, their rows cannot."""
    for file in folder.glob("*.parquet"):
        raw = file.read_bytes()
        footer = int.from_bytes(raw[-8:-4], "little") + 8
        file.write_bytes(raw[:4] + b"\xff" * (len(raw) - footer - 4) + raw[-footer:])
        crc = file.parent / f".{file.name}.crc"
        if crc.exists():
            crc.unlink()


def test_old_days_are_not_read(spark, tmp_path):
    """A load behind the end reads no stored change and none of the price table's old days: their files are spoilt."""
    root = str(tmp_path)
    store = HistoryStore(spark, f"{root}/history", buckets=2)

    def load(n):
        rows = [price_row(i, f"2024-02-{n:02d}", 10 + n, commonPrice=price(9)) for i in "ab"]
        tables.upsert(completed(spark, rows), f"{root}/complete", ["itemId", "date"], partition_by="date", keep_stamp=True)
        store.take_loads(tables.read(spark, f"{root}/complete"), tables.loads(spark, f"{root}/complete"))

    for n in (1, 2, 3):
        load(n)
    spoil(tmp_path / "complete" / "date=2024-02-01")
    spoil(tmp_path / "complete" / "date=2024-02-02")
    spoil(tmp_path / "history" / "changes" / "d=2024-02-01")
    with pytest.raises(Exception):
        tables.read(spark, f"{root}/complete").collect()
    load(4)
    assert {str(r["d"]) for r in store.changes().where("d > '2024-02-02'").collect()} == {"2024-02-03", "2024-02-04"}
    # The newest loads are found, and read, without the old days as well.
    complete, loads = tables.read(spark, f"{root}/complete"), tables.loads(spark, f"{root}/complete")
    assert latest_batch(complete, loads=loads).count() == 2
    assert history.second_latest_load(loads).first()["load_limit"].day == 3
    assert history.items_changed_since(complete, loads=loads).count() == 2
    assert suspicious_prices(complete, days=1, loads=loads).count() == 0
