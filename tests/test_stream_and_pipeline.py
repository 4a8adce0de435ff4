import datetime
from dataclasses import replace

from pricewatch.operators import unify
from pricewatch.plans.pipeline import Pipeline, Settings
from pricewatch.sources import documents, tables
from pricewatch.sources.offers import RAW_SCHEMA
from pricewatch.streaming import stream_unify
from tests.conftest import day, price
from tests.test_unify import offer


def run_stream(spark, root):
    query = stream_unify(
        spark, f"{root}/raw", RAW_SCHEMA, f"{root}/unified", f"{root}/checkpoint", files_per_batch=1
    )
    query.awaitTermination()
    return tables.read(spark, f"{root}/unified")


def test_stream_equals_batch_with_late_and_split_rows(spark, tmp_path):
    root = str(tmp_path)
    feed = lambda rows: spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/raw")
    feed([offer("a", "100", "150"), offer("b", "20", date="2024-01-04 10:00:00")])
    feed([offer("a", "90"), offer("c", "")])
    first = run_stream(spark, root)
    assert {(r["itemId"], str(r["date"])): r["currentPrice"] for r in first.collect()} == {
        ("a", "2024-01-05"): price(90), ("b", "2024-01-04"): price(20),
    }
    late = datetime.datetime(2024, 1, 6, 23)
    feed([offer("b", "10", date="2024-01-04 23:00:00", _timestamp=late)])
    run_stream(spark, root)
    run_stream(spark, root)  # nothing new: nothing changes
    columns = [*unify.UNIFIED, "_timestamp"]
    raw = spark.read.schema(RAW_SCHEMA).parquet(f"{root}/raw")
    batch = unify.one_per_day(unify.unify(raw, "day")).select(columns).collect()
    assert sorted(tables.read(spark, f"{root}/unified").select(columns).collect()) == sorted(batch)


def daily_feed(spark, on, shops=("alfa_cz",)):
    """Item a goes on a false discount on the 8th: its price stays while its claim goes up."""
    rows = []
    for n, shop in enumerate(shops):
        for item, level in (("a", 100), ("b", 200)):
            claim = "150" if item == "a" and on >= day("2024-03-08") else ""
            current = level + 7 * n - (50 if item == "b" and on >= day("2024-03-07") else 0)
            rows.append(
                offer(
                    item, str(current), claim, f"{on} 09:00:00", shop=shop, shopOrigin=shop, slug=f"p-{item}",
                    _timestamp=datetime.datetime.combine(on, datetime.time(9, 5)),
                )
            )
    return spark.createDataFrame(rows, RAW_SCHEMA)


def run_days(spark, root, settings, days, shops=("alfa_cz",)):
    raw = None
    for i in range(days):
        on = day("2024-03-01") + datetime.timedelta(i)
        daily_feed(spark, on, shops).write.mode("append").parquet(f"{root}/raw")
        raw = spark.read.schema(RAW_SCHEMA).parquet(f"{root}/raw")
        if i < 5 or (i == 6 and days == 9):
            continue  # the first days arrive together, as when runs were missed
        current = replace(settings, days_back=10 if i == 5 else 2)
        pipe = Pipeline(spark, f"{root}/tables", current, on, datetime.datetime.combine(on, datetime.time(10)))
        pipe.run(raw, f"{root}/published" if i == days - 1 else None)
    return pipe


def test_daily_runs(spark, tmp_path):
    root = str(tmp_path)
    pipe = run_days(spark, root, Settings(discount_valid_days=30, common_price_days=30), 9)
    assert pipe.table("unified").count() == 18
    refs = {
        r["itemId"]: (r["commonPrice"], r["minPrice"])
        for r in pipe.table("reference_prices").where("date = date'2024-03-09'").collect()
    }
    assert refs == {"a": (price(100), None), "b": (price(200), price(200))}
    last = {r["itemId"]: r for r in pipe.table("complete").where("date = date'2024-03-09'").collect()}
    assert last["a"]["newSale"] == price(0) and last["b"]["newSale"] == price(25)
    (board,) = pipe.table("dashboard").collect()
    assert board["Produktu_celkem"] == 2 and board["Produktu_ve_sleve"] == 1
    assert board["Produktu_s_chybnou_slevou"] == 1
    assert pipe.table("dashboard_history").count() == 3
    (false,) = pipe.table("false_discounts").collect()
    assert false["itemId"] == "a" and false["typ_neshody"].startswith("2")
    assert pipe.table("false_discounts_history").count() == 2
    docs = documents.read_documents(spark, f"{root}/published", "pricehistory").collect()
    assert {d["slug"] for d in docs} == {"p-a", "p-b"}
    entries = {r["itemId"]: len(r["json"]) for r in pipe.table("price_history").collect()}
    assert entries == {"a": 2, "b": 2}


def test_several_shops_in_one_table(spark, tmp_path):
    settings = Settings(
        discount_valid_days=30, common_price_days=30, keys=("shop", "itemId"), by=("shop",)
    )
    root = str(tmp_path)
    pipe = run_days(spark, root, settings, 7, ("alfa_cz", "beta_sk"))
    assert pipe.table("reference_prices").where("date = date'2024-03-07'").count() == 4
    got = {(r["shop"], r["itemId"], r["shop_id"]) for r in pipe.table("price_history").collect()}
    assert got == {
        ("alfa_cz", "a", "alfa.cz"), ("alfa_cz", "b", "alfa.cz"), ("beta_sk", "a", "beta.sk"), ("beta_sk", "b", "beta.sk"),
    }
    assert pipe.table("published_metadata").count() == 4
    prices = {(r["shop"], r["itemId"]): r["commonPrice"] for r in pipe.table("reference_prices").collect()}
    assert prices["alfa_cz", "a"] == price(100) and prices["beta_sk", "a"] == price(107)
    checks = pipe.table("item_count_check").collect()
    assert {(r["shop"], r["shopOrigin"], r["count_itemId_with_curPrice"]) for r in checks} == {
        ("alfa_cz", "alfa_cz", 2), ("beta_sk", "beta_sk", 2),
    }
    assert len(checks) == 2 * 7
    assert sorted(r["Shop"] for r in pipe.table("dashboard").collect()) == ["alfa_cz", "beta_sk"]


def test_checks_from_run_to_run(spark, tmp_path):
    """Counts are stored; the next run has the four states, and no day's rows are read to count them."""
    root, schema = str(tmp_path), "itemId string, date date"

    def load(on, name, rows):
        frame = spark.createDataFrame([(i, on) for i in rows], schema)
        at = datetime.datetime.combine(on, datetime.time(9))
        if name == "metadata":
            tables.upsert(frame, f"{root}/{name}", ["itemId"], loaded_at=at, buckets=2)
        else:
            tables.upsert(frame, f"{root}/{name}", ["itemId", "date"], partition_by="date", loaded_at=at)

    def check(on):
        pipe = Pipeline(spark, root, Settings(), as_of=on, loaded_at=datetime.datetime.combine(on, datetime.time(10)))
        pipe.check(min_rows_drop=3)
        return {r["tableName"]: (r["state"], r["yesterday"], r["today"], r["flagged"]) for r in pipe.table("row_count_drift").collect()}

    first, second = day("2024-03-01"), day("2024-03-02")
    load(first, "unified", "abc")
    load(first, "metadata", "abc")
    assert check(first) == {n: ("no_previous", None, None, False) for n in ("unified", "metadata")}
    assert check(first) == {n: ("already_checked", None, None, False) for n in ("unified", "metadata")}
    load(second, "unified", "ab")
    load(second, "complete", "ab")
    assert check(second) == {
        "unified": ("changed", 3, 5, True), "metadata": ("missing_today", None, None, False), "complete": ("no_previous", None, None, False),
    }


def test_landed_offers_are_read_by_day(spark, tmp_path):
    """A run and a stream over offers stored by day: other days' files are spoilt and not looked at."""
    from pricewatch.sources import raw
    from tests.test_history_store import spoil

    path = str(tmp_path / "raw")
    frame = lambda rows: spark.createDataFrame(rows, RAW_SCHEMA)
    raw.land(frame([offer("a", "5", date="2024-01-04 10:00:00"), offer("b", "6"), offer("x", "1", date="")]), path, "one")
    raw.land(frame([offer("b", "4", date="2024-01-05 12:00:00")]), path, "two")
    raw.land(frame([offer("b", "4", date="2024-01-05 12:00:00")]), path, "two")  # landed again
    assert raw.read(spark, path, RAW_SCHEMA).count() == 4
    lines = raw.loads(spark, path)
    assert lines.selectExpr("sum(rows)", "max(last_scrape)").first()[:] == (4, "2024-01-05 12:00:00")
    spoil(tmp_path / "raw" / "day=2024-01-04" / "batch=one")
    batch = frame([offer("b", "4", date="2024-01-05 12:00:00")])
    stored = raw.read(spark, path, RAW_SCHEMA)
    assert unify.rows_of_days(stored, batch).count() == 2
    only = raw.read(spark, path, RAW_SCHEMA, [day("2024-01-05"), day("2023-01-01")])
    assert only.count() == 2 and all("day=2024-01-05" in f for f in only.inputFiles())
    assert raw.read(spark, path, RAW_SCHEMA, []).count() == 0


def test_stream_by_day_with_a_cool_down(spark, tmp_path):
    """New files start a run, at most one in each interval, until the stream is stopped."""
    from pricewatch.sources import raw

    root = str(tmp_path)
    raw.land(spark.createDataFrame([offer("a", "5"), offer("b", "7")], RAW_SCHEMA), f"{root}/raw", "one")
    query = stream_unify(spark, f"{root}/raw", RAW_SCHEMA, f"{root}/unified", f"{root}/checkpoint", by_day=True, cool_down="2 seconds")
    try:
        query.processAllAvailable()
        raw.land(spark.createDataFrame([offer("a", "4")], RAW_SCHEMA), f"{root}/raw", "two")
        query.processAllAvailable()
    finally:
        query.stop()
    assert {r["itemId"]: r["currentPrice"] for r in tables.read(spark, f"{root}/unified").collect()} == {"a": price(4), "b": price(7)}
