import datetime
import os
import shutil

import pytest
from pyspark.sql import functions as F

from pricewatch.plans import queries as registered
from pricewatch.sources import checks, documents, tables
from tests.conftest import SF, day


def rows(spark, values, columns="k string, v int"):
    return spark.createDataFrame(values, columns)


def content(df):
    return {r["k"]: r["v"] for r in df.collect()}


@pytest.fixture
def path(tmp_path):
    return f"{tmp_path}/table"


def test_upsert_replaces_by_key_and_can_be_replayed(spark, path):
    tables.upsert(rows(spark, [("a", 1), ("b", 2)]), path, ["k"])
    for _ in range(2):
        tables.upsert(rows(spark, [("b", 3), ("c", 4)]), path, ["k"])
        assert content(tables.read(spark, path)) == {"a": 1, "b": 3, "c": 4}


def test_upsert_collapses_new_rows_with_one_key(spark, path):
    tables.upsert(rows(spark, [("a", 5), ("a", 2), ("a", 9)]), path, ["k"], order=[-F.col("v")])
    assert content(tables.read(spark, path)) == {"a": 9}
    tables.upsert(rows(spark, [("a", 5), ("a", 2)]), path, ["k"])
    assert content(tables.read(spark, path)) == {"a": 2}


def test_upsert_stamps_one_load_time(spark, path):
    first, second = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)
    tables.upsert(rows(spark, [("a", 1), ("b", 2)]), path, ["k"], loaded_at=first)
    tables.upsert(rows(spark, [("b", 3)]), path, ["k"], loaded_at=second)
    stamps = {r["k"]: r["_timestamp"] for r in tables.read(spark, path).collect()}
    assert stamps == {"a": first, "b": second}


def test_an_open_reader_keeps_its_version(spark, path):
    tables.upsert(rows(spark, [("a", 1)]), path, ["k"])
    before = tables.read(spark, path)
    tables.upsert(rows(spark, [("a", 2)]), path, ["k"])
    assert content(before) == {"a": 1}
    assert content(tables.read(spark, path)) == {"a": 2}


def test_old_versions_go(spark, path):
    kept = lambda: len([f for f in os.listdir(path) if f.startswith("v-")])
    for v in range(4):
        tables.upsert(rows(spark, [("a", v)]), path, ["k"])
    assert kept() == 2  # readers may still hold the one before
    assert tables.drop_old_versions(spark, path, keep=1) == 1 and kept() == 1
    assert content(tables.read(spark, path)) == {"a": 3}


def files_below(path, partition):
    folder = f"{path}/d={partition}"
    return {f: os.path.getmtime(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet")}


def test_partitioned_upsert_rewrites_touched_partitions_only(spark, path):
    schema = "k string, d date, v int"
    tables.upsert(
        rows(spark, [("a", day("2024-01-01"), 1), ("a", day("2024-01-02"), 2), ("b", day("2024-01-02"), 3)], schema),
        path, ["k", "d"], partition_by="d",
    )
    untouched = files_below(path, "2024-01-01")
    incoming = rows(spark, [("b", day("2024-01-02"), 4), ("c", day("2024-01-03"), 5)], schema)
    for _ in range(2):
        tables.upsert(incoming, path, ["k", "d"], partition_by="d")
        got = {(r["k"], str(r["d"])): r["v"] for r in tables.read(spark, path).collect()}
        assert got == {("a", "2024-01-01"): 1, ("a", "2024-01-02"): 2, ("b", "2024-01-02"): 4, ("c", "2024-01-03"): 5}
    assert files_below(path, "2024-01-01") == untouched


def test_a_swap_cut_short_is_done_again(spark, path):
    schema = "k string, d date, v int"
    tables.upsert(
        rows(spark, [("a", day("2024-01-01"), 1), ("a", day("2024-01-02"), 2)], schema), path, ["k", "d"], partition_by="d"
    )
    merged = [("a", day("2024-01-02"), 2), ("b", day("2024-01-02"), 3)]
    tables.stamp(rows(spark, merged, schema), None).write.parquet(f"{path}/_pending-x")
    shutil.rmtree(f"{path}/d=2024-01-02")  # the old partition is gone, the new one not there yet
    later = rows(spark, [("c", day("2024-01-03"), 4)], schema)
    tables.upsert(later, path, ["k", "d"], partition_by="d")
    got = {(r["k"], str(r["d"])): r["v"] for r in tables.read(spark, path).collect()}
    assert got == {("a", "2024-01-01"): 1, ("a", "2024-01-02"): 2, ("b", "2024-01-02"): 3, ("c", "2024-01-03"): 4}
    assert not os.path.exists(f"{path}/_pending-x")


def test_rows_aside_without_a_success_marker_are_dropped(spark, path):
    schema = "k string, d date, v int"
    load = rows(spark, [("a", day("2024-01-01"), 1)], schema)
    tables.upsert(load, path, ["k", "d"], partition_by="d")
    tables.stamp(rows(spark, [("a", day("2024-01-01"), 7)], schema), None).write.parquet(f"{path}/_pending-x")
    os.remove(f"{path}/_pending-x/_SUCCESS")
    tables.upsert(rows(spark, [("b", day("2024-01-01"), 2)], schema), path, ["k", "d"], partition_by="d")
    assert content(tables.read(spark, path)) == {"a": 1, "b": 2}


def test_partitioned_upsert_of_some_days(spark, path):
    schema = "k string, d date, v int"
    for v in (1, 2):
        new = [("a", day("2024-01-01"), v), ("a", day("2024-01-02"), v), ("b", day("2024-01-03"), v)]
        tables.upsert(rows(spark, new[: 4 - v], schema), path, ["k", "d"], partition_by="d")
    got = {(r["k"], str(r["d"])): r["v"] for r in tables.read(spark, path).collect()}
    assert got == {("a", "2024-01-01"): 2, ("a", "2024-01-02"): 2, ("b", "2024-01-03"): 1}


def test_partition_column_must_be_in_the_key(spark, path):
    with pytest.raises(ValueError):
        tables.upsert(rows(spark, [("a", 1)]), path, ["k"], partition_by="v")


def test_empty_partitioned_upsert_changes_nothing(spark, path):
    schema = "k string, d date, v int"
    empty = rows(spark, [], schema)
    tables.upsert(empty, path, ["k", "d"], partition_by="d")
    assert not tables.table_exists(spark, path)
    tables.upsert(rows(spark, [("a", day("2024-01-01"), 1)], schema), path, ["k", "d"], partition_by="d")
    tables.upsert(empty, path, ["k", "d"], partition_by="d")
    assert content(tables.read(spark, path)) == {"a": 1}


def test_replace_and_alias(spark, path):
    tables.replace(rows(spark, [("a", 1)]), path)
    tables.replace(rows(spark, [("b", 2), ("b", 3)]), path, keys=["k"])
    assert content(tables.read(spark, path, alias="stored_rows")) == {"b": 2}
    assert spark.sql("select sum(v) from stored_rows").first()[0] == 2


def test_create_from_template_only_once(spark, tmp_path):
    template = f"{tmp_path}/t.csv"
    with open(template, "w") as f:
        f.write("shop,itemId\nx,1\n")
    assert tables.create_if_absent(spark, f"{tmp_path}/raw", template)
    with open(template, "w") as f:
        f.write("shop,itemId\ny,2\n")
    assert not tables.create_if_absent(spark, f"{tmp_path}/raw", template)
    assert [r["shop"] for r in tables.read(spark, f"{tmp_path}/raw").collect()] == ["x"]


def test_snapshot_and_history(spark, tmp_path):
    current, past = f"{tmp_path}/c", f"{tmp_path}/h"
    for value, stamp in ((1, "d1"), (2, "d2"), (3, "d2")):
        tables.snapshot_and_history(rows(spark, [(stamp, value)]), current, past, ["k"])
    assert content(tables.read(spark, current)) == {"d2": 3}
    assert content(tables.read(spark, past)) == {"d1": 1, "d2": 3}


def test_documents(spark, tmp_path):
    meta = spark.createDataFrame(
        [("a.cz", "s1", "i1", None), ("a.cz", "s2", "i2", "n2"), ("b.sk", "s1", "i3", "n3")],
        "shop_id string, slug string, itemId string, itemName string",
    )
    documents.write_documents(meta, f"{tmp_path}/lines", "metadata")
    got = {(r["shop_id"], r["slug"]): r["document"] for r in documents.read_documents(spark, f"{tmp_path}/lines", "metadata").collect()}
    assert got[("a.cz", "s1")] == '{"itemId":"i1","itemName":null}' and len(got) == 3
    documents.write_documents(meta, f"{tmp_path}/files", "metadata", one_file_each=True)
    folder = f"{tmp_path}/files/items/metadata/shop_id=b.sk/slug=s1"
    (name,) = [f for f in os.listdir(folder) if f.endswith(".txt")]
    with open(f"{folder}/{name}") as f:
        assert f.read() == '{"itemId":"i3","itemName":"n3"}\n'
    with pytest.raises(ValueError):
        documents.write_documents(meta, f"{tmp_path}/x", "other")


def inventory(spark, values):
    schema = "name string, displayName string, rowsCount bigint, bucket string, id string, lastChange date"
    return spark.createDataFrame([(n, n, c, "out", f"out.{n}", day(d)) for n, c, d in values], schema)


def test_row_count_drift(spark):
    today = inventory(spark, [
        ("shrunk", 4500, "2024-01-02"), ("halved", 2000, "2024-01-02"), ("late", 10, "2024-01-01"),
        ("done", 10, "2024-01-02"), ("fresh", 10, "2024-01-02"),
    ])
    before = inventory(spark, [
        ("shrunk", 5000, "2024-01-01"), ("halved", 4000, "2024-01-01"), ("late", 10, "2024-01-01"), ("done", 10, "2024-01-02"),
    ])
    got = {r["tableName"]: r for r in checks.row_count_drift(today, before, day("2024-01-02")).collect()}
    assert (got["shrunk"]["diff"], got["shrunk"]["flagged"]) == (500, True)
    assert (got["halved"]["diff"], got["halved"]["flagged"]) == (2000, False)
    assert {n: r["state"] for n, r in got.items()} == {
        "shrunk": "changed", "halved": "changed", "late": "missing_today", "done": "already_checked", "fresh": "no_previous",
    }
    assert got["late"]["diff"] is None and not got["done"]["flagged"]


def test_inventory_and_freshness(spark):
    df = spark.sql("select timestamp_ntz'2024-01-02 23:00:00' as _timestamp, 1 as x")
    tables_now = {"t": df, "none": df.limit(0)}
    got = {r["name"]: (r["rowsCount"], r["lastChange"]) for r in checks.table_inventory(tables_now).collect()}
    assert got == {"t": (1, day("2024-01-02")), "none": (0, None)}
    fresh = {r["name"]: r["is_fresh"] for r in checks.freshness(tables_now, day("2024-01-02")).collect()}
    assert fresh == {"t": True, "none": False}


@pytest.mark.parametrize("partition_by", [None, "d"])
def test_null_keys_are_replaced_and_kept(spark, path, partition_by):
    schema = "k string, d date, v int"
    load = [("a", None, 1), (None, None, 2), (None, day("2024-01-01"), 3), ("b", day("2024-01-02"), 4)]
    for new in (load, load, [(None, None, 7)], [(None, None, 7)]):
        tables.upsert(rows(spark, new, schema), path, ["k", "d"], partition_by=partition_by)
    got = sorted(((r["k"], r["d"] and str(r["d"]), r["v"]) for r in tables.read(spark, path).collect()), key=str)
    assert got == sorted([("a", None, 1), (None, None, 7), (None, "2024-01-01", 3), ("b", "2024-01-02", 4)], key=str)
    assert not [n for n in os.listdir(path) if n.startswith(("_staging", "_pending"))]


def test_loads_of_the_whole_queries_hold_every_row(spark):
    keys = {(r["itemId"], r["date"]) for r in registered.unified(spark, SF).select("itemId", "date").collect()}
    for name in ("upsert_whole", "upsert_unpartitioned_whole", "replace_table_whole"):
        rows = registered.queries()[name](spark, SF).select("itemId", "date").collect()
        assert len(rows) == len(keys) and {tuple(r) for r in rows} == keys


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_one_changed_item_rewrites_one_bucket(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = [(f"i{n}", n) for n in range(50)] + [(None, -1)]
    frame = lambda r: spark.createDataFrame(r, "k string, v int")
    tables.upsert(frame(rows), path, ["k"], keep_stamp=True, buckets=8)
    before = files(tmp_path / "items")
    tables.upsert(frame([("i7", 70)]), path, ["k"], keep_stamp=True, buckets=99)  # the table's own number holds
    after = files(tmp_path / "items")
    changed = {f.split("/")[0] for f, _ in set(before.items()) ^ set(after.items())}
    assert len({f.split("/")[0] for f in before}) == 8 and len(changed) == 1
    tables.upsert(frame([(None, -2), ("new", 0)]), path, ["k"], keep_stamp=True, buckets=8)
    wanted = {**dict(rows), "i7": 70, None: -2, "new": 0}
    assert sorted(map(tuple, tables.read(spark, path).collect()), key=str) == sorted(wanted.items(), key=str)
    part = tables.read_buckets(spark, path, ["k"], frame([("i7", 0)]))
    assert ("i7", 70) in map(tuple, part.collect()) and part.count() < 52


def test_buckets_from_versions_and_without_rows(spark, tmp_path):
    path = str(tmp_path / "items")
    frame = lambda r: spark.createDataFrame(r, "k string, v int")
    tables.upsert(frame([("a", 1), ("b", 2)]), path, ["k"], keep_stamp=True)
    tables.upsert(frame([("b", 3)]), path, ["k"], keep_stamp=True, buckets=4)
    assert sorted(map(tuple, tables.read(spark, path).collect())) == [("a", 1), ("b", 3)]
    tables.upsert(frame([]), path, ["k"], keep_stamp=True, buckets=4, replaced=frame([("a", 0), ("b", 0)]))
    assert tables.read(spark, path).columns == ["k", "v"] and tables.read(spark, path).count() == 0
    tables.upsert(frame([]), str(tmp_path / "none"), ["k"], keep_stamp=True, buckets=4)
    assert tables.read(spark, str(tmp_path / "none")).count() == 0


def test_loads_say_what_the_table_holds(spark, tmp_path):
    """Late days, overwritten loads, a removed day and a table that had no side table yet."""
    path = str(tmp_path / "t")
    at = lambda n: datetime.datetime(2024, 1, n, 23)
    schema = "shop string, k string, date date, _timestamp timestamp_ntz"

    def held():
        counted = tables.read(spark, path).groupBy("date", "shop", "_timestamp").count()
        return sorted(map(tuple, counted.collect()), key=str)

    def load(rows, **options):
        frame = spark.createDataFrame([(s, k, day(f"2024-01-{d:02d}") if d else None, at(t)) for s, k, d, t in rows], schema)
        tables.upsert(frame, path, ["k", "date"], partition_by="date", keep_stamp=True, **options)
        assert sorted(map(tuple, tables.loads(spark, path).select("date", "shop", "_timestamp", "rows").collect()), key=str) == held()

    load([("x", "a", 1, 1), ("x", "b", 1, 1), ("y", "c", 2, 2)])
    load([("x", "a", 1, 3), ("y", "d", 3, 3), ("y", "e", None, 3)])
    load([("x", "b", 1, 4)])  # the first load is gone from the day
    gone = spark.createDataFrame([("c", day("2024-01-02"))], "k string, date date")
    load([], replaced=gone)
    assert not (tmp_path / "t" / "date=2024-01-02").exists()
    tables._delete(spark, f"{path}/_loads")
    load([("y", "d", 3, 5)])
    newest = tables.newest_loads(tables.loads(spark, path), 2, ["shop"])
    assert sorted((r["shop"], r["_timestamp"].day) for r in newest.select("shop", "_timestamp").distinct().collect()) == [
        ("x", 3), ("x", 4), ("y", 3), ("y", 5),
    ]
