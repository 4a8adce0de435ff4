"""Plan shapes that must hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from pricewatch.operators import audit, complete, history, metadata, refprice, unify
from pricewatch.plans import queries as registered
from pricewatch.sources import offers, tables
from tests.conftest import SF, day

AS_OF = day("2024-01-30")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def main_plan(df):
    """The plan without its scalar subqueries (one-row aggregates of their own)."""
    lines = plan(df).splitlines()
    out, skip = [], None
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = None
        if "Subquery subquery" in line and line.lstrip(" :+-").startswith("Subquery"):
            skip = depth
            continue
        out.append(line)
    return "\n".join(out)


@pytest.fixture(scope="module")
def stored(spark):
    root = tables.scratch_dir(spark)
    unified = registered.unified(spark, SF)
    full = registered.completed(spark, SF)
    offers.raw_offers(spark, SF).write.parquet(f"{root}/raw")
    return unified, full, spark.read.parquet(f"{root}/raw")


def test_reference_prices_take_one_exchange_and_two_sorts(stored):
    text = main_plan(refprice.ref_prices(stored[0], AS_OF))
    assert text.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"\bSort \[", text)) == 2
    assert "Join" not in text


def test_date_filters_reach_the_scan(stored):
    unified, full, raw = stored
    assert "GreaterThanOrEqual(date," in plan(refprice.price_points(unified, AS_OF, 20))
    assert "GreaterThanOrEqual(_timestamp," in plan(unify.recent(raw, AS_OF, 3))
    assert "GreaterThanOrEqual(date," in plan(unify.recent(raw, AS_OF, 3, "date"))
    assert "EqualTo(_timestamp,ScalarSubquery" in plan(complete.latest_batch(unified))
    assert "GreaterThanOrEqual(_timestamp," in plan(metadata.latest_metadata(full, AS_OF, 3))


def test_scans_read_only_the_columns_in_use(stored):
    unified = stored[0]
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", main_plan(refprice.ref_prices(unified, AS_OF)))
    assert set(re.findall(r"(\w+):", schema)) == {"itemId", "date", "currentPrice", "originalPrice"}


def test_reference_prices_of_other_days_are_not_read(spark, stored):
    path = tables.scratch_dir(spark)
    registered.reference(spark, SF).write.partitionBy("date").parquet(path)
    df = complete.complete(stored[0], spark.read.parquet(path))
    scan = [line for line in plan(df).splitlines() if "PartitionFilters: [isnotnull(date" in line]
    assert scan and all("Subquery" in line for line in scan)
    assert df.where("commonPrice is not null").count() > 0


def test_jump_check_filters_by_date_in_the_scan(stored):
    assert "GreaterThanOrEqual(date,ScalarSubquery" in plan(complete.suspicious_prices(stored[0]))


def test_gap_filling_needs_no_join(stored):
    runs = refprice.price_runs(stored[0], AS_OF)
    days = history.dedupe_days(stored[1])
    for df in (refprice.gap_fill(runs), history.fill_history(days, AS_OF), history.history_changes(days, AS_OF)):
        assert "Join" not in plan(df)


def test_day_series_are_reduced_before_they_meet_a_window(stored):
    text = main_plan(history.history_changes(history.dedupe_days(stored[1]), AS_OF))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert len(exchanges) == 2 and "date" not in exchanges[0] and "date" in exchanges[1]
    assert "partial_min_by" in text


def test_dashboard_counts_do_not_expand_rows(stored):
    _, full, raw = stored
    text = plan(audit.audit_dashboard(full, raw))
    assert "Expand" not in text and "Join" not in text


def test_top_list_is_taken_per_partition_first(stored):
    _, full, raw = stored
    text = plan(audit.false_discounts(audit.audit_snapshot(full, raw), audit.AuditSettings(max_false_discounts=30)))
    assert "TakeOrderedAndProject" in text or "GlobalLimit" in text
    whole = plan(audit.false_discounts(audit.audit_snapshot(full, raw)))
    assert "TakeOrderedAndProject" not in whole and "Limit" not in whole
    assert "Window" not in text


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_no_query_multiplies_tables_or_uses_a_single_window_partition(spark, name):
    if name in ("stream_unify",):
        pytest.skip("runs the stream; its batch part is unify_prices_keyed")
    text = plan(registered.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text and "BatchEvalPython" not in text
    for window in re.findall(r"Window \[.*", text):
        assert not window.rstrip().endswith("], []"), window
