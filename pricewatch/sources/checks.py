"""Checks over stored tables: inventory, row-count drift, freshness."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.days import as_day


def table_inventory(tables: Mapping[str, DataFrame], bucket: str = "out", loads: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Name, row count and last change of each table, in one job.

    `loads` has the side tables of those that have one: they are counted from these, without a look at their rows.
    """
    loads = loads or {}
    if not tables:
        raise ValueError("no tables to list")

    def counted(name: str, df: DataFrame) -> DataFrame:
        rows = F.coalesce(F.sum("rows"), F.lit(0)) if name in loads else F.count("*")
        last = F.to_date(F.max("_timestamp")).alias("lastChange")
        return loads.get(name, df).agg(rows.alias("rowsCount"), last)

    rows = [
        counted(name, df).select(
            F.lit(name).alias("name"),
            F.lit(name).alias("displayName"),
            "rowsCount",
            F.lit(bucket).alias("bucket"),
            F.lit(f"{bucket}.{name}").alias("id"),
            "lastChange",
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def row_count_drift(
    today: DataFrame, previous: DataFrame, as_of: date | Column | None, min_rows_drop: int = 1000
) -> DataFrame:
    """Today's inventory against the stored one.

    `diff` is yesterday's count minus today's and is flagged when it is below
    `min_rows_drop`, which also flags growth: the rule is kept as it was.
    """
    before = previous.select(
        "name", "id", F.col("rowsCount").alias("yesterday"), F.col("lastChange").alias("previousChange")
    )
    state = (
        F.when(F.col("yesterday").isNull(), "no_previous")
        .when(~F.col("lastChange").eqNullSafe(as_day(as_of)), "missing_today")
        .when(F.col("lastChange").eqNullSafe(F.col("previousChange")), "already_checked")
        .otherwise("changed")
    )
    changed = F.col("state") == "changed"
    diff = F.col("yesterday") - F.col("rowsCount")
    return (
        today.join(before, ["name", "id"], "left")
        .withColumn("state", state)
        .select(
            F.col("name").alias("tableName"),
            F.col("id").alias("tableId"),
            "state",
            F.when(changed, F.col("yesterday")).alias("yesterday"),
            F.when(changed, F.col("rowsCount")).alias("today"),
            F.when(changed, diff).alias("diff"),
            (changed & (diff < min_rows_drop)).alias("flagged"),
        )
    )


def freshness(tables: Mapping[str, DataFrame], as_of: date | Column | None) -> DataFrame:
    """Whether each table's newest load is from `as_of`."""
    inventory = table_inventory(tables)
    return inventory.select(
        "name", "lastChange", F.coalesce(F.col("lastChange") == as_day(as_of), F.lit(False)).alias("is_fresh")
    )
