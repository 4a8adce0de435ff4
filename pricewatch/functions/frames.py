"""Frame helpers: table-wide values, one row per group, session values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

def with_table_value(
    df: DataFrame, source: DataFrame, value: Column, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Add an aggregate of the whole `source` as column `name`.

    Without `by` this is a scalar subquery: no join, and filters on the column
    reach the scan as a literal. With `by` (one value per shop) it is a left
    join against one row per group, which AQE broadcasts or shuffles by its size.
    """
    if not by:
        return df.withColumn(name, source.agg(value.alias(name)).scalar())
    per_group = source.groupBy(*by).agg(value.alias(name))
    return df.join(per_group, list(by), "left")


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per group, the smallest by `order` (ascending, NULLs first).

    An aggregate and not a numbered window: each map task sends at most one
    row per group, so a group that holds a third of the table stays cheap.
    """
    payload = list(columns or [c for c in df.columns if c not in keys])
    row = F.min_by(F.struct(*payload), F.struct(*order))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, *[f"_row.{c}" for c in payload])


def newest(name: str) -> Column:
    """Ordering term: latest day first."""
    return -F.unix_date(F.col(name))


def nulls_last(value: Column) -> list[Column]:
    """Ordering terms: ascending with NULLs at the end."""
    return [value.isNull(), value]


def tune(spark) -> None:
    """Runtime settings the plans count on; all can be set on a live session."""
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
    }.items():
        spark.conf.set(key, value)
