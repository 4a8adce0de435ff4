"""Tables of the older layout to the current one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.prices import PRICE, null_if_not_above, percent_off, try_price
from .unify import UNIFIED


def _repriced(legacy: DataFrame) -> DataFrame:
    """Slug under its new name; a selling price that is not a number is an error."""
    current = F.col("currentPrice").cast(PRICE)
    return (
        legacy.withColumnRenamed("parsedUrl", "slug")
        .withColumn("currentPrice", current)
        .withColumn("originalPrice", null_if_not_above(try_price("originalPrice"), F.col("currentPrice")))
        .withColumn("officialSale", percent_off(F.col("currentPrice"), F.col("originalPrice")))
    )


def migrate_unified(legacy: DataFrame) -> DataFrame:
    return _repriced(legacy).select(*UNIFIED)


def migrate_reference(legacy: DataFrame) -> DataFrame:
    return legacy.select("itemId", "commonPrice", "minPrice", "date")


def migrate_complete(legacy: DataFrame) -> DataFrame:
    return _repriced(legacy).select(*UNIFIED, "commonPrice", "minPrice", "originalPriceHS", "newSale")
