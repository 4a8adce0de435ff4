"""Published documents: metadata and price history per (shop, slug)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.days import days_before, loaded_after
from ..functions.prices import not_blank, shop_domain


def publish_metadata(
    metadata: DataFrame,
    as_of: date | Column | None,
    days_back: int = 2,
    by_pkey: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Metadata of every slug that was loaded after the reference day.

    With `by_pkey` the older, wide table is the input: rows match by `pkey`,
    need a reference price, and carry it along. `by` keeps shops apart that use
    the same slugs.
    """
    key = "pkey" if by_pkey else "slug"
    fresh = metadata.where(loaded_after(days_before(as_of, days_back))).select(*by, key).distinct()
    rows = metadata.where(F.col("slug") != "null")
    if by_pkey:
        rows = rows.where(F.col("commonPrice") != "null")
    columns = ["itemId", "itemName", "itemImage", *(["commonPrice", "minPrice"] if by_pkey else [])]
    return rows.join(fresh, [*by, key], "left_semi").select(
        shop_domain().alias("shop_id"),
        F.col("itemUrl" if by_pkey else "slug").alias("slug"),
        *columns,
    )


def publish_history(
    history: DataFrame, as_of: date | Column | None, days_back: int = 2, wrap: bool = True
) -> DataFrame:
    """Recent histories as documents {entries, commonPrice, minPrice}; unwrapped they pass as they are."""
    recent = history.where(loaded_after(days_before(as_of, days_back)) & not_blank("slug"))
    if not wrap:
        return recent.select("shop_id", "slug", "json")
    document = F.struct(F.col("json").alias("entries"), "commonPrice", "minPrice")
    return (
        recent.select("itemId", "slug", "shop_id", "json", "commonPrice", "minPrice")
        .distinct()
        .select("shop_id", "slug", document.alias("json"))
    )


def as_json_text(document: str | Column) -> Column:
    """Document text with missing values written as null."""
    return F.to_json(document, {"ignoreNullFields": "false"})
