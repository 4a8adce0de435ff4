"""Newest descriptive attributes of each item."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.days import days_before, loaded_from
from ..functions.frames import first_per_group, newest
from ..functions.prices import not_blank, text_or_null_word


def latest_metadata(
    complete: DataFrame,
    as_of: date | Column | None,
    days_back: int = 2,
    keys: Sequence[str] = ("itemId",),
    wide: bool = False,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Newest row per key among recent rows; blank texts become 'null'.

    The wide form also takes rows that only have a slug, and adds the
    reference prices as text and a `shop:slug` key. `extra` columns pass
    through from the chosen row.
    """
    if wide:
        usable = not_blank("itemId") | not_blank("slug")
    else:
        usable = not_blank("itemId") & not_blank("slug") & F.col("commonPrice").isNotNull()
    recent = complete.where(loaded_from(days_before(as_of, days_back)) & usable)
    tie_break = ["slug", "itemName", "itemImage", "shop"]
    columns = [c for c in ("shop", "slug", "itemId", "itemName", "itemImage") if c not in keys]
    if wide:
        columns += ["commonPrice", "minPrice"]
        tie_break += ["commonPrice", "minPrice"]
    order = [newest("date"), *[F.col(c) for c in tie_break if c not in keys]]
    rows = first_per_group(recent, keys, order, [*columns, *extra])
    if not wide:
        return rows.select(
            "shop",
            "slug",
            *[text_or_null_word(c).alias(c) for c in ("itemId", "itemName", "itemImage")],
            *extra,
        )
    return rows.select(
        "shop",
        F.col("slug").alias("itemUrl"),
        "slug",
        *[
            text_or_null_word(c).alias(c)
            for c in ("itemId", "itemName", "itemImage", "commonPrice", "minPrice")
        ],
        F.concat_ws(":", "shop", F.coalesce("slug", F.lit("null"))).alias("pkey"),
        *extra,
    )
