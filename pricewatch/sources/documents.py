"""Document sink: one JSON document per (shop_id, slug)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.publish import as_json_text

FORMATS = ("metadata", "pricehistory")


def _document(df: DataFrame, kind: str) -> Column:
    if kind not in FORMATS:
        raise ValueError(f"unknown document format {kind!r}")
    if kind == "pricehistory":
        return F.col("json") if dict(df.dtypes)["json"] == "string" else as_json_text("json")
    return as_json_text(F.struct(*[c for c in df.columns if c not in ("shop_id", "slug")]))


def write_documents(df: DataFrame, path: str, kind: str, one_file_each: bool = False) -> None:
    """Write documents below `path`/items, partitioned by shop.

    A document is one JSON line {slug, document}. `one_file_each` gives every
    document a directory and file of its own, found by (shop_id, slug): for
    small exports only, since each costs a file.
    """
    rows = df.select("shop_id", "slug", _document(df, kind).alias("document"))
    target = f"{path}/items/{kind}"
    if one_file_each:
        # The text writer takes a single column, the document; slug and shop make the path.
        rows.repartition("shop_id", "slug").write.mode("overwrite").partitionBy("shop_id", "slug").text(target)
    else:
        rows.hint("rebalance", "shop_id").write.mode("overwrite").partitionBy("shop_id").json(target)


def read_documents(spark, path: str, kind: str) -> DataFrame:
    """Documents written as lines: shop_id, slug and the document text."""
    return spark.read.schema("slug string, document string, shop_id string").json(f"{path}/items/{kind}")
