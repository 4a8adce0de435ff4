"""Adapters that read the given star-schema tables as scraped offers.

`events` plays the daily scrape, `orders` the partner feed and `lineitem` a
long, dense price series. Spark derives all of it from the tables, so work
grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.frames import first_per_group
from ..operators.unify import UNIFIED

# Shop label by user number modulo five.
SHOPS = ["alfa_cz", "beta.cz", "gama_sk", "delta.sk", "omega"]

RAW_SCHEMA = (
    "shop string, shopOrigin string, itemId string, itemName string, itemUrl string, slug string, "
    "currentPrice string, originalPrice string, img string, date string, inStock string, "
    "_timestamp timestamp_ntz"
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_offers(
    spark: SparkSession, sf_dir: str, price_shift: int = 0, event_type: str | None = None, shared: bool = False
) -> DataFrame:
    """Events as raw offers; every text column keeps '' for a missing value.

    A second feed is the events of one type with another price level. In the
    `shared` form five shops of two origins sell the same item ids and slugs.
    """
    events = read_table(spark, sf_dir, "events")
    if event_type:
        events = events.where(F.col("event_type") == event_type)
    user = F.col("user_id")
    block = F.floor(F.dayofmonth("ts") / 4).cast("int")
    level = 100 + 40 * ((user + 3 * block) % 5) + F.when(F.col("value") < 15, 0).otherwise(20)
    price = (
        F.when((F.col("event_type") == "view") & (F.col("value") < 2), F.lit(1)).otherwise(level) - price_shift
    ).cast("decimal(12,2)")
    claim = (F.col("price") * F.lit("1.25").cast("decimal(4,2)")).cast("decimal(12,2)")
    phase = (user + F.col("block")) % 3
    shop = F.element_at(F.array(*[F.lit(s) for s in SHOPS]), (user % 5 + 1).cast("int"))
    user_text = user.cast("string")
    item = F.floor(user / 5).cast("string") if shared else user_text
    origin = F.concat(F.lit("origin_"), (user % 5 % 2).cast("string")) if shared else F.lit("demo_origin")
    return events.withColumns({"block": block, "price": price}).select(
        shop.alias("shop"),
        origin.alias("shopOrigin"),
        F.when(F.col("event_id") % 211 == 0, "").otherwise(F.concat(F.lit("i"), item)).alias("itemId"),
        F.concat(F.lit("Item "), user_text).alias("itemName"),
        F.concat(F.lit("https://shop.example/p/"), user_text).alias("itemUrl"),
        F.when(user % 37 == 0, "").otherwise(F.concat(F.lit("p-"), item)).alias("slug"),
        F.when(F.col("event_type") == "error", "").otherwise(F.col("price").cast("string")).alias("currentPrice"),
        F.when(phase == 1, claim.cast("string"))
        .when(phase == 2, F.col("price").cast("string"))
        .otherwise("")
        .alias("originalPrice"),
        F.concat(F.lit("https://img.example/"), user_text, F.lit(".jpg")).alias("img"),
        F.left(F.col("ts").cast("string"), F.lit(19)).alias("date"),
        F.lit("true").alias("inStock"),
        (F.date_trunc("day", "ts") + F.expr("interval 23 hours")).cast("timestamp_ntz").alias("_timestamp"),
    )


def second_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another scrape of part of the shops' offers: the click events, five cheaper."""
    return raw_offers(spark, sf_dir, price_shift=5, event_type="click")


def partner_feed(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    """Orders as offers of partners: one row per item and day.

    In the `shared` form the items are those of five shops with the same ids, and an item has as many partners a day as it has orders.
    """
    orders = read_table(spark, sf_dir, "orders")
    created = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 30).cast("int")).cast("string")
    user = F.col("o_custkey") % 200
    if shared:
        shop = F.element_at(F.array(*[F.lit(s) for s in SHOPS]), (user % 5 + 1).cast("int"))
        item = F.concat(F.lit("i"), F.floor(user / 5).cast("string"))
        return orders.select(
            shop.alias("shop"), item.alias("ITEM_ID"), created.alias("CREATED"), F.col("o_orderpriority").alias("PARTNER")
        )
    item = F.concat(F.lit("i"), user.cast("string"))
    return orders.groupBy(item.alias("ITEM_ID"), created.alias("CREATED")).agg(F.min("o_orderpriority").alias("PARTNER"))


def shipped_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as unified rows: one per supplier and ship day, lowest price first.

    Load time is the day itself, late in the evening.
    """
    items = read_table(spark, sf_dir, "lineitem").select(
        F.lit("omega").alias("shop"),
        F.concat(F.lit("i"), F.col("l_suppkey").cast("string")).alias("itemId"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(12,2)").alias("currentPrice"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("originalPrice"),
    )
    days = first_per_group(
        items, ["itemId", "date"], [F.col("currentPrice"), -F.col("originalPrice")], ["shop", "currentPrice", "originalPrice"]
    )
    nothing = F.lit(None).cast("string")
    return days.select(
        "shop",
        F.md5(F.concat("shop", "itemId")).alias("p_key"),
        "itemId",
        F.concat(F.lit("Item "), "itemId").alias("itemName"),
        nothing.alias("itemUrl"),
        F.concat(F.lit("p-"), "itemId").alias("slug"),
        "currentPrice",
        "originalPrice",
        F.lit(None).cast("decimal(18,2)").alias("officialSale"),
        nothing.alias("itemImage"),
        "date",
        F.lit("true").alias("inStock"),
        (F.col("date").cast("timestamp_ntz") + F.expr("interval 23 hours")).cast("timestamp_ntz").alias("_timestamp"),
    ).select(*UNIFIED, "_timestamp")


def legacy(rows: DataFrame) -> DataFrame:
    """Rows in the older layout: slug as parsedUrl, prices as text."""
    prices = {c: F.col(c).cast("string") for c in ("currentPrice", "originalPrice")}
    return rows.withColumns(prices).withColumnRenamed("slug", "parsedUrl")
