"""Raw offers as they come in, stored by the day they were scraped.

Each batch has a name and is a folder below each of its days, so a batch that is
landed again replaces itself. A side table (`loads`) holds a line for each day, shop,
origin and load time of a batch: its rows and its newest scrape. It tells the newest
scrape, the days of a load and how many rows there are without reading an offer.

Offers without a readable day lie in a folder of their own and are read only with all days.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.prices import not_blank
from . import tables

DAY, BATCH = "day", "batch"
_SIDE = "_loads"


def day_of() -> Column:
    """The day of an offer, as `unify` reads it."""
    return F.when(not_blank("date"), F.to_date("date"))


def land(offers: DataFrame, path: str, batch: str) -> None:
    """Store the offers of a batch by day; the same name again replaces what it had stored on these days."""
    spark = offers.sparkSession
    staged = tables.scratch_dir(spark)
    offers.withColumn(DAY, day_of()).write.parquet(staged)
    rows = spark.read.parquet(staged)
    (
        rows.withColumn(BATCH, F.lit(batch))
        .hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, BATCH)
        .parquet(path)
    )
    lines = rows.groupBy(DAY, "shop", "shopOrigin", "_timestamp").agg(
        F.count("*").alias("rows"), F.max(F.when(not_blank("date"), F.col("date"))).alias("last_scrape")
    )
    lines.select(F.lit(batch).alias(BATCH), "*").coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(BATCH).parquet(f"{path}/{_SIDE}")
    tables.remove(spark, staged)


def read(spark: SparkSession, path: str, schema: str, days: list[date] | None = None) -> DataFrame:
    """Stored offers with their `day`; of given days only, whose folders alone are listed."""
    kept = f"{schema}, {DAY} date"
    reader = spark.read.schema(f"{kept}, {BATCH} string").option("basePath", path)
    if days is None:
        found = reader.parquet(path)
    else:
        folders = [f"{path}/{DAY}={d}" for d in sorted(set(days))]
        folders = [f for f in folders if tables.path_exists(spark, f)]
        found = reader.parquet(*folders) if folders else spark.createDataFrame([], kept)
    return found.drop(BATCH)


def loads(spark: SparkSession, path: str) -> DataFrame:
    """What is stored: batch, day, shop, origin, load time, rows, newest scrape."""
    return spark.read.parquet(f"{path}/{_SIDE}")
