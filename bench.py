"""Headline queries over the bench tables; prints one JSON line.

`lineitem` plays the stored price table (one row per supplier and ship day, a
dense history of several years) and `events` the raw offers of a month. The
staged inputs are written once, untimed, as the pipeline stores its stages;
each query then runs from scan to a full count of its rows, best of three.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewatch.functions.frames import tune
from pricewatch.operators import audit, complete, history, metadata, refprice, unify
from pricewatch.sources import offers, tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("pricewatch-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def store(df: DataFrame, root: str, name: str) -> DataFrame:
    path = f"{root}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def main() -> None:
    spark = session()
    root = tables.scratch_dir(spark)
    prices = store(offers.shipped_prices(spark, SF_DIR), root, "unified")
    as_of = prices.agg(F.max("date")).first()[0]
    reference = store(refprice.ref_prices(prices, as_of), root, "reference")
    every_day = reference.join(prices.select("itemId", F.col("date").alias("day")).distinct(), "itemId").select(
        "itemId", F.col("day").alias("date"), "commonPrice", "minPrice"
    )
    span = 10_000
    full = store(complete.complete(prices, every_day, span, as_of), root, "complete")
    feed = store(
        full.select(F.lit("demo_origin").alias("shopOrigin"), F.col("_timestamp").cast("string").alias("date")),
        root,
        "raw",
    )
    raw = store(offers.raw_offers(spark, SF_DIR), root, "offers")
    start = spark.read.parquet(f"{root}/unified").agg(F.min("date")).first()[0]
    history_days = (as_of - start).days + 1

    queries = {
        "unify_prices": lambda: unify.unify(raw, "scrape"),
        "unify_prices_daily": lambda: unify.one_per_day(unify.unify(raw, "day")),
        "item_count_check": lambda: unify.item_count_check(raw, raw),
        "ref_prices": lambda: refprice.ref_prices(prices, as_of),
        "ref_prices_full_history": lambda: refprice.ref_prices(
            prices, as_of, history_days, history_days, calendar_days=history_days
        ),
        "complete_prices": lambda: complete.complete(prices, reference, span, as_of),
        "suspicious_prices": lambda: complete.suspicious_prices(prices, days=history_days, above=50, below=0.02),
        "latest_metadata": lambda: metadata.latest_metadata(full, as_of, span),
        "fill_history": lambda: history.fill_history(history.dedupe_days(full), as_of, span=full),
        "price_history": lambda: history.price_history(full, as_of),
        "price_history_all": lambda: history.price_history_plain(full, as_of, span),
        "audit_dashboard": lambda: audit.audit_dashboard(full, feed),
        "raised_ref_price": lambda: audit.raised_reference_price(
            audit.audit_window(full, feed, audit.AuditSettings(window_days=span)), F.lit(as_of)
        ),
    }
    seconds = {}
    for name, build in queries.items():
        times = []
        for _ in range(RUNS):
            start_time = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start_time)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").split("sf")[-1],
                "cpus": int(CPUS),
                "rows": {"lineitem_days": prices.count(), "offers": raw.count()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
