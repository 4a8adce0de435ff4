"""Stage 01 driven by new raw files.

A micro-batch only says which days have new rows. Those days are then unified
from all their raw rows and upserted, so the result does not hang on how rows
were spread over files or batches, late rows correct their day, and a replayed
batch writes the same again. The keyed table is the only state.

Raw offers that are stored by day (`sources.raw`) are read back from the folders of the batch's
days, and only these are listed: a batch costs its days, however long the history is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.unify import one_per_day, rows_of_days, unify
from ..sources import raw as raw_offers, tables


def offers_of_batch(spark: SparkSession, batch: DataFrame, source_path: str, schema: str, by_day: bool) -> DataFrame:
    """All stored offers of the days that have a row in the batch."""
    if not by_day:
        return rows_of_days(spark.read.schema(schema).parquet(source_path), batch)
    # At most the days of the calendar; rows without a day have no price.
    days = batch.select(raw_offers.day_of().alias("day")).where("day is not null").distinct().collect()
    return raw_offers.read(spark, source_path, schema, [r["day"] for r in days])


def stream_unify(
    spark: SparkSession,
    source_path: str,
    schema: str,
    table_path: str,
    checkpoint_path: str,
    min_scope: str = "day",
    keys: Sequence[str] = ("itemId",),
    by: Sequence[str] = (),
    files_per_batch: int | None = None,
    by_day: bool = False,
    cool_down: str | None = None,
) -> StreamingQuery:
    """Bring the unified table up to date with the raw Parquet files.

    It stops when they are taken in, or, with a `cool_down` ("120 minutes"), goes on: new
    files start a run, but none sooner than that after the start of the run before.
    `by` (part of `keys`) keeps shops apart that use the same item ids; `by_day`
    says that the raw offers are stored by day.
    """

    def apply(batch: DataFrame, _: int) -> None:
        offers = offers_of_batch(spark, batch, source_path, schema, by_day)
        rows = one_per_day(unify(offers, min_scope, by=by), keys)
        tables.upsert(rows, table_path, [*keys, "date"], partition_by="date", keep_stamp=True)

    layout = f", {raw_offers.DAY} date, {raw_offers.BATCH} string" if by_day else ""
    reader = spark.readStream.schema(schema + layout)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.parquet(source_path)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**({"processingTime": cool_down} if cool_down else {"availableNow": True}))
        .start()
    )
