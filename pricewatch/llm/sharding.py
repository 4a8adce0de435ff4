"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Rows with equal texts form a group. Groups are gathered into units: a group that
needs more than `heavy` of one shard's share of bytes, tokens or rows is cut into
pieces of at most that, by a hash of the row; all other groups are dealt to
`crates` by a hash of their text. So there are at most crates + 6 * shards / heavy units,
whatever the data, and only their sums go to the driver. There the units are
packed, the largest first: each goes to the shard whose residual capacity (share
less what it holds, by dimension) has the highest dot product with its needs.

Slots number a shard's rows without gaps. Rows are dealt to cells by a hash of
their id; a cell's first slot is the sum of the cells before it, and a row's place is its
rank in its cell. So no sort sees more than a cell, whatever one group holds.

Cases. Null texts have no bytes and no words, and are a group of their own. Rows
that are equal get slots in any order. An empty table gives an empty result. Other
columns are kept by `shard_documents`, whatever their names; only `shard` and `slot` are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import count_words, shared_dir, shielded, stored

DIMENSIONS = ("bytes", "tokens", "rows")


def pack(needs: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unit: the largest units first, each where its needs meet the most room."""
    total = needs.sum(0).astype(np.float64)
    scaled = needs / np.where(total > 0, total, 1) * shards
    order = np.lexsort((np.arange(len(needs)), -scaled.sum(1), -scaled.max(1)))
    room = np.ones((shards, needs.shape[1]))
    out = np.zeros(len(needs), np.int64)
    for unit in order:
        shard = int(np.argmax(room @ scaled[unit]))
        room[shard] -= scaled[unit]
        out[unit] = shard
    return out


def _group(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def place(
    docs: DataFrame,
    shards: int = 40,
    crates: int = 4096,
    heavy: float = 1 / 16,
    text_col: str = "text",
    key: tuple[str, ...] = ("doc_id",),
    extra_bytes: int = 16,
) -> DataFrame:
    """`docs` plus _size and shard; `key` names the columns whose hash cuts a heavy group into pieces."""
    spark = docs.sparkSession
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + extra_bytes
    measured = docs.select(_group(text).alias("group"), size.alias("bytes"), count_words(text).alias("tokens"))
    groups = measured.groupBy("group").agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    groups = stored(groups, shared_dir(spark), "groups")
    total = groups.agg(*[F.sum(c).alias(c) for c in DIMENSIONS]).first()
    share = [max((total[c] or 0) / shards, 1) for c in DIMENSIONS]
    most = F.greatest(*[F.col(c) / F.lit(float(s)) for c, s in zip(DIMENSIONS, share, strict=True)])
    pieces = F.when((most > heavy) & (F.col("rows") > 1), F.least(F.ceil(most / heavy), F.col("rows"))).otherwise(0).cast("int")
    groups = groups.withColumn("pieces", pieces)
    # Groups above the limit are few: their needs add up to three shares a shard at most.
    cut = groups.where("pieces > 0").orderBy("group").collect()
    crate = F.pmod(F.col("group"), F.lit(crates)).cast("int")
    dealt = groups.where("pieces = 0").groupBy(crate.alias("crate")).agg(*[F.sum(c).alias(c) for c in DIMENSIONS]).orderBy("crate").collect()
    needs = [[r[c] for c in DIMENSIONS] for r in dealt]
    needs += [[r[c] / r["pieces"] for c in DIMENSIONS] for r in cut for _ in range(r["pieces"])]
    found = pack(np.array(needs, np.float64).reshape(-1, 3), shards).tolist()
    by_crate = [(r["crate"], s) for r, s in zip(dealt, found, strict=False)]
    by_piece, at = [], len(dealt)
    for r in cut:
        by_piece.append((r["group"], found[at : at + r["pieces"]]))
        at += r["pieces"]
    # Bounded by `crates` and `shards / heavy`, not by the data.
    crate_map = F.broadcast(spark.createDataFrame(by_crate, "_crate int, _of_crate int"))
    piece_map = F.broadcast(spark.createDataFrame(by_piece, "_cut long, _of_piece array<int>"))
    rows = docs.withColumn("_size", size).withColumn("_group", _group(text))
    rows = rows.join(piece_map, F.col("_group") == F.col("_cut"), "left")
    rows = rows.join(crate_map, F.pmod(F.col("_group"), F.lit(crates)).cast("int") == F.col("_crate"), "left")
    piece = F.get("_of_piece", F.pmod(F.xxhash64(F.lit(1), *key), F.size("_of_piece").cast("long")).cast("int"))
    return rows.withColumn("shard", F.coalesce(piece, F.col("_of_crate"))).drop("_cut", "_crate", "_of_crate", "_of_piece", "_group")


def with_slots(placed: DataFrame, shard: str, order: tuple[str, ...], rows_per_cell: int = 10_000) -> DataFrame:
    """Adds `slot`: gapless from 0 in each shard. `placed` is read three times, so it should be stored."""
    counts = placed.groupBy(shard).count()
    most = counts.agg(F.max("count")).first()[0] or 0
    cells = max(1, -(-most // rows_per_cell))
    rows = placed.withColumn("_cell", F.pmod(F.xxhash64(F.lit(2), *order), F.lit(cells)).cast("int"))
    before = Window.partitionBy(shard).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy(shard, "_cell").count().withColumn("_first", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    rank = F.row_number().over(Window.partitionBy(shard, "_cell").orderBy(*order)) - 1
    ranked = rows.withColumn("_rank", rank)
    return ranked.join(firsts, [shard, "_cell"]).withColumn("slot", (F.col("_rank") + F.col("_first")).cast("long")).drop("_cell", "_rank", "_first")


@shielded
def shard_documents(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of `docs`, with shard and slot."""
    placed = place(docs.drop("shard", "slot"), shards, text_col=text_col, key=(doc_id,), **options).drop("_size")
    return with_slots(stored(placed, shared_dir(docs.sparkSession), "placed"), "shard", (doc_id,))
