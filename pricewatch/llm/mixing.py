"""Mixing sources to target weights by entropy balancing, rates rounded into copies.

Problem. Each document gets a rate r >= 0, the number of copies wanted, at most
`limit`. Among all rates that meet the sources' word targets, those closest to 1 in
relative entropy are r = min(limit, exp(lambda_s * z)), z being the document's size by
its source's mean. The dual is convex with one variable a source, and is solved by
safeguarded Newton steps on log(words) for all sources at once: each step is one
join and one grouped sum over the table of (source, size, documents), which
loses nothing, as rates depend on source and size alone. A target at the limit is met by r = limit,
the bound of the dual.

Rounding. Documents of a source are dealt to cells of about `rows_per_cell` by a hash of
their id. In a cell, from the largest size to the smallest, each takes its rate's floor
or ceiling, whichever keeps the words taken closest to the words wanted so far: the
error ends below the smallest documents' size. Everything hangs on ids and sizes
alone, so reruns agree. A source holding a third of all rows is many cells.

Cases. Null texts have size 0, no words wanted and no copies counted (their taken words are
0). A null source is a source of its own. Equal rows are rounded together. Empty
tables and sources without words have targets of 0. `mixed_documents` keeps all columns.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import count_words, shared_dir, shielded, stored

STEPS = 60


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Per source: source_size and target. `sizes` has source and size.

    Weights repeat over sources in code point order, null last. A target stops at
    `limit` times the source's size; what is above goes to the others by weight,
    until none is above: sources fill up in order of size by weight, so running sums
    say which are full. One row a source passes through the windows.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    at = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at % len(weights) + 1).cast("int"))
    rows = by_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(limit)))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    below = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.withColumn("_full", F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
    rows = rows.withColumn("_used", F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
    rows = rows.withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(share)))
    rows = rows.withColumn("_weights", F.sum("weight").over(everything))
    level = (F.col("_all") - F.col("_full")) / (F.col("_weights") - F.col("_used"))
    # The first source that its level does not fill up sets the level of all others.
    first = F.struct(F.row_number().over(filling).alias("at"), level.alias("level"))
    rows = rows.withColumn("_first", F.when(level * F.col("weight") < F.col("cap"), first))
    rows = rows.withColumn("_level", F.min("_first").over(everything)["level"])
    target = F.coalesce(F.least(F.col("_level") * F.col("weight"), F.col("cap")), F.col("cap"))
    return rows.select("source", "source_size", target.alias("target"))


def tilts(histogram: DataFrame, goals: DataFrame, limit: float, folder: str, exact: float = 1e-7) -> DataFrame:
    """Per source: lambda and mean, by Newton steps over all of `histogram` (source, size, documents)."""
    usual = histogram.groupBy("source").agg(
        F.sum(F.col("size") * F.col("documents")).alias("words"), F.sum("documents").alias("documents")
    )
    start = goals.join(usual, goals["source"].eqNullSafe(usual["source"])).select(
        goals["source"],
        "target",
        (F.col("words") / F.col("documents")).alias("mean"),
        (F.col("target") >= F.col("words") * limit * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("lam"),
        F.lit(-1e6).alias("low"),
        F.lit(1e6).alias("high"),
        (F.col("target") == 0).alias("done"),
    )
    state = stored(start.where("words > 0"), folder, "tilt-0")
    z = F.col("size") / F.col("mean")
    grown = F.exp(F.least(F.col("lam") * z, F.lit(math.log(limit))))
    inside = F.col("lam") * z < math.log(limit)
    for turn in range(1, STEPS + 1):
        active = state.where("not full and not done")
        if active.isEmpty():
            break
        h = histogram.withColumnRenamed("source", "_source")
        words = F.col("size") * F.col("documents") * grown
        sums = (
            h.join(active, F.col("_source").eqNullSafe(F.col("source")))
            .groupBy("source")
            .agg(F.sum(words).alias("got"), F.sum(F.when(inside, words * z).otherwise(0.0)).alias("slope"))
            .withColumnRenamed("source", "_source")
        )
        low = F.when(F.col("got") < F.col("target"), F.col("lam")).otherwise(F.col("low"))
        high = F.when(F.col("got") > F.col("target"), F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") + F.log(F.col("target") / F.col("got")) * F.col("got") / F.col("slope")
        # A step out of the bracket, or from where nothing moves, goes to its middle.
        middle = F.when(F.col("_low") < -1e5, F.col("_high") * 2 - 1).when(F.col("_high") > 1e5, F.col("_low") * 2 + 1)
        middle = middle.otherwise((F.col("_low") + F.col("_high")) / 2)
        inner = (F.col("slope") > 0) & (F.col("got") > 0) & (F.col("_new") > F.col("_low")) & (F.col("_new") < F.col("_high"))
        met = F.abs(F.col("got") - F.col("target")) <= exact * F.col("target")
        moved = (
            state.join(sums, F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumn("_low", F.when(F.col("got").isNotNull(), low).otherwise(F.col("low")))
            .withColumn("_high", F.when(F.col("got").isNotNull(), high).otherwise(F.col("high")))
            .withColumn("_new", F.when((F.col("slope") > 0) & (F.col("got") > 0), newton))
            .withColumn("done", F.col("done") | F.coalesce(met, F.lit(False)))
            .withColumn("lam", F.when(F.col("got").isNull() | F.col("done"), F.col("lam")).when(F.coalesce(inner, F.lit(False)), F.col("_new")).otherwise(middle))
            .select("source", "target", "mean", "full", "lam", F.col("_low").alias("low"), F.col("_high").alias("high"), "done")
        )
        state = stored(moved, folder, f"tilt-{turn}")
    return state.select("source", "mean", "lam", "full", (F.col("target") == 0).alias("none"))


def _rounded(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies of one cell's documents, the error carried from the largest to the smallest."""
    rows = rows.sort_values(["size", "doc_id", "row"], ascending=[False, True, True], kind="stable", na_position="first")
    debt, copies = 0.0, []
    for size, times, rate in zip(rows["size"].tolist(), rows["times"].tolist(), rows["rate"].tolist(), strict=True):
        whole = math.floor(rate + 1e-9)
        debt += (rate - whole) * size * times
        extra = size > 0 and rate > whole + 1e-9 and debt >= size * times / 2
        debt -= size * times * extra
        copies.append(whole + int(extra))
    return rows.assign(copies=copies)[["row", "doc_id", "times", "size", "source_size", "target", "copies"]]


def _row_hash(*columns: str) -> Column:
    """A hash leaves nulls out, so which columns are null is hashed as well."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    limit: float = 2.0,
    rows_per_cell: int = 20_000,
    doc_id: str = "doc_id",
    text_col: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per distinct row: row (a hash of id, source and text), doc_id, times (how often it occurs), size, source_size, target, copies.

    Equal rows are rounded together and get the same copies each.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark)
    # A string source is compared by bytes of UTF-8, which is code point order.
    sized = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        _row_hash(doc_id, source, text_col).alias("row"),
        F.col(source).cast("string").alias("source"),
        count_words(F.col(text_col)).alias("size"),
    )
    sized = stored(sized, folder, "sized")
    goals = stored(targets(sized, weights, share, limit), folder, "goals")
    histogram = stored(sized.groupBy("source", "size").agg(F.count("*").alias("documents")), folder, "histogram")
    lam = tilts(histogram, goals, limit, folder)
    distinct = sized.groupBy("doc_id", "row", "source", "size").agg(F.count("*").alias("times"))
    counts = sized.groupBy("source").agg(F.count("*").alias("documents"))
    facts = goals.join(counts.withColumnRenamed("source", "_c"), F.col("source").eqNullSafe(F.col("_c")))
    facts = facts.join(lam.withColumnRenamed("source", "_l"), F.col("source").eqNullSafe(F.col("_l")), "left")
    facts = facts.select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        "mean",
        "lam",
        F.coalesce("full", F.lit(False)).alias("full"),
        F.coalesce("none", F.lit(True)).alias("none"),
        F.ceil(F.col("documents") / rows_per_cell).alias("cells"),
    )
    facts = stored(facts, folder, "facts")
    # One row a source.
    rate = (
        F.when(F.col("full"), F.lit(float(limit)))
        .when(F.col("none"), F.lit(0.0))
        .otherwise(F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(math.log(limit)))))
    )
    rows = distinct.join(facts, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "row",
        "times",
        "size",
        "source_size",
        "target",
        rate.alias("rate"),
        F.xxhash64("source", F.pmod(F.xxhash64(F.lit(3), "doc_id", "row"), F.col("cells"))).alias("cell"),
    )
    schema = "row long, doc_id long, times long, size long, source_size long, target double, copies int"
    return rows.groupBy("cell").applyInPandas(_rounded, schema)


@shielded
def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of `docs`, each as many times as the mix takes it; equal rows share their copies."""
    copies = mix(docs, doc_id=doc_id, text_col=text_col, source=source, **options)
    taken = copies.where("copies > 0").select(F.col("row").alias("_row"), F.col("copies").alias("_copies"))
    keyed = docs.withColumn("_own", _row_hash(doc_id, source, text_col))
    joined = keyed.join(taken, F.col("_own") == F.col("_row"))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)

