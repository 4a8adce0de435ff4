"""Connected components of a link table, without collecting it anywhere.

Every vertex takes the smallest label among itself and its neighbours, then the
label of its label; both halve long chains. Each round is two joins and a
partial minimum, so a hub with millions of links is summed up before it is
shuffled, and AQE splits its side of the join. Rounds are written to the shared
folder, so a lost executor costs a task and not the whole lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def connected_components(links: DataFrame, folder: str, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every vertex in a link, the smallest id it reaches. Links with a null end are left out."""
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    both = stored(pairs.union(pairs.select("b", "a")).distinct(), folder, "both")
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id")
    labels = stored(labels, folder, "labels-0")
    turn, changed = 0, not both.isEmpty()
    while changed:
        turn += 1
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "near").alias("low"))
        parent = labels.select(F.col("id").alias("parent"), F.col("label").alias("above"))
        jumped = low.join(parent, low["low"] == parent["parent"], "left").select(
            "id", F.least("low", F.coalesce("above", "low")).alias("label"), F.col("label").alias("was")
        )
        after = stored(jumped, folder, f"labels-{turn}")
        changed = not after.where("label < was").isEmpty()
        labels = after.select("id", "label")
    return labels.withColumnRenamed("label", "component")
