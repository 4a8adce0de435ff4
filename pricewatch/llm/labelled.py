"""A bounded sample of labelled rows for the classifiers, and logistic calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    allowed: Column,
    per_label: int = 2000,
    label_bytes: int = 24 << 20,
    text_bytes: int = 4 << 20,
    doc_id: str = "doc_id",
    text_col: str = "text",
) -> tuple[list[bytes], np.ndarray, float]:
    """Texts and labels of a bounded sample, and the share of label 1 among all allowed rows.

    The documented bound of what a classifier is fitted on: of each label the rows
    with the lowest hashes of their id, at most `per_label`, for as long as their texts add up to
    at most `label_bytes` (the first one is always taken). Texts are whole; only one of more than
    `text_bytes` is given by windows from all over it. So the driver gets at most
    2 * label_bytes, and a rerun takes the same rows. `allowed` is a condition
    on the id: no label of another row is read. Null texts, ids and labels are not sampled.
    """
    key = F.xxhash64(F.lit(17), F.col("_id"))
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
    known = known.where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull()).where(allowed).distinct()
    picked = known.where("_label = 0").orderBy(key, "_id").limit(per_label).union(
        known.where("_label = 1").orderBy(key, "_id").limit(per_label)
    )
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text_col).cast("binary").alias("_text")).where("_text is not null")
    # At most 2 * per_label ids, so the texts need no shuffle; first their lengths only.
    lengths = texts.join(F.broadcast(picked), "_id").select("_label", "_id", key.alias("_key"), F.octet_length("_text").alias("_n")).collect()
    chosen, room, last = [], {0: label_bytes, 1: label_bytes}, {}
    for row in sorted(lengths, key=lambda r: (r["_label"], r["_key"], r["_id"], r["_n"])):
        kind, size = row["_label"], min(row["_n"], text_bytes)
        if last.get(kind) == row["_id"]:  # rows that share an id come together
            room[kind] -= size
        elif room[kind] >= size or kind not in last:
            chosen.append((row["_id"], kind))
            room[kind] -= size
            last[kind] = row["_id"]
    share = known.agg(F.avg("_label")).first()[0]
    share = 0.5 if share is None else float(share)
    if not chosen:
        return [], np.empty(0), share
    chosen = docs.sparkSession.createDataFrame(chosen, f"_id {known.schema['_id'].dataType.simpleString()}, _label int")
    rows = texts.join(F.broadcast(chosen), "_id").select("_id", "_label", whole_or_windows(F.col("_text"), text_bytes).alias("_text")).collect()
    rows.sort(key=lambda r: (r["_id"], r["_label"], bytes(r["_text"])))
    return [bytes(r["_text"]) for r in rows], np.array([r["_label"] for r in rows], np.float64), share


def whole_or_windows(text: Column, most: int, window: int = 4096) -> Column:
    """The bytes of a text; of a text longer than `most`, as many windows as that holds, evenly spread from its start to its end."""
    n, count = F.octet_length(text), max(1, most // window)
    start = lambda i: (F.floor(i * (n - window) / max(1, count - 1)) + 1).cast("int")
    windows = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.substring(text, start(i), F.lit(window)))
    joined = F.aggregate(windows, F.lit(b""), lambda done, part: F.concat(done, part))
    return F.when(n > most, joined).otherwise(text)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(features: np.ndarray, target: np.ndarray, share: float = 0.5, ridge: float = 1e-4, rounds: int = 60) -> np.ndarray:
    """Weights (the last one constant) by Newton steps; label 1 weighs `share` of all."""
    if not len(target):
        return np.zeros(features.shape[1] + 1)
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    weight = np.where(target == 1, share / max((target == 1).sum(), 1), (1 - share) / max((target == 0).sum(), 1))
    for _ in range(rounds):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - target)) + ridge * w
        curve = (x.T * (weight * p * (1 - p))) @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w
