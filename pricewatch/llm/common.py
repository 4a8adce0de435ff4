"""What the operators share: work folders all machines see, stored frames, words, arrays in rows."""

from __future__ import annotations

import functools
import itertools
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: ASCII white space; `bytes.split()` cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """A fresh path below the folder the cluster names; a local session without one gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        base = f"file://{tempfile.gettempdir()}"
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write once, read from the files: a cut in the lineage that outlives executors."""
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shielded(operator):
    """For operators that return the columns they are given: those whose names begin as the operator's own do, with `_`, are set aside."""

    @functools.wraps(operator)
    def run(docs: DataFrame, *args, **options):
        taken = {c.lower() for c in docs.columns}
        free = (n for n in (f"aside{i}" for i in itertools.count()) if n not in taken)
        names = {c: next(free) for c in docs.columns if c.startswith("_")}
        back = {new: old for old, new in names.items()}
        # Positions, as a table may have names that differ in case only.
        renamed = docs.toDF(*[names.get(c, c) for c in docs.columns])
        out = operator(renamed, *args, **options)
        return out.toDF(*[back.get(c, c) for c in out.columns])

    return run


def small_batches(spark: SparkSession, rows: int = 512, size: str = "8m") -> None:
    """Arrow batches short enough that very long texts fit a worker many times over."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def count_words(text: Column) -> Column:
    """Words between ASCII white space; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc(value: Column) -> Column:
    return F.crc32(value.cast("string").cast("binary"))


def words(text: bytes | None) -> list[bytes]:
    """A-Z lowered, cut at ASCII white space."""
    return text.lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes by word. Emptied when large, so that any vocabulary fits a worker."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mix(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values (multiply and fold, twice)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of `n` words; the whole sequence as one if it is shorter, none if it is empty."""
    if not len(h):
        return h
    n = min(n, len(h))
    out = h[: len(h) - n + 1].copy()
    with np.errstate(over="ignore"):
        for i in range(1, n):
            out = mix(out) * np.uint64(3) + h[i : len(h) - n + 1 + i]
    return mix(out + np.uint64(n))
