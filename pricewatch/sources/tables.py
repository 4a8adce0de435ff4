"""Stored tables: create, replace and upsert by key on plain Parquet.

Three layouts, all without a table format on top:

* partitioned by a key column (a date): an upsert rewrites only the partitions
  that the new rows touch, through dynamic partition overwrite. A daily load
  into years of history costs the touched days, not the table. The merged rows
  are written aside first: if the driver is lost while partitions are being
  swapped, the next upsert finds them and swaps again.
* in buckets, for item tables: a row lies in the folder of its key's hash, and an upsert
  rewrites, in the same way, only the buckets that hold a new row's key. Their
  number is fixed when the table comes into being.
* unpartitioned, for small keyed tables: each upsert writes a new version
  directory, then moves the pointer file. Readers keep the version they opened.

A partitioned table whose rows carry a load time has a small side table, `loads`:
how many rows of which load each partition holds. An upsert rewrites its lines of
the touched partitions, from the rows it has just written, so it always says what the table
holds, and the newest loads and their days are found without reading the table.

New rows are written beside the table once before they are merged, so that
their lineage is not run again for every use. Each writer has names of its own
for what it writes aside; two writers of the same partitions still have to take turns.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.frames import first_per_group

_POINTER = "_current"
_PENDING = "_pending"
_TOUCHED = "_touched"
_LOADS = "_loads"
_BUCKETS = "_buckets"
BUCKET = "hash_bucket"
#: Columns that `loads` tells apart, where a table has them.
LOAD_COLUMNS = ("shop", "shopOrigin")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh path below the shared folder the cluster names; only a local session may go without one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile

        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/pricewatch-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "US-ASCII").strip()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file beside the old one, then rename over it."""
    jvm = spark._jvm
    fs, target = _fs(spark, path)
    _, draft = _fs(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(text, "ascii"))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, target, options)


def _read_pointer(spark: SparkSession, path: str) -> str | None:
    return read_text(spark, f"{path}/{_POINTER}")


def _move_pointer(spark: SparkSession, path: str, version: str) -> None:
    """Publish a version."""
    write_text(spark, f"{path}/{_POINTER}", version)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def table_exists(spark: SparkSession, path: str) -> bool:
    """True for a table with a published version, or with partitions or files of its own.

    A dynamic overwrite leaves no success marker in the table, so the content
    decides; a version without a pointer was never published and does not count.
    """
    if _read_pointer(spark, path) is not None:
        return True
    return any(not name.startswith(("_", ".", "v-")) for name in _names(spark, path))


def read(spark: SparkSession, path: str, alias: str | None = None) -> DataFrame:
    """The current rows of a stored table; with `alias` also as a temp view."""
    version = _read_pointer(spark, path)
    df = spark.read.parquet(f"{path}/{version}" if version else path).drop(BUCKET)
    if alias:
        df.createOrReplaceTempView(alias)
    return df


def replace(
    df: DataFrame, path: str, loaded_at: datetime | Column | None = None, keys: Sequence[str] = ()
) -> None:
    """Full replace: a new version holds `df`, one row per key if keys are given, and nothing of the old one."""
    _write_version(stamp(_one_per_key(df, keys) if keys else df, loaded_at), path)


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), keep_stamp: bool = False) -> DataFrame:
    """First row per key by `order`, then by the remaining columns; the load time decides nothing."""
    rest = [c for c in df.columns if c not in (*keys, "_timestamp")]
    payload = [*rest, *(["_timestamp"] if keep_stamp and "_timestamp" in df.columns else [])]
    if not payload:
        return df.select(*keys).distinct()
    rows = first_per_group(df, list(keys), [*order, *[F.col(c) for c in rest]], payload)
    return rows.select(*[c for c in df.columns if c in rows.columns])


def stamp(df: DataFrame, loaded_at: datetime | Column | None) -> DataFrame:
    """Set the load time, one value per load."""
    if loaded_at is None:
        loaded_at = datetime.now()
    value = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    return df.withColumn("_timestamp", value.cast("timestamp_ntz"))


def _write_version(df: DataFrame, path: str) -> None:
    version = f"v-{datetime.now():%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/{version}")
    _move_pointer(df.sparkSession, path, version)
    drop_old_versions(df.sparkSession, path)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the newest `keep` versions of an unpartitioned table; readers may hold the others."""
    current = _read_pointer(spark, path)
    if current is None:
        return 0
    names = sorted((n for n in _names(spark, path) if n.startswith("v-")), reverse=True)
    old = [n for n in names[max(keep, 1):] if n != current]
    for name in old:
        _delete(spark, f"{path}/{name}")
    return len(old)


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a work folder of `scratch_dir` once nothing reads it any more."""
    if "/pricewatch-" not in folder:
        raise ValueError(f"{folder} is no work folder")
    _delete(spark, folder)


def create_if_absent(spark: SparkSession, path: str, template_csv: str, schema: str | None = None) -> bool:
    """Create the table from a CSV template with a header line; leave an existing one alone.

    Without a schema every column is text, so the template is not read for types.
    """
    if table_exists(spark, path):
        return False
    reader = spark.read.option("header", True)
    if schema:
        reader = reader.schema(schema)
    replace(reader.csv(template_csv), path)
    return True


def upsert(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[Column] = (),
    partition_by: str | None = None,
    loaded_at: datetime | Column | None = None,
    keep_stamp: bool = False,
    buckets: int | None = None,
    replaced: DataFrame | None = None,
) -> None:
    """Rows of `incoming` replace rows with the same key; all others stay.

    Several new rows with one key collapse to the first by `order`, then by the
    remaining columns. Running it again with the same rows changes nothing but
    the load time. A partitioned table comes into being with its first row, one in
    `buckets` with that many. `replaced` names keys whose rows go, whether or not there is a new row.
    """
    spark = incoming.sparkSession
    keys = list(keys)
    if partition_by and partition_by not in keys:
        raise ValueError("the partition column must be part of the key")
    if partition_by and buckets:
        raise ValueError("a table lies in partitions or in buckets")
    rows = _one_per_key(incoming, keys, order, keep_stamp)
    rows = rows if keep_stamp else stamp(rows, loaded_at)
    if buckets:
        number = _bucket_count(spark, path, buckets)
        _into_buckets(spark, path, keys, number)
        rows = rows.withColumn(BUCKET, bucket_of(keys, number))
        replaced = replaced if replaced is None else replaced.withColumn(BUCKET, bucket_of(keys, number))
        partition_by = BUCKET
    staged = f"{path}/_staging-{uuid.uuid4().hex}"
    rows.write.parquet(f"{staged}/rows")
    new, gone = spark.read.schema(rows.schema).parquet(f"{staged}/rows"), None
    if replaced is not None:
        gone = replaced.select(*dict.fromkeys([*keys, *([partition_by] if partition_by else [])])).distinct()
        gone.write.parquet(f"{staged}/gone")
        gone = spark.read.schema(gone.schema).parquet(f"{staged}/gone")

    if buckets and not table_exists(spark, path):
        _empty(new, path, 0)
    if not partition_by:
        old = read(spark, path) if table_exists(spark, path) else None
        _write_version(new if old is None else _merged(old, new, keys, gone), path)
    elif not (new.isEmpty() and (gone is None or gone.isEmpty())):
        _upsert_partitions(spark, new, path, keys, partition_by, gone)
    _delete(spark, staged)


def _empty(rows: DataFrame, path: str, bucket: int) -> None:
    """A bucket without a row: its file keeps the columns known."""
    rows.limit(0).drop(BUCKET).write.mode("overwrite").parquet(f"{path}/{BUCKET}={bucket}")


def bucket_of(keys: Sequence[str], number: int) -> Column:
    """The bucket of a key: by its text, so that the width of a number does not matter."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(number)).cast("int")


def _bucket_count(spark: SparkSession, path: str, wanted: int) -> int:
    """The number a table was made with; a new table gets the wanted one."""
    known = read_text(spark, f"{path}/{_BUCKETS}")
    if known is None:
        write_text(spark, f"{path}/{_BUCKETS}", str(wanted))
    return int(known or wanted)


def _into_buckets(spark: SparkSession, path: str, keys: Sequence[str], number: int) -> None:
    """Rows of a table that had versions so far; the pointer goes last, so a lost run does it again."""
    if _read_pointer(spark, path) is not None:
        rows = read(spark, path).withColumn(BUCKET, bucket_of(keys, number))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
        _delete(spark, f"{path}/{_POINTER}")
        for name in _names(spark, path):
            if name.startswith("v-"):
                _delete(spark, f"{path}/{name}")


def read_buckets(spark: SparkSession, path: str, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """Of a table in buckets only those that hold a key of `wanted`."""
    number = bucket_of(keys, int(read_text(spark, f"{path}/{_BUCKETS}")))
    return in_set(spark.read.parquet(path), BUCKET, wanted.select(number.alias(BUCKET))).drop(BUCKET)


def _merged(old: DataFrame, new: DataFrame, keys: Sequence[str], gone: DataFrame | None = None) -> DataFrame:
    """Null keys are equal to each other, so that a replay of such a row replaces it."""
    replaced = new.select(*keys)
    if gone is not None:
        replaced = replaced.unionByName(gone.select(*keys))
    replaced = replaced.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same = [old[k].eqNullSafe(replaced[f"_new_{k}"]) for k in keys]
    kept = old.join(replaced, reduce(lambda x, y: x & y, same), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def _upsert_partitions(
    spark: SparkSession, new: DataFrame, path: str, keys: list[str], column: str, gone: DataFrame | None = None
) -> None:
    for name in _names(spark, path):
        if name.startswith(_PENDING):  # a run that was lost while it swapped
            _swap_pending(spark, path, name, column)
    merged = new
    touched = new.select(column)
    if gone is not None:
        touched = touched.union(gone.select(column))
    if table_exists(spark, path):
        old = spark.read.parquet(path)
        # The set of touched values prunes partitions at the scan.
        merged = _merged(in_set(old, column, touched), new, keys, gone)
    name = uuid.uuid4().hex
    if gone is not None:  # partitions that may be left without a row
        touched.distinct().write.parquet(f"{path}/{_TOUCHED}-{name}")
    merged.write.parquet(f"{path}/{_PENDING}-{name}")
    _swap_pending(spark, path, f"{_PENDING}-{name}", column)


def in_set(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose `column` is among `values` (one column, few distinct values), null being equal to null.

    The set is a scalar subquery on the bare column: of a partition column it prunes the folders.
    """
    name = values.columns[0]
    found = values.agg(F.collect_set(name).alias("known")).scalar()
    blank = values.agg(F.coalesce(F.bool_or(F.col(name).isNull()), F.lit(False)).alias("blank")).scalar()
    return df.where(F.coalesce(F.array_contains(found, F.col(column)), blank))


def _swap_pending(spark: SparkSession, path: str, name: str, column: str) -> None:
    """Put merged rows that were completely written aside in place of their partitions; leave others alone."""
    pending, listed = f"{path}/{name}", f"{path}/{name.replace(_PENDING, _TOUCHED)}"
    if not path_exists(spark, f"{pending}/_SUCCESS"):
        return
    rows = spark.read.parquet(pending)
    # Rebalance splits a hot partition value over several files and packs small ones.
    (
        rows.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    touched = rows.select(column)
    if path_exists(spark, listed):
        asked = spark.read.schema(touched.schema).parquet(listed)
        held = touched.distinct().withColumnRenamed(column, "_held")
        for row in asked.join(held, asked[column].eqNullSafe(held["_held"]), "left_anti").collect():  # partitions without a row left
            if column == BUCKET:
                _empty(rows, path, row[0])
            else:
                _delete(spark, f"{path}/{column}={'__HIVE_DEFAULT_PARTITION__' if row[0] is None else row[0]}")
        touched = asked
    if "_timestamp" in rows.columns and column != BUCKET:
        _update_loads(spark, rows, touched, path, column)
    _delete(spark, pending)
    _delete(spark, listed)


def _count_loads(rows: DataFrame, column: str) -> DataFrame:
    known = [c for c in LOAD_COLUMNS if c in rows.columns and c != column]
    return rows.groupBy(column, *known, "_timestamp").agg(F.count("*").alias("rows"))


def _update_loads(spark: SparkSession, rows: DataFrame, touched: DataFrame, path: str, column: str) -> None:
    """New lines for the touched partitions; a table that has no side table yet is read once."""
    side = f"{path}/{_LOADS}"
    if _read_pointer(spark, side) is None:
        _write_version(_count_loads(spark.read.parquet(path), column).coalesce(1), side)
        return
    old, values = read(spark, side), touched.select(F.col(column).alias("_touched")).distinct()
    kept = old.join(values, old[column].eqNullSafe(values["_touched"]), "left_anti")
    _write_version(kept.unionByName(_count_loads(rows, column), allowMissingColumns=True).coalesce(1), side)


def loads(spark: SparkSession, path: str) -> DataFrame:
    """What a partitioned table holds: partition, shop and origin where it has them, load time, rows."""
    return read(spark, f"{path}/{_LOADS}")


def newest_loads(loads: DataFrame, number: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """The lines of the `number` newest loads, of each group in `by`."""
    times = loads.select(*by, "_timestamp").where("_timestamp is not null").distinct()
    place = F.row_number().over(Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc("_timestamp")))
    newest = times.withColumn("_place", place).where(F.col("_place") <= number).drop("_place")
    same = reduce(lambda x, y: x & y, [loads[c].eqNullSafe(newest[c]) for c in (*by, "_timestamp")])
    return loads.join(newest, same, "left_semi")


def snapshot_and_history(
    df: DataFrame,
    current_path: str,
    history_path: str,
    keys: Sequence[str],
    loaded_at: datetime | Column | None = None,
    partition_by: str | None = None,
) -> None:
    """One result to two tables: the current one is replaced, the history gets an upsert.

    The history reads what the current table has just stored, so the result
    runs once.
    """
    replace(df, current_path, loaded_at)
    stored = read(df.sparkSession, current_path)
    upsert(stored, history_path, keys, partition_by=partition_by, keep_stamp=True)
