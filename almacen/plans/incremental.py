"""Incremental silver: the newest row of every key is kept, and a new day touches only its own buckets.

The kept state of a source table is the result of typing and deduplicating all its days, with the
number of source rows and conversion failures behind each key. It is stored in a fixed number of buckets
by a hash of the key. A new day is typed and deduplicated on its own, the buckets it has keys of are
read (a partition filter), merged, since the newest row of a key is a maximum and may be taken in steps, and
overwritten; all other buckets stay as they are. The cost of a day follows the day and the buckets it
touches, not the history. For a day to touch few buckets, keys must come in time order within a
bucket, or buckets be many; a day whose keys are spread over all of them still saves reading raw history.

A bucket carries the last day merged into it, so a day that is merged again, after a run that failed half-way,
changes nothing. Days are merged in order; a day that is ingested anew after it was merged needs ``rebuild``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almacen import schemas as S
from almacen.config import FAILURES, ROWS
from almacen.operators.dedupe import dedupe_latest
from almacen.plans import silver
from almacen.session import reliable_checkpoint
from almacen.sources import bronze

BUCKET, UNTIL, SLICE = "_bucket", "_hasta", "_parte"
BUCKETS = 256
ROWS_A_SLICE = 200_000  # a bucket of more rows is merged and written by several tasks, each with a slice of its keys


def state_path(root: str, table: str, buckets: int) -> str:
    """The number of buckets is part of the name: another number is another state."""
    return f"{root.rstrip('/')}/estado/{table}-{buckets}"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


def slice_of(key: str, slices: int):
    """Which slice of its bucket a key is in; another hash than the bucket's."""
    return F.pmod(F.hash(key), F.lit(slices)).alias(SLICE)


def touched_state(spark: SparkSession, path: str, touched: Sequence[int]) -> DataFrame:
    """The kept rows of some buckets; the filter prunes the folders of all others."""
    return spark.read.parquet(path).where(F.col(BUCKET).isin(list(touched)))


def merge_days(
    new: DataFrame,
    table: str,
    path: str,
    buckets: int = BUCKETS,
    order_by: Sequence[str] = (),
    rebuild: bool = False,
) -> list[int]:
    """Merge ``new`` (raw rows with their ``fecha_ingesta``) into the state at ``path``; the buckets it touched.

    The result is that of :func:`silver.counted_unique` over all days together. ``rebuild`` starts from
    nothing and overwrites. At most ``buckets`` numbers, twice, and one date come to the driver. A task
    merges about ``ROWS_A_SLICE`` rows, however large a bucket is.
    """
    spark = new.sparkSession
    _, key = S.SOURCES[table]
    day = F.col(bronze.PARTITION_COL).cast("date")
    typed = silver.counted_types(new, table).withColumn(ROWS, F.lit(1).cast("long"))
    fresh = reliable_checkpoint(typed.select("*", bucket_of(key, buckets)))  # read twice: for its buckets and for its rows
    found = fresh.groupBy(BUCKET).agg(F.max(day).alias("d"), F.count(F.lit(1)).alias("n")).collect()
    if not found:
        return []
    touched, newest = sorted(r[BUCKET] for r in found), max(r["d"] for r in found)
    sums, most = [ROWS, FAILURES], Counter({r[BUCKET]: r["n"] for r in found})
    kept = None
    if exists(spark, path) and not rebuild:
        kept = touched_state(spark, path, touched)
        most.update({r[BUCKET]: r["count"] for r in kept.groupBy(BUCKET).count().collect()})  # from the footers
        until = kept.groupBy(BUCKET).agg(F.max(UNTIL).alias("_u"))  # a row a bucket
        fresh = fresh.join(F.broadcast(until), BUCKET, "left").where(F.col("_u").isNull() | (day > F.col("_u"))).drop("_u")
    slices = -(-max(most.values()) // ROWS_A_SLICE)
    # a hot key of the day is one row before it meets the state
    merged = dedupe_latest(fresh, [BUCKET, key], order_by, sums=sums)
    if kept is not None:
        merged = merged.unionByName(kept.drop(UNTIL), allowMissingColumns=True)
    merged = merged.withColumn(SLICE, slice_of(key, slices)).repartition(len(touched) * slices, BUCKET, SLICE)
    if kept is not None:
        merged = dedupe_latest(merged, [BUCKET, SLICE, key], order_by, sums=sums)
    merged = merged.drop(SLICE)
    out = reliable_checkpoint(merged.withColumn(UNTIL, F.lit(newest)))  # the folders it was read from are overwritten next
    mode = "static" if rebuild else "dynamic"
    out.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(BUCKET).parquet(path)
    return touched


def current(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The newest row of every key, typed, with ``_rows`` and ``_failures``: what silver takes for the raw table.

    No row where nothing has been merged yet.
    """
    if exists(spark, path):
        return spark.read.parquet(path).drop(BUCKET, UNTIL)
    counts = [T.StructField(c, T.LongType()) for c in (ROWS, FAILURES)]
    return spark.createDataFrame([], T.StructType([*S.SOURCES[table][0].fields, *counts]))


def refresh(
    spark: SparkSession,
    root: str,
    table: str,
    target: str | None = None,
    since=None,
    buckets: int = BUCKETS,
    order_by: Sequence[str] = (),
    rebuild: bool = False,
) -> DataFrame:
    """Merge the raw days of ``table`` from ``since`` on into its state below ``root``, and return the state.

    Without a state yet all days are merged, whatever ``since`` says.
    """
    path = state_path(root, table, buckets)
    first = rebuild or not exists(spark, path)
    contract, _ = S.SOURCES[table]
    new = bronze.read_days(spark, root, target or table, contract, None if first else since)
    merge_days(new, table, path, buckets, order_by, rebuild)
    return current(spark, table, path)
