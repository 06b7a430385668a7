"""Sinks and readers: managed tables / paths, audit appends, JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
    as_path: bool = False,
) -> None:
    """Write a frame as a catalog table (``saveAsTable``) or to a path.

    ``overwriteSchema`` is passed for formats that honour it (the reference's
    sink); ``bucket_by=(n, keys)`` stores the table bucketed so later joins and
    aggregations on ``keys`` read it co-partitioned (catalog tables only).
    """
    w = df.write.format(fmt).mode(mode)
    if mode == "overwrite":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if as_path:
        w.save(target)
        return
    if bucket_by is not None:
        n, keys = bucket_by
        w = w.bucketBy(n, *keys).sortBy(*keys)
    w.saveAsTable(target)


def read_table(spark: SparkSession, target: str, fmt: str = "parquet", as_path: bool = False) -> DataFrame:
    """A stored table by catalog name or path."""
    return spark.read.format(fmt).load(target) if as_path else spark.table(target)


def append_rows(df: DataFrame, target: str, fmt: str = "parquet", as_path: bool = False) -> None:
    """Append audit rows (quality metrics, rejects, load audit)."""
    write_table(df, target, mode="append", fmt=fmt, as_path=as_path)


def put_rows(df: DataFrame, target: str, keys: Sequence[str], fmt: str = "parquet", as_path: bool = False) -> None:
    """Audit rows kept by ``keys`` (run, table): a run that is repeated replaces its own rows.

    The keys are the table's partitions and only those of ``df`` are overwritten, so
    a row is never there twice, and other runs are not touched. No rows, no change.
    """
    spark = df.sparkSession
    keys = list(keys)
    if as_path:
        df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).save(target)
    elif not spark.catalog.tableExists(target):
        df.write.format(fmt).partitionBy(*keys).saveAsTable(target)
    else:
        setting = "spark.sql.sources.partitionOverwriteMode"
        old = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            df.select(*spark.table(target).columns).write.insertInto(target, overwrite=True)
        finally:
            spark.conf.set(setting, old)


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 20000, properties: dict | None = None
) -> None:
    """Append a frame to a database table in batches, one connection per partition."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batchsize)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    partition: tuple[str, int, int, int] | None = None,
    properties: dict | None = None,
) -> DataFrame:
    """Read a source table or query over JDBC.

    ``partition=(column, lower, upper, n)`` splits a table read into ``n``
    parallel range queries on a numeric column (not available with ``query``).
    """
    r = spark.read.format("jdbc").option("url", url)
    if query is not None:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", table)
        if partition is not None:
            col, lo, hi, n = partition
            r = (r.option("partitionColumn", col).option("lowerBound", lo)
                 .option("upperBound", hi).option("numPartitions", n))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()


def plan_split(
    spark: SparkSession, url: str, table: str, column: str, rows_per_slice: int = 1_000_000, most: int = 200, properties: dict | None = None
) -> list[str]:
    """Conditions that split a source table by an integer column into slices that don't overlap and leave nothing out.

    The source is asked once for its row count and the column's bounds; as many slices as the rows need, at most
    ``most`` (the connections the source can bear). Rows without the column's value are a slice of their own. A table
    of no rows, or one slice, is read whole.
    """
    sql = f"SELECT COUNT(*) AS N, COUNT({column}) AS K, MIN({column}) AS LO, MAX({column}) AS HI FROM {table}"
    n, named, lo, hi = read_jdbc(spark, url, query=sql, properties=properties).first()
    slices = min(most, -(-named // rows_per_slice), int(hi) - int(lo) + 1) if named else 0
    if slices + (n > named) <= 1:
        return []
    cuts = [int(lo) + (int(hi) + 1 - int(lo)) * i // slices for i in range(1, slices)]
    ends = [None, *cuts, None]
    parts = [(f"{column} >= {a}" if a is not None else "", f"{column} < {b}" if b is not None else "") for a, b in zip(ends, ends[1:], strict=False)]
    out = [" AND ".join(c for c in part if c) or f"{column} IS NOT NULL" for part in parts]
    return out + [f"{column} IS NULL"] * (n > named)


def read_jdbc_split(
    spark: SparkSession, url: str, table: str, column: str, rows_per_slice: int = 1_000_000, most: int = 200, properties: dict | None = None
) -> DataFrame:
    """A whole source table, one task and connection a slice of :func:`plan_split`."""
    slices = plan_split(spark, url, table, column, rows_per_slice, most, properties)
    if not slices:
        return read_jdbc(spark, url, table=table, properties=properties)
    return spark.read.jdbc(url, table, predicates=slices, properties=properties or {})
