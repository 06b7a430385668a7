"""Raw day folders as a file stream (I9, incremental form)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from almacen.operators.contract import apply_contract
from almacen.sources.bronze import PARTITION_COL, raw_path


def raw_stream(spark: SparkSession, root: str, table: str, schema: T.StructType, max_files: int = 1000) -> DataFrame:
    """Streaming frame over ``raw/<table>/fecha_ingesta=*/``; files are read once each.

    File streams need the schema up front: the contract plus the day column.
    """
    full = T.StructType([*schema.fields, T.StructField(PARTITION_COL, T.DateType(), True)])
    return (
        spark.readStream.schema(full)
        .option("maxFilesPerTrigger", max_files)
        .parquet(raw_path(root, table))
    )


def typed_increments(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> None:
    """Process every raw file not seen before, then stop (``availableNow``).

    Each micro-batch is typed by the contract and passed to ``handle(df,
    batch_id)``; progress is kept in ``checkpoint``, a folder of this stream on
    shared storage that outlives the session, so a rerun (or a restart after a
    lost driver) continues where it stopped.
    """
    if not checkpoint:
        raise ValueError("a lasting checkpoint folder is needed: without it every run reads all days again")
    query = (
        raw_stream(spark, root, table, schema)
        .transform(lambda df: apply_contract(df, schema))
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()
