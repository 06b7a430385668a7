"""Shared helpers of the corpus operators: session settings, written intermediate tables, components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.session import checkpoint_dir

# Rows per Arrow batch between the JVM and Python. Texts can be long, so the
# default of 10,000 rows would not bound a batch's memory.
ARROW_ROWS = 256


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches for this session, unless the user chose a size."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(ARROW_ROWS))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/almacen-llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts the lineage in a compact form that outlives lost executors. The folder
    belongs to the run; whoever owns ``spark.checkpoint.dir`` empties it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, null texts as empty ones; every other column stays out of the shuffles."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, comp), comp the least node reached.

    Alternating large-star and small-star rounds: each round hooks a node's
    neighbours to the least of them, so a hub's list is only ever reduced by a
    minimum (partial aggregation) and joined back (skew-split by AQE), never
    gathered. Every round is a written table; the loop ends when each node has
    one edge, to a node that has none itself: then every component is a star around its
    least node. Self loops and repeated edges are harmless; no edges, no rows.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def stars(e: DataFrame) -> bool:
        ends = e.select("a", F.lit(1).alias("own")).unionByName(e.select(F.col("b").alias("a"), F.lit(0).alias("own")))
        met = ends.groupBy("a").agg(F.sum("own").alias("own"), F.count(F.lit(1)).alias("all"))
        return met.where("own > 1 OR (own = 1 AND all > 1)").isEmpty()

    cur = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    cur = materialize(cur, "cc")
    while not stars(cur):
        # large star: larger neighbours of u point to the least of u and its neighbours
        two = both(cur)
        low = two.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = two.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large, "cc")
        if stars(large):
            cur = large
            break
        # small star: smaller neighbours of u, and u, point to the least of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = materialize(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "cc")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    )
