"""Exact ``ntile`` over a global order, computed on all executors.

``F.ntile(k).over(Window.orderBy(v))`` moves every row into one task. Here the
rows are dealt out by ranges of the order and sorted within them, which is a distributed sort:

1. ``repartitionByRange`` by (value, tie key), ``sortWithinPartitions``. The ranges come
   from a bounded sample and are only more or less even; a value that very many rows share is
   split by its tie keys;
2. ``monotonically_increasing_id`` of the sorted rows is the partition (upper bits) and the
   place in it (lower 33 bits), so the position costs no window. The frame is written
   (a reliable checkpoint), as ranges drawn again would not be the same;
3. rows per partition and their running sums: one row a partition, broadcast back;
4. ``rn = rows before the partition + place + 1``;
5. with ``q = n div k``, ``r = n mod k``: the first ``r`` tiles hold ``q + 1`` rows.

What is carried by a row or broadcast does not depend on the number of tiles, and grows only as
the number of partitions: one row each. Ties in the value are ordered by the tie
key ascending, nulls first; null values come first for an ascending order and last for a
descending one (Spark's defaults).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almacen.functions.columns import whole_div
from almacen.session import reliable_checkpoint

PLACE_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def exact_div(a: Column, b: Column) -> Column:
    """floor(a / b) for a >= 0, b > 0, in integer arithmetic (SQL ``div``)."""
    return whole_div(a, b)


def tile_of(rn: Column, n: Column, k: int) -> Column:
    """ntile(k) of 1-based position ``rn`` among ``n`` rows."""
    kk = F.lit(k).cast("long")
    q = exact_div(n, kk)
    r = F.pmod(n, kk)
    big = r * (q + 1)
    first = exact_div(rn - 1, q + 1) + 1
    second = r + exact_div(rn - 1 - big, F.greatest(q, F.lit(1).cast("long"))) + 1
    return F.when(rn <= big, first).otherwise(second).cast("int")


def sort_order(order_col: str, ascending: bool, tie_key: str) -> list[Column]:
    v = F.col(order_col)
    return [v.asc_nulls_first() if ascending else v.desc_nulls_last(), F.col(tie_key).asc_nulls_first()]


def positions(df: DataFrame, order: list[Column], partitions: int, materialize=None) -> DataFrame:
    """``df`` plus ``_rn``, the 1-based position in the global ``order``, and ``_n``, the number of rows.

    ``materialize`` (default: a reliable checkpoint) fixes the sorted ranges; both readings
    of the result, counts and rows, must see the same ones.
    """
    ranged = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    placed = (materialize or reliable_checkpoint)(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", PLACE_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", before.alias("_off"), F.sum("_c").over(Window.partitionBy()).alias("_n"))
    out = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # at most ``partitions`` rows
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return out.withColumn("_rn", F.col("_off") + place + 1).select(*[F.col(c) for c in df.columns], "_rn", "_n")


def ntiles_exact(
    df: DataFrame,
    k: int,
    specs: list[tuple[str, bool, str]],
    tie_key: str,
    partitions: int | None = None,
    materialize=None,
) -> DataFrame:
    """``df`` plus one ntile(k) column per ``(order_col, ascending, out)`` spec.

    Each tile is over (order by order_col [asc|desc], tie_key asc nulls first). ``df`` is
    written once by ``materialize`` (default: a reliable checkpoint), as the ranges are drawn from a
    reading of their own, and so is each sorted form of it. ``partitions`` defaults to
    the session's shuffle partitions. ``tie_key`` should be unique for a fully defined result.
    """
    write = materialize or reliable_checkpoint
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = write(df)
    for order_col, ascending, name in specs:
        placed = positions(out, sort_order(order_col, ascending, tie_key), n, write)
        out = placed.withColumn(name, tile_of(F.col("_rn"), F.col("_n"), k)).drop("_rn", "_n")
    return out


def ntile_exact(
    df: DataFrame, k: int, order_col: str, tie_key: str, out: str, ascending: bool = True, partitions: int | None = None
) -> DataFrame:
    """``df`` plus ``out`` = ntile(k) over (order by order_col [asc|desc], tie_key asc nulls first)."""
    return ntiles_exact(df, k, [(order_col, ascending, out)], tie_key, partitions)


def ntile_single_task(df: DataFrame, k: int, order_col: str, tie_key: str, out: str, ascending: bool = True):
    """Spark's own global-window ntile (one task); for tests and small inputs."""
    return df.withColumn(out, F.ntile(k).over(Window.orderBy(*sort_order(order_col, ascending, tie_key))))
