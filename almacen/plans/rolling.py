"""Rolling RFM base: a day of sales is added, the days that leave the window are taken off.

Two tables below one folder:

* ``dias``: transactions and net amount per member and sale day, one folder for each sale day and batch
  (``fec_trans=``, ``lote=``), so that the days that leave the window are found by a partition filter;
* ``base``: the window's totals per member with the last sale day and the reference date, one version a batch
  (``lote=``).

A batch reads its own sales, the last version of the base and the days that expire: not the
history. The reference date is the newest sale day so far (or a given date) and is
carried by the base; it never comes from the clock. Each batch starts from the version before it, so a
batch that is repeated gives the same tables. Batch names sort in the order of the batches
(ISO days do). Sales may come late: those inside the window are added, older ones no longer count.

Totals can be taken off again, a last day can't: members with a retracted sale (one that a newer
ingest has replaced) are counted anew from their stored days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.plans.incremental import exists
from almacen.plans.rfm import member_days
from almacen.session import reliable_checkpoint

BATCH, DAY, LAST, REF = "lote", "fec_trans", "ultima", "fec_ref"


STORED = f"id_miembro int, trans long, total decimal(38,2), {DAY} date, {BATCH} string"
VERSION = f"id_miembro int, {LAST} date, trans long, total decimal(38,2), {REF} date"
MONEY = "decimal(38,2)"


def stored_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(f"{path}/dias")


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches that have a version of the base, in order; from the listing."""
    if not exists(spark, f"{path}/base"):
        return []
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/base")
    names = [f.getPath().getName() for f in top.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(top)]
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{BATCH}="))


def version(spark: SparkSession, path: str, batch: str) -> DataFrame:
    """One version: id_miembro, ultima, trans, total, fec_ref."""
    return spark.read.schema(VERSION).parquet(f"{path}/base/{BATCH}={batch}")


def between(days: DataFrame, batch: str, start: dt.date, stop: dt.date) -> DataFrame:
    """Stored days of earlier batches in [start, stop); both conditions prune folders."""
    return days.where((F.col(DAY) >= F.lit(start)) & (F.col(DAY) < F.lit(stop)) & (F.col(BATCH) < batch))


def _moves(days: DataFrame, sign: int) -> DataFrame:
    """Days that enter the window (1) or leave it (-1), as changes of the totals."""
    last = F.col(DAY) if sign > 0 else F.lit(None).cast("date")
    return days.select("id_miembro", last.alias(LAST), (sign * F.col("trans")).alias("trans"), (sign * F.col("total")).cast(MONEY).alias("total"))


def advance(
    spark: SparkSession,
    path: str,
    sales: DataFrame,
    batch: str,
    days: int = 90,
    as_of: dt.date | None = None,
    retracted: DataFrame | None = None,
) -> dt.date | None:
    """Take one batch of accepted sales (unique by ``id_trans``) into the tables at ``path``; the reference date.

    ``retracted`` holds the former rows of sales that this batch replaces. Nothing but dates comes to the driver.
    """
    part = member_days(sales)
    if retracted is not None:
        off = member_days(retracted).select("id_miembro", DAY, (-F.col("trans")).alias("trans"), (-F.col("total")).alias("total"))
        part = part.unionByName(off).groupBy("id_miembro", DAY).agg(F.sum("trans").alias("trans"), F.sum("total").alias("total"))
    part = reliable_checkpoint(part.select("id_miembro", "trans", F.col("total").cast(MONEY).alias("total"), DAY))
    newest = part.where("trans > 0").agg(F.max(DAY)).first()[0]
    before = [v for v in versions(spark, path) if v < batch]
    old = version(spark, path, before[-1]) if before else None
    past = old.agg(F.max(REF)).first()[0] if before else None
    ref = as_of or max((d for d in (newest, past) if d is not None), default=None)
    if ref is None:  # no sale so far
        return None
    if past is not None and ref < past:
        raise ValueError(f"reference date {ref} is before that of the last batch, {past}")
    one = dt.timedelta(days=1)
    start, stop = ref - days * one, ref + one
    # days before the window can't come into it again; a day is one file, as it has at most a row a member
    keep = part.where(F.col(DAY) >= F.lit(start)).withColumn(BATCH, F.lit(batch)).repartition(DAY)
    keep.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(f"{path}/dias")
    stored = stored_days(spark, path)

    moves = _moves(stored.where((F.col(BATCH) == batch) & (F.col(DAY) >= F.lit(start)) & (F.col(DAY) < F.lit(stop))), 1)
    if past is None:
        moves = moves.unionByName(_moves(between(stored, batch, start, stop), 1))
    else:
        moves = moves.unionByName(old.select("id_miembro", LAST, "trans", "total"))
        if start > past - days * one:
            moves = moves.unionByName(_moves(between(stored, batch, past - days * one, start), -1))
            moves = moves.unionByName(_moves(between(stored, batch, past + one, stop), 1))  # none, unless as_of lags behind
    totals = moves.groupBy("id_miembro").agg(F.max(LAST).alias(LAST), F.sum("trans").alias("trans"), F.sum("total").alias("total"))
    if retracted is not None:
        anew = retracted.select(F.col("id_miembro").alias("_m")).distinct().alias("r")
        same = F.expr("id_miembro <=> r._m")
        window = stored.where((F.col(DAY) >= F.lit(start)) & (F.col(DAY) < F.lit(stop)) & (F.col(BATCH) <= batch)).join(anew, same, "left_semi")
        net = window.groupBy("id_miembro", DAY).agg(F.sum("trans").alias("trans"), F.sum("total").alias("total")).where("trans > 0")
        again = net.groupBy("id_miembro").agg(F.max(DAY).alias(LAST), F.sum("trans").alias("trans"), F.sum("total").alias("total"))
        totals = totals.join(anew, same, "left_anti").unionByName(again)
    left = totals.where(F.col("trans") > 0).withColumn("total", F.col("total").cast(MONEY)).withColumn(REF, F.lit(ref))
    left.write.mode("overwrite").parquet(f"{path}/base/{BATCH}={batch}")
    return ref


def rolled_base(spark: SparkSession, path: str, with_ref: bool = False) -> DataFrame:
    """The newest version in the columns of :func:`almacen.plans.rfm.rfm_base`."""
    found = versions(spark, path)
    if not found:
        empty = "id_miembro int, recency_dias int, frequency_trans long, monetary_val decimal(38,2)"
        return spark.createDataFrame([], empty + (", fec_calculo_rfm date" if with_ref else ""))
    base = version(spark, path, found[-1])
    cols = ["id_miembro", F.datediff(REF, LAST).alias("recency_dias"), F.col("trans").alias("frequency_trans"), F.col("total").alias("monetary_val")]
    return base.select(*cols, *([F.col(REF).alias("fec_calculo_rfm")] if with_ref else []))
