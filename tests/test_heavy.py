"""Heavy hitters: found by the sketch, spread by the join, measured when silver is written."""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import functions as F

from almacen.operators import heavy
from almacen.operators.joins import salted_left_join


@contextlib.contextmanager
def plain_shuffles(spark):
    """Neither broadcasts nor AQE, so that a task's rows are those of its partition."""
    want = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def returns_of(spark, n=30_000):
    """30 % of the returns name sale 77, 2 % sale 5, 0.5 % sale 6, 5 % nothing; the others one each."""
    i = F.col("id")
    origin = (
        F.when(i % 100 < 30, F.lit(77)).when(i % 100 < 32, F.lit(5)).when(i % 200 == 199, F.lit(6))
        .when(i % 100 < 37, F.lit(None)).otherwise(i + 1000)
    )
    return spark.range(n).select(i.alias("id_devolucion"), origin.cast("long").alias("id_trans_origen"))


def test_the_sketch_finds_the_hot_keys_and_only_those(spark):
    found = heavy.measure(returns_of(spark), "id_trans_origen")
    assert set(found) == {77, 5} and found[77] == pytest.approx(0.3, abs=0.01)
    assert heavy.measure(returns_of(spark).where("false"), "id_trans_origen") == {}
    assert heavy.measure(returns_of(spark).where("id_trans_origen IS NULL"), "id_trans_origen") == {}


def test_the_sketch_rides_on_the_write(spark, tmp_path):
    watched, seen = heavy.watch(returns_of(spark), ["id_trans_origen"])
    watched.write.parquet(str(tmp_path / "returns"))
    assert set(heavy.shares(seen.get, "id_trans_origen")) == {77, 5} and seen.get["_all"] == 30_000


def test_a_hot_key_that_nobody_named_spreads_over_all_reducers(spark):
    returns = returns_of(spark)
    sales = spark.range(40_000).select(F.col("id").alias("v_id"), (F.col("id") * 3).alias("price"))
    hot = heavy.measure(returns, "id_trans_origen")
    with plain_shuffles(spark):
        plain = returns.join(sales, F.col("id_trans_origen") == F.col("v_id"), "left")
        salted = salted_left_join(returns, sales, "id_trans_origen", "v_id", ["id_devolucion"], salts=64, hot=hot)
        sizes = {
            name: sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
            for name, df in (("plain", plain), ("salted", salted))
        }
        on_77 = salted.where("id_trans_origen = 77").select(F.spark_partition_id().alias("p")).distinct().count()
        assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()
    reducers = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert on_77 == len(sizes["salted"]) == reducers
    assert sizes["plain"][-1] > 0.3 * 30_000 and sizes["salted"][-1] < 2 * 30_000 / reducers


def test_copies_follow_the_share(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    left = spark.createDataFrame([(i, i % 5) for i in range(200)], "id int, key int")
    out = salted_left_join(left, one, "key", "k", ["id"], salts=64, hot={1: 1.0, 2: 0.01})
    want = left.join(one, F.col("key") == F.col("k"), "left")
    assert want.exceptAll(out).isEmpty() and out.exceptAll(want).isEmpty()
    copies = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "sequence(1" in line]
    assert copies and all("64" in line and "2" in line for line in copies)


def test_silver_measures_and_gold_uses_the_hot_keys(spark, tmp_path):
    from almacen.plans.pipeline import HOT_TABLE, Store, hot_keys, run_medallion
    from almacen.queries import SALES_ORDER
    from almacen.sources.testdata import source_tables

    src = dict(source_tables(spark, "/root/testdata/sf0.001").items())
    returns = src["POST_DEVOLUCIONES"]
    sale = returns.where("id_trans_origen > 0").agg(F.min("id_trans_origen")).first()[0]
    hot = F.when(F.col("id_devolucion") % 3 == 0, F.lit(sale)).otherwise(F.col("id_trans_origen"))
    src["POST_DEVOLUCIONES"] = returns.withColumn("id_trans_origen", hot)
    store = Store(str(tmp_path))
    run_medallion(spark, src, str(tmp_path), order_by={"TRANS_VENTAS": SALES_ORDER}, now=dt.datetime(2024, 5, 1, 8), store=store)
    assert sale in hot_keys(spark, store, "post_devoluciones", "id_trans_origen")
    assert {r["tabla"] for r in store.read(spark, HOT_TABLE).collect()} <= {"post_devoluciones", "trans_ventas"}
    fact = store.read(spark, "fact_devoluciones")
    priced = store.read(spark, "post_devoluciones").join(
        store.read(spark, "trans_ventas").select(F.col("id_trans").alias("v"), "precio_unitario_venta"), F.col("id_trans_origen") == F.col("v"), "left"
    ).select("id_devolucion", F.coalesce(F.col("precio_unitario_venta").cast("double"), F.lit(0.0)).alias("p"))
    got = fact.select("id_devolucion", F.col("precio_original_venta").alias("p"))
    assert got.exceptAll(priced).isEmpty() and priced.exceptAll(got).isEmpty()
