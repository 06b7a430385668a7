from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from almacen.operators.ntile import ntile_exact, ntile_single_task, ntiles_exact, positions, sort_order


def _compare(spark, data, k, partitions=5):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id int, v int")
    for asc in (True, False):
        got = ntile_exact(df, k, "v", "id", "t", asc, partitions)
        ref = ntile_single_task(df, k, "v", "id", "t", asc).select("id", F.col("t").alias("e"))
        bad = got.join(ref, "id").filter("t <> e").count()
        assert bad == 0 and got.count() == len(data)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(0, 6), st.integers(-1000, 1000)), max_size=120), st.integers(1, 7))
def test_ntile_matches_single_task_window(spark, data, k):
    _compare(spark, data, k)


def test_ntile_heavy_tie_and_small_n(spark):
    _compare(spark, [2] * 300 + list(range(50)) + [None] * 40, 5)
    for n in (0, 1, 3, 7):
        _compare(spark, list(range(n)), 5)


def test_many_more_partitions_than_rows(spark):
    _compare(spark, [3, 1, None, 3, 2], 3, partitions=60)


def test_one_value_in_all_rows_is_spread_by_the_tie_key(spark):
    df = spark.range(20_000).select(F.col("id").cast("int").alias("id"), F.lit(1).alias("v"))
    placed = positions(df, sort_order("v", True, "id"), 8).groupBy(F.spark_partition_id().alias("p")).count()
    sizes = [r["count"] for r in placed.collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8


def test_positions_of_texts_and_dates(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate("hgfabcde")], "id int, v string")
    out = positions(df, sort_order("v", False, "id"), 3).orderBy("_rn").collect()
    assert "".join(r["v"] for r in out) == "hgfedcba" and [r["_rn"] for r in out] == list(range(1, 9)) and out[0]["_n"] == 8


def test_several_tiles(spark):
    df = spark.createDataFrame([(i, i % 4, (i * 7) % 11) for i in range(97)], "id int, a int, b int")
    out = ntiles_exact(df, 5, [("a", False, "ta"), ("b", True, "tb")], "id")
    ea = ntile_single_task(df, 5, "a", "id", "ea", False)
    eb = ntile_single_task(ea, 5, "b", "id", "eb", True)
    assert out.join(eb, ["id", "a", "b"]).filter("ta <> ea or tb <> eb").count() == 0
