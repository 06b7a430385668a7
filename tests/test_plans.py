"""Plan-shape guards: the properties the design relies on at scale."""

import re
import time
import uuid

from almacen.queries import QUERIES
from tools.plan_report import summary

SF = "/root/testdata/sf0.001"


def test_no_python_udfs_in_any_query(spark):
    for name, build in QUERIES.items():
        assert summary(build(spark, SF))["python_udfs"] == 0, name


def test_tiles_are_range_exchanges_at_20000_partitions(spark):
    """The plan of the three tiles, nothing written: no cut arrays, no window over rows, one small row a partition broadcast."""
    from almacen.plans.rfm import rfm_scores

    base = spark.createDataFrame([(1, 2, 3, 4.5)], "id_miembro int, recency_dias int, frequency_trans long, monetary_val double")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20000")
    try:
        start = time.time()
        plan = rfm_scores(base, materialize=lambda df: df)._jdf.queryExecution().executedPlan().toString()
        took = time.time() - start
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    ranges = re.findall(r"rangepartitioning\((\w+)#\d+[^)]*, 20000\)", plan)
    assert {"recency_dias", "frequency_trans", "monetary_val"} == set(ranges)
    assert "percentile" not in plan and "row_number" not in plan and "array" not in plan
    assert took < 30 and max(map(len, plan.splitlines())) < 2000
    # every window runs over one row a partition: its only input is an aggregate by partition number
    assert all("_part#" in line or "_c#" in line for line in plan.splitlines() if "Window [" in line)


def jobs(spark, work):
    """Ids of the jobs that ``work`` starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"watch-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        work()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return list(tracker.getJobIdsForGroup(group))


def test_building_a_query_starts_no_job_but_schema_reads_and_the_rfm_tables(spark):
    for name, build in QUERIES.items():
        if name.startswith(("rfm_", "view_rfm", "bronze_", "join_", "incremental_")):  # written tables, the control table, the sketch
            continue
        schemas = 8  # one footer read for each given table at most
        assert len(jobs(spark, lambda b=build: b(spark, SF))) <= schemas, name


def test_plans_have_the_same_shape_at_every_scale(spark):
    shape = lambda name, sf: {k: v for k, v in summary(QUERIES[name](spark, sf)).items() if k != "pushed_filters"}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("silver_ri_accepted", "fact_sales", "fact_inventory", "view_daily_sales"):
            assert shape(name, "/root/testdata/sf0.01") == shape(name, "/root/testdata/sf0.1"), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_results_do_not_depend_on_broadcasts(spark):
    from tests.oracle_check import compare

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        names = ["silver_ri_accepted", "silver_ri_rejected", "fact_sales", "fact_returns", "rfm_segments", "dim_products"]
        got = compare(spark, SF, names, verbose=False)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert all(v[0] == "ok" for v in got.values()), got


def test_rfm_base_reads_the_sales_once(spark):
    plan = QUERIES["rfm_scores"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in plan and plan.count("BroadcastNestedLoopJoin") <= 1


def test_dedupe_combines_before_the_shuffle(spark):
    plan = QUERIES["silver_dedupe_latest"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and plan.count("Exchange hashpartitioning") == 1


def test_consumption_is_shuffled_twice_for_the_inventory(spark):
    """Once to add up days (article, store, day), once for the layout on which windows and snapshots meet."""
    from almacen.plans.facts import daily_consumption, fact_inventory_of_days

    keys = "int(id % 7) AS art_id", "int(id % 3) AS id_tienda"
    sales = spark.range(50).selectExpr(*keys, "date_add(DATE '2024-01-01', int(id % 20)) AS fec_trans", "1 AS qty_vendida")
    counts = [f"int(id) AS {c}" for c in ("stock_fisico", "stock_transito", "stock_reservado", "stock_minimo_config")]
    stock = spark.range(50).selectExpr("id AS id_snapshot", *keys, "date_add(DATE '2024-01-01', int(id % 20)) AS fec_snapshot", *counts)
    plan = fact_inventory_of_days(stock, daily_consumption(sales))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
