import datetime as dt
import tempfile

from almacen.plans.pipeline import GOLD_TABLES, QUALITY_TABLE, REJECTS_TABLE, run_medallion
from almacen.queries import RETURNS_ORDER, SALES_ORDER
from almacen.sources.testdata import source_tables


def test_run_medallion_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="almacen-wh-")
    src = source_tables(spark, "/root/testdata/sf0.001")
    order = {"TRANS_VENTAS": SALES_ORDER, "POST_DEVOLUCIONES": RETURNS_ORDER}
    store = run_medallion(spark, src, root, order_by=order, now=dt.datetime(2024, 5, 1, 8, 0, 0))
    q = {r.table_name: r for r in store.read(spark, QUALITY_TABLE).collect()}
    assert len(q) == 7
    sales_q = q["TRANS_VENTAS"]
    accepted = store.read(spark, "trans_ventas").count()
    rejected = store.read(spark, REJECTS_TABLE).count()
    assert sales_q.accepted_records == accepted and sales_q.rejected_records == rejected
    assert accepted + rejected == sales_q.total_records - sales_q.duplicate_records
    for name in GOLD_TABLES:
        assert store.read(spark, name).count() > 0, name
    fact = store.read(spark, "fact_ventas")
    dim = store.read(spark, "dim_productos")
    assert fact.join(dim, fact.sk_producto == dim.sk_producto, "left_anti").count() == 0
    seg = store.read(spark, "fact_rfm_clientes")
    assert seg.groupBy("nombre_segmento").count().agg({"count": "sum"}).collect()[0][0] == seg.count()


def test_medallion_from_bronze(spark):
    """Two days of ingest: the newer rows win, and a failed load stops the run before silver."""
    import pytest
    from pyspark.sql import functions as F

    from almacen import schemas as S
    from almacen.sources import bronze

    src = dict(source_tables(spark, "/root/testdata/sf0.001").items())
    root = tempfile.mkdtemp(prefix="almacen-wh-")
    control = spark.createDataFrame(
        [(i, "dbo", t, "*", None, "bronze", t, 1) for i, t in enumerate(S.SOURCES, start=1)], S.CONTROL
    )
    audits = []
    day = dt.datetime(2024, 5, 1, 8, 0, 0)
    load = lambda ld: src[ld.source_table]
    store = run_medallion(spark, None, root, now=day, control=control, read_source=load, audit=audits.append)
    assert [a.collect()[0].Estado for a in audits] == [bronze.LOADED] * 7
    n = store.read(spark, "mstr_tiendas").count()
    smaller = src["MSTR_TIENDAS"].withColumn("metros_cuadrados", F.lit(1))
    src["MSTR_TIENDAS"] = smaller
    run_medallion(spark, None, root, now=day + dt.timedelta(days=1), control=control, read_source=load, store=store)
    assert [tuple(r) for r in store.read(spark, "mstr_tiendas").agg(F.count("*"), F.max("metros_cuadrados")).collect()] == [(n, 1.0)]
    q = store.read(spark, QUALITY_TABLE).where("table_name = 'MSTR_TIENDAS'").orderBy("execution_id").collect()
    assert [(r.total_records, r.duplicate_records) for r in q] == [(n, 0), (2 * n, n)]
    q = store.read(spark, QUALITY_TABLE).where("table_name = 'INV_STOCK_DIARIO'").agg(F.min("conversion_failures")).first()[0]
    assert q > 0

    def broken(ld):
        if ld.source_table == "CRM_MIEMBROS":
            raise OSError("source is down")
        return src[ld.source_table]

    before = store.read(spark, QUALITY_TABLE).count()
    with pytest.raises(bronze.LoadFailed, match="source is down"):
        run_medallion(spark, None, root, now=day + dt.timedelta(days=2), control=control, read_source=broken, store=store)
    assert store.read(spark, QUALITY_TABLE).count() == before


def test_bucketed_catalog_store_joins_without_shuffle(spark):
    from pyspark.sql import functions as F

    from almacen.plans.pipeline import Store, co_located

    store = Store("", as_path=False, buckets=co_located(4))
    sales = spark.range(100).select(F.col("id").alias("id_trans"), (F.col("id") * 2).alias("precio_unitario_venta"))
    rets = spark.range(0, 100, 3).select(F.col("id").alias("id_devolucion"), F.col("id").alias("id_trans_origen"))
    store.write(sales, "trans_ventas")
    store.write(rets, "post_devoluciones")
    v, d = store.read(spark, "trans_ventas"), store.read(spark, "post_devoluciones")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # large-table behaviour on tiny data
    try:
        joined = d.join(v, d.id_trans_origen == v.id_trans, "left")
        assert joined.count() == 34
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan


def test_run_medallion_catalog_store_with_buckets(spark):
    from almacen.plans.pipeline import Store, co_located

    src = source_tables(spark, "/root/testdata/sf0.001")
    order = {"TRANS_VENTAS": SALES_ORDER, "POST_DEVOLUCIONES": RETURNS_ORDER}
    store = Store("", as_path=False, buckets=co_located(4))
    run_medallion(spark, src, "", order_by=order, now=dt.datetime(2024, 5, 1, 8, 0, 0), store=store)
    assert spark.table("fact_devoluciones").count() == spark.table("post_devoluciones").count()
    assert spark.table("fact_rfm_clientes").count() > 0
    detail = spark.sql("DESCRIBE TABLE EXTENDED trans_ventas").collect()
    assert any(r.col_name == "Bucket Columns" and "id_trans" in r.data_type for r in detail)
