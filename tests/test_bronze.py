import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from almacen import schemas as S
from almacen.sources import bronze
from almacen.sources.sinks import plan_split, read_jdbc, read_jdbc_split, write_jdbc
from almacen.sources.testdata import source_tables

SF = "/root/testdata/sf0.001"
RUN = bronze.RunInfo("RUN1", dt.datetime(2024, 5, 1, 12, 0, 0))


def test_active_loads_and_extract(spark):
    control = bronze.example_control(spark)
    loads = bronze.collect_loads(bronze.active_loads(control))
    assert [ld.source_table for ld in loads] == [t for t in S.SOURCES if t != "POST_DEVOLUCIONES"]
    src = source_tables(spark, SF)
    sales_load = next(ld for ld in loads if ld.source_table == "TRANS_VENTAS")
    out = bronze.extract(src["TRANS_VENTAS"], sales_load, RUN)
    assert out.columns[-3:] == ["FechaIngesta", "SistemaFuente", "IdLote"]
    assert out.filter(F.col("canal_venta") != "Online").count() == 0 and out.count() > 0
    no_filter = bronze.Load(1, "dbo", "T", "*", "  ", "b", "T")
    assert bronze.extract(src["MSTR_TIENDAS"], no_filter, RUN).count() == src["MSTR_TIENDAS"].count()


def test_orders_meet_customers_before_the_lines(spark):
    for table in ("TRANS_VENTAS", "INV_STOCK_DIARIO"):
        plan = source_tables(spark, SF)[table]._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join Inner" in line]
        assert "l_orderkey" in joins[0] and "c_custkey" in joins[1], table  # the lines are in one join, so they move once


def test_load_all_writes_days_and_audits_failures(spark):
    root = tempfile.mkdtemp(prefix="almacen-bronze-")
    src = source_tables(spark, SF)
    control = bronze.example_control(spark, ["MSTR_TIENDAS", "MSTR_PROVEEDORES"]).union(
        spark.createDataFrame([(9, "dbo", "NO_EXISTE", "*", None, "b", "NO_EXISTE", 1)], S.CONTROL)
    )
    audits = []

    def read_source(load):
        return src[load.source_table]

    with pytest.raises(bronze.LoadFailed, match="NO_EXISTE") as failed:  # after the other loads
        bronze.load_all(spark, control, read_source, root, RUN, dt.date(2024, 5, 1), audits.append)
    status = {ld.source_table: (st, n) for ld, st, n, _ in failed.value.results}
    assert status["MSTR_TIENDAS"] == ("SATISFACTORIO", 25)
    assert status["MSTR_PROVEEDORES"][0] == "SATISFACTORIO" and status["NO_EXISTE"][0] == "FALLA"
    assert len(audits) == 3 and audits[-1].collect()[0].Estado == "FALLA"
    bronze.write_raw(src["MSTR_TIENDAS"], root, "MSTR_TIENDAS", dt.date(2024, 5, 2))
    both = bronze.read_raw(spark, root, "MSTR_TIENDAS")
    assert both.count() == 50
    assert bronze.read_raw(spark, root, "MSTR_TIENDAS", since=dt.date(2024, 5, 2)).count() == 25


def test_failed_load_keeps_its_whole_error(spark):
    text = "e" * 10_000

    def read_source(load):
        raise ValueError(text)

    control = bronze.example_control(spark, ["MSTR_TIENDAS"])
    audits = []
    with pytest.raises(bronze.LoadFailed):
        bronze.load_all(spark, control, read_source, "/nowhere", RUN, dt.date(2024, 5, 1), audits.append)
    assert audits[0].collect()[0].MensajeError == text


def test_days_are_merged_by_schema(spark):
    root = tempfile.mkdtemp(prefix="almacen-bronze-")
    one = spark.createDataFrame([(1,)], "id_tienda int")
    bronze.write_raw(one, root, "T", dt.date(2024, 5, 1))
    bronze.write_raw(one.withColumn("nuevo", F.lit("x")), root, "T", dt.date(2024, 5, 2))
    assert sorted(str(r.nuevo) for r in bronze.read_raw(spark, root, "T").collect()) == ["None", "x"]


def test_jdbc_round_trip_embedded_derby(spark):
    url = "jdbc:derby:memory:almacen_test;create=true"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    write_jdbc(df, url, "T_PRUEBA", mode="overwrite", batchsize=1,
               properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    back = read_jdbc(spark, url, table="T_PRUEBA", partition=("id", 1, 3, 2), properties=props)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b")]
    q = read_jdbc(spark, url, query='SELECT "name" FROM T_PRUEBA WHERE "id" = 2', properties=props)
    assert [r[0] for r in q.collect()] == ["b"]


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_a_source_table_is_read_in_slices_that_leave_nothing_out(spark):
    url = "jdbc:derby:memory:almacen_split;create=true"
    rows = [(i * 3 - 50, f"n{i}", 10.0 * i, 1) for i in range(100)] + [(None, "sin id", 1.0, 1)] * 4
    stores = spark.createDataFrame(rows, "id_tienda int, nom_tienda string, metros double, activo int")
    write_jdbc(stores, url, "MSTR_TIENDAS", mode="overwrite", properties=DERBY)
    slices = plan_split(spark, url, "MSTR_TIENDAS", '"id_tienda"', rows_per_slice=30, properties=DERBY)
    assert len(slices) == 4 + 1 and slices[-1].endswith("IS NULL")
    each = [stores.where(c.replace('"', "")).count() for c in slices]
    assert sum(each) == 104 and max(each) <= 30  # no overlap, nulls included
    assert len(plan_split(spark, url, "MSTR_TIENDAS", '"id_tienda"', 10, most=3, properties=DERBY)) == 3 + 1
    control = spark.createDataFrame([(1, "", "MSTR_TIENDAS", "id_tienda, metros", "metros < 500", "b", "MSTR_TIENDAS", 1)], S.CONTROL)
    (load,) = bronze.collect_loads(bronze.active_loads(control))
    df = bronze.extract(bronze.jdbc_source(spark, url, 30, properties=DERBY)(load), load, RUN)
    assert df.rdd.getNumPartitions() == 5
    assert sorted(str(r[0]) for r in df.collect()) == sorted(str(r[0]) for r in stores.where("metros < 500").collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(metros,500.0)" in plan and "nom_tienda" not in plan


def test_empty_and_small_source_tables_are_read_whole(spark):
    url = "jdbc:derby:memory:almacen_split2;create=true"
    for n in (0, 1):
        write_jdbc(spark.createDataFrame([(5, "x")] * n, "k int, v string"), url, "POCO", mode="overwrite", properties=DERBY)
        assert plan_split(spark, url, "POCO", '"k"', properties=DERBY) == []
        assert read_jdbc_split(spark, url, "POCO", '"k"', properties=DERBY).count() == n
    write_jdbc(spark.createDataFrame([(None, "x")] * 3, "k int, v string"), url, "NULOS", mode="overwrite", properties=DERBY)
    assert read_jdbc_split(spark, url, "NULOS", '"k"', properties=DERBY).count() == 3


def test_raw_stream_available_now(spark):
    from almacen.streaming import typed_increments

    root = tempfile.mkdtemp(prefix="almacen-stream-")
    src = source_tables(spark, SF)
    bronze.write_raw(src["MSTR_TIENDAS"], root, "MSTR_TIENDAS", dt.date(2024, 5, 1))
    with pytest.raises(ValueError, match="checkpoint"):
        typed_increments(spark, root, "MSTR_TIENDAS", S.STORES, print, checkpoint="")
    seen = []
    typed_increments(spark, root, "MSTR_TIENDAS", S.STORES, lambda df, i: seen.append(df.count()),
                     checkpoint=f"{root}/progress")
    assert sum(seen) == 25
    bronze.write_raw(src["MSTR_TIENDAS"], root, "MSTR_TIENDAS", dt.date(2024, 5, 2))
    typed_increments(spark, root, "MSTR_TIENDAS", S.STORES, lambda df, i: seen.append(df.count()),
                     checkpoint=f"{root}/progress")
    assert sum(seen) == 50  # the second run reads only the new day


def test_catalog_tables_overwrite_append_and_buckets(spark):
    from almacen.sources.sinks import append_rows, read_table, write_table

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id_trans long, v string")
    write_table(df, "t_ventas_prueba", bucket_by=(4, ["id_trans"]))
    write_table(df.limit(1), "t_ventas_prueba", bucket_by=(4, ["id_trans"]))  # overwrite
    assert read_table(spark, "t_ventas_prueba").count() == 1
    append_rows(df, "t_audit_prueba")
    append_rows(df, "t_audit_prueba")
    assert read_table(spark, "t_audit_prueba").count() == 6
    # bucketed on the join key: an aggregate by that key needs no shuffle of the table
    plan = read_table(spark, "t_ventas_prueba").groupBy("id_trans").count()._jdf.queryExecution().executedPlan()
    assert "Exchange hashpartitioning" not in plan.toString()
