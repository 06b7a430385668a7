"""Days by contract, the kept state of silver, and audit rows that a repeated run replaces."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from almacen import schemas as S
from almacen.config import FAILURES, ROWS
from almacen.plans import incremental, silver
from almacen.sources import bronze
from almacen.sources.sinks import put_rows
from almacen.sources.testdata import source_tables
from tests.test_plans import jobs

SF = "/root/testdata/sf0.001"
D1, D2, D3 = dt.date(2024, 5, 1), dt.date(2024, 5, 2), dt.date(2024, 5, 3)
STORE = "id_tienda int, nom_tienda string, metros_cuadrados int, FechaIngesta timestamp"


def stores(spark, rows, day):
    at = dt.datetime(day.year, day.month, day.day, 8)
    return spark.createDataFrame([(i, n, m, at) for i, n, m in rows], STORE)


def write(spark, root, rows, day, change=lambda df: df):
    bronze.write_raw(change(stores(spark, rows, day)), root, "MSTR_TIENDAS", day)


def test_a_column_that_changes_type_comes_and_goes(spark, tmp_path):
    root = str(tmp_path)
    write(spark, root, [(1, "a", 10), (2, "b", None)], D1)
    text = lambda df: df.withColumn("metros_cuadrados", F.when(F.col("id_tienda") == 3, "x9").otherwise("70")).withColumn("nuevo", F.lit(5))
    write(spark, root, [(3, "c", 0), (4, "d", 0)], D2, text)
    write(spark, root, [(5, "e", 7)], D3, lambda df: df.drop("nom_tienda").withColumn("nuevo", F.lit("z")))
    got = {r["id_tienda"]: r for r in bronze.read_days(spark, root, "MSTR_TIENDAS", S.STORES).collect()}
    assert {i: r["metros_cuadrados"] for i, r in got.items()} == {1: 10, 2: None, 3: None, 4: 70, 5: 7}
    assert {i: r[FAILURES] for i, r in got.items()} == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0}
    assert {i: r["nuevo"] for i, r in got.items()} == {1: None, 2: None, 3: "5", 4: "5", 5: "z"}
    assert got[5]["nom_tienda"] is None and got[5][bronze.PARTITION_COL] == D3 and got[1]["FechaIngesta"].day == 1
    since = bronze.read_days(spark, root, "MSTR_TIENDAS", S.STORES, D3)
    assert since.count() == 1 and all(str(D3) in f for f in since.inputFiles())
    assert bronze.read_days(spark, root, "NO_EXISTE", S.STORES).count() == 0


def test_one_footer_a_day_is_read_and_equal_days_share_a_scan(spark, tmp_path):
    root = str(tmp_path)
    for day in (D1, D2, D3):
        bronze.write_raw(stores(spark, [(i, "a", i) for i in range(40)], day).repartition(6), root, "MSTR_TIENDAS", day)
    found = []
    started = jobs(spark, lambda: found.append(bronze.read_days(spark, root, "MSTR_TIENDAS", S.STORES)))
    assert len(started) <= 3  # one file each
    tracker = spark.sparkContext.statusTracker()
    assert all(tracker.getStageInfo(s).numTasks == 1 for j in started for s in tracker.getJobInfo(j).stageIds)
    plan = found[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and found[0].count() == 120


def test_a_second_day_reads_its_rows_and_the_buckets_it_touches(spark, tmp_path):
    root, n = str(tmp_path), 16
    path = incremental.state_path(root, "MSTR_TIENDAS", n)
    write(spark, root, [(i, f"a{i}", i) for i in range(60)] + [(7, "a7", 7), (None, "sin", 1)], D1)
    incremental.refresh(spark, root, "MSTR_TIENDAS", since=D1, buckets=n)
    files = {b: set(os.listdir(f"{path}/{b}")) for b in os.listdir(path) if b.startswith("_bucket=")}

    write(spark, root, [(7, "new", 70), (100, "a100", 1), (7, "newer", 71), (None, "sin2", 2)], D2)
    raw = bronze.read_days(spark, root, "MSTR_TIENDAS", S.STORES, D2)
    assert raw.inputFiles() and all(f"fecha_ingesta={D2}" in f for f in raw.inputFiles())
    touched = incremental.merge_days(raw, "MSTR_TIENDAS", path, n)
    assert 1 <= len(touched) <= 3
    state = incremental.touched_state(spark, path, touched)
    state.collect()
    scan = state._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    parquet = {b: [f for f in os.listdir(f"{path}/{b}") if f.endswith(".parquet")] for b in files}
    assert scan.metrics().get("numFiles").get().value() == sum(len(parquet[f"_bucket={b}"]) for b in touched) < sum(map(len, parquet.values()))
    for bucket, held in files.items():
        same = set(os.listdir(f"{path}/{bucket}")) == held
        assert same == (int(bucket.split("=")[1]) not in touched), bucket

    columns = ["id_tienda", "nom_tienda", "metros_cuadrados", ROWS, FAILURES]
    whole = silver.counted_unique(bronze.read_days(spark, root, "MSTR_TIENDAS", S.STORES), "MSTR_TIENDAS").select(columns)
    kept = incremental.current(spark, "MSTR_TIENDAS", path).select(columns)
    assert kept.exceptAll(whole).isEmpty() and whole.exceptAll(kept).isEmpty()
    assert kept.where("id_tienda = 7").first()[ROWS] == 4

    incremental.merge_days(raw, "MSTR_TIENDAS", path, n)  # the same day once more
    again = incremental.current(spark, "MSTR_TIENDAS", path).select(columns)
    assert again.exceptAll(whole).isEmpty() and again.count() == whole.count()
    rebuilt = incremental.refresh(spark, root, "MSTR_TIENDAS", buckets=n, rebuild=True).select(columns)
    assert rebuilt.exceptAll(whole).isEmpty() and rebuilt.count() == whole.count()


def test_a_large_bucket_is_merged_and_written_in_slices(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "ROWS_A_SLICE", 25)
    root, n = str(tmp_path), 2
    path = incremental.state_path(root, "MSTR_TIENDAS", n)
    write(spark, root, [(i, f"a{i}", i) for i in range(300)] + [(7, "a7", 7), (None, "sin", 1)], D1)
    incremental.refresh(spark, root, "MSTR_TIENDAS", since=D1, buckets=n)
    write(spark, root, [(i, f"b{i}", i) for i in range(200, 400)] + [(None, "sin2", 2)] * 3, D2)
    kept = incremental.refresh(spark, root, "MSTR_TIENDAS", since=D2, buckets=n)
    files = [len([f for f in os.listdir(f"{path}/{b}") if f.endswith(".parquet")]) for b in os.listdir(path) if b.startswith("_bucket=")]
    assert len(files) == n and min(files) >= 4  # a task a slice, or a few slices
    whole = silver.counted_unique(bronze.read_days(spark, root, "MSTR_TIENDAS", S.STORES), "MSTR_TIENDAS")
    columns = ["id_tienda", "nom_tienda", "metros_cuadrados", ROWS, FAILURES]
    assert kept.select(columns).exceptAll(whole.select(columns)).isEmpty() and kept.count() == whole.count() == 401


def test_medallion_with_kept_states_equals_a_full_rebuild(spark, tmp_path, monkeypatch):
    from almacen.plans import pipeline
    from almacen.plans.pipeline import LOADS_TABLE, QUALITY_TABLE, Store, run_medallion

    gold = pipeline.run_gold

    src = dict(source_tables(spark, SF).items())
    control = spark.createDataFrame([(i, "dbo", t, "*", None, "bronze", t, 1) for i, t in enumerate(S.SOURCES, start=1)], S.CONTROL)
    half = {t: df.where(F.pmod(F.xxhash64(S.SOURCES[t][1]), F.lit(2)) == 0) if t == "TRANS_VENTAS" else df for t, df in src.items()}
    got = {}
    for name, buckets in (("full", None), ("kept", 8)):
        root = str(tmp_path / name)
        store = Store(f"{root}/tables")
        runs = ((D1, half), (D2, src), (D2, src))[: 3 if buckets else 2]  # the second day's run is repeated
        for i, (day, sources) in enumerate(runs, 1):
            monkeypatch.setattr(pipeline, "run_gold", gold if i == len(runs) else lambda *a, **k: None)  # gold once, at the end
            run_medallion(spark, None, root, now=dt.datetime(day.year, day.month, day.day, 8), control=control,
                          read_source=lambda ld, s=sources: s[ld.source_table], store=store, buckets=buckets)
        got[name] = store
    for table in ("trans_ventas", "mstr_tiendas", "fact_ventas", "fact_rfm_clientes"):
        a, b = (got[n].read(spark, table).drop("FechaIngesta", "IdLote") for n in ("full", "kept"))
        assert a.exceptAll(b.select(a.columns)).isEmpty() and a.count() == b.count(), table
    quality = {n: sorted(map(tuple, s.read(spark, QUALITY_TABLE).drop("processed_at").collect())) for n, s in got.items()}
    assert quality["full"] == quality["kept"] and len(quality["kept"]) == 2 * 7
    assert got["kept"].read(spark, LOADS_TABLE).count() == 2 * 7


@pytest.mark.parametrize("as_path", [True, False])
def test_a_repeated_run_replaces_its_audit_rows(spark, tmp_path, as_path):
    target = str(tmp_path / "audit") if as_path else "audit_rows"
    rows = lambda *x: spark.createDataFrame(list(x), "run string, tabla string, n int")
    for df in (rows(("R1", "a", 1), ("R1", "b", 2)), rows(("R2", "a", 3)), rows(("R1", "b", 5)), rows(("R2", "a", 3))):
        put_rows(df, target, ("run", "tabla"), as_path=as_path)
    held = spark.read.parquet(target) if as_path else spark.table(target)
    assert sorted((r.run, r.tabla, r.n) for r in held.collect()) == [("R1", "a", 1), ("R1", "b", 5), ("R2", "a", 3)]
