import datetime as dt
import random

from pyspark.sql import functions as F

from almacen import schemas as S
from almacen.config import GoldConfig
from almacen.plans import dims, facts, kpis, rfm

D = dt.date


def test_fact_inventory_rules(spark):
    sales = spark.createDataFrame(
        [(1, 1, D(2024, 1, 1), 4), (1, 1, D(2024, 1, 2), 6), (2, 1, D(2024, 1, 1), 0)],
        "art_id int, id_tienda int, fec_trans date, qty_vendida int",
    )
    stock = spark.createDataFrame(
        [(10, 1, 1, D(2024, 1, 1), 34, 0, 0, 40), (11, 1, 1, D(2024, 1, 5), 3, 0, 0, 1),
         (12, 2, 1, D(2024, 1, 1), 5, 0, 0, 1), (13, 1, 1, D(2024, 1, 2), 36, 0, 0, 1)],
        "id_snapshot long, art_id int, id_tienda int, fec_snapshot date, stock_fisico int, stock_transito int, "
        "stock_reservado int, stock_minimo_config int",
    )
    out = facts.fact_inventory(stock, facts.consumption_average(facts.daily_consumption(sales)))
    got = {r.id_inventario: (r.promedio_consumo_14dias, r.cobertura_dias, r.alerta_quiebre, r.diferencia_stock_minimo)
           for r in out.collect()}
    # avg 5: 34 / 5 = 6.8 -> alert; no sale that day -> 0 / 999; zero consumption -> 999, no division error
    assert got == {10: (5.0, 6.8, True, -6), 11: (0.0, 999.0, False, 2), 12: (0.0, 999.0, False, 4),
                   13: (5.0, 7.2, False, 35)}


def test_inventory_in_one_layout_equals_the_join(spark):
    """Every mode; several snapshots a day, days without sales, null keys and days, sales without units."""
    rnd = random.Random(4)
    some = lambda *x: rnd.choice(x)
    day = lambda: some(None, *[D(2024, 1, d) for d in range(1, 29)])
    sales = spark.createDataFrame(
        [(some(1, 2, 3, None), some(1, -1, None), day(), some(0, 1, 5, None)) for _ in range(400)],
        "art_id int, id_tienda int, fec_trans date, qty_vendida int",
    )
    stock = spark.createDataFrame(
        [(i, some(1, 2, 3, 4, None), some(1, -1, None), day(), some(0, 3, 40, None), 0, 0, 5) for i in range(300)],
        "id_snapshot long, art_id int, id_tienda int, fec_snapshot date, stock_fisico int, stock_transito int, "
        "stock_reservado int, stock_minimo_config int",
    )
    daily = facts.daily_consumption(sales)
    for mode, calendar in (("all", False), ("trailing", False), ("trailing", True)):
        cfg = GoldConfig(consumption_mode=mode, consumption_calendar_days=calendar)
        joined = facts.fact_inventory(stock, facts.consumption_average(daily, mode=mode, days=cfg.consumption_days, calendar_days=calendar), cfg)
        got = facts.fact_inventory_of_days(stock, daily, cfg)
        assert got.columns == joined.columns
        rows = lambda df: sorted(map(str, df.collect()))
        assert rows(got) == rows(joined), mode
    assert facts.fact_inventory_of_days(stock, daily.limit(0)).where("promedio_consumo_14dias > 0").isEmpty()
    assert facts.fact_inventory_of_days(stock.limit(0), daily).isEmpty()


def test_trailing_average_window(spark):
    daily = spark.createDataFrame(
        [(1, 1, D(2024, 1, 1), 10), (1, 1, D(2024, 1, 10), 20), (1, 1, D(2024, 1, 20), 30)],
        "art_id int, id_tienda int, fec_trans date, qty_diaria long",
    )
    got = {r.fec_trans: r.promedio for r in facts.consumption_average(daily, mode="trailing", days=14).collect()}
    assert got == {D(2024, 1, 1): 10.0, D(2024, 1, 10): 15.0, D(2024, 1, 20): 25.0}
    cal = facts.consumption_average(daily, mode="trailing", days=14, calendar_days=True)
    assert {r.fec_trans: r.promedio for r in cal.collect()}[D(2024, 1, 10)] == 30 / 14


def test_dim_stores_and_products_rules(spark):
    stores = spark.createDataFrame(
        [(1, "a", " super ", "Santiago Centro", "X"), (2, "b", "hiper", None, None), (3, "c", "x", "Otra", "Peru")],
        "id_tienda int, nom_tienda string, tipo_tienda string, id_ciudad string, id_pais string",
    ).withColumn("metros_cuadrados", F.lit(1.0)).withColumn("fec_apertura", F.lit(None).cast("date"))
    got = {r.sk_tienda: (r.tipo_tienda, r.ciudad, r.pais, r.zona_distribucion_asignada)
           for r in dims.dim_stores(stores).collect()}
    assert got == {1: ("SUPER", "Santiago Centro", "Chile", "ZONA_DIST_CHILE"),
                   2: ("HIPER", "CIUDAD_PRINCIPAL", "Colombia", "ZONA_DIST_COLOMBIA"),
                   3: ("X", "Otra", "Peru", "ZONA_DIST_PERU")}
    arts = spark.createDataFrame(
        [(1, "TEC", 7, 10.01), (2, "ROPA", 8, 10.01), (3, "5", None, 10.01)],
        "art_id int, id_categ_n1 string, id_proveedor int, precio_lista double",
    ).withColumn("precio_lista", F.col("precio_lista").cast(S.MONEY))
    for c in ("cod_barra", "desc_art", "id_categ_n2", "unid_medida"):
        arts = arts.withColumn(c, F.lit(None).cast("string"))
    arts = arts.withColumns({"id_categ_n3": F.lit(1), "peso_kg": F.lit(1).cast(S.WEIGHT), "activo": F.lit(True)})
    sup = spark.createDataFrame([(7, "S", "CL", 3)], "id_proveedor int, razon_social string, pais_origen string, "
                                "tiempo_repo_dias int")
    got = {r.sk_producto: (float(r.margen_estimado_categoria), r.id_proveedor, r.nombre_proveedor)
           for r in dims.dim_products(arts, sup).collect()}
    assert got == {1: (2.5, 7, "S"), 2: (4.5, None, None), 3: (3.5, None, None)}


def test_rfm_segments_rules_and_anonymous(spark):
    sales = spark.createDataFrame(
        [(i, m, D(2024, 3, 31) - dt.timedelta(days=d), q)
         for i, (m, d, q) in enumerate([(1, 0, 5), (1, 1, 5), (2, 80, 1), (3, 10, 2), (None, 0, 9), (4, 200, 1)])],
        "id_trans long, id_miembro int, fec_trans date, vr_total_trans int",
    ).withColumn("vr_total_trans", F.col("vr_total_trans").cast("decimal(12,2)"))
    members = spark.createDataFrame([(m, f"h{m}") for m in (1, 2, 3, 4)], "id_miembro int, id_miembro_hash string")
    ref = rfm.reference_date(sales)
    base = rfm.rfm_base(sales, ref, 90)
    assert base.count() == 4  # member 4 is outside the window; the null member is scored
    seg = rfm.churn_flag(rfm.rfm_segments(rfm.rfm_scores(base, 5), members, ref))
    got = {r.sk_cliente: (r.segmento_rfm, r.nombre_segmento, r.alerta_churn) for r in seg.collect()}
    assert set(got) == {"h1", "h2", "h3"}
    assert got["h2"][1] in ("Abandono", "En Riesgo", "En Desarrollo / Ocasionales")
    without = rfm.rfm_base(sales, ref, 90, include_anonymous=False)
    assert without.filter("id_miembro is null").count() == 0


def test_kpis_on_small_frames(spark):
    events = spark.createDataFrame(
        [(1, "view", "2024-01-01 10:00:00"), (1, "purchase", "2024-01-01 11:00:00"), (2, "view", "2024-01-01 12:00:00"),
         (2, "view", "2024-01-01 13:00:00"), (3, "purchase", "2024-01-02 09:00:00")],
        "user_id long, event_type string, ts string",
    ).withColumn("ts", F.to_timestamp("ts"))
    got = {r.fecha: (r.usuarios_vista, r.usuarios_compra, r.tasa_conversion) for r in kpis.conversion(events).collect()}
    assert got == {D(2024, 1, 1): (2, 1, 0.5), D(2024, 1, 2): (0, 1, None)}
    inv = spark.createDataFrame([(1, 2024, 1, 1, 5, 5), (2, 2024, 1, 1, 9, 5)],
                                "id_inventario long, sk_tiempo int, sk_producto int, sk_tienda int, stock_fisico int, "
                                "stock_minimo_config int")
    assert {r.id_inventario: r.alerta_stock_bajo for r in kpis.low_stock(inv).collect()} == {1: True, 2: False}


def test_dim_date_covers_every_day(spark):
    df = spark.createDataFrame([(D(2024, 2, 27),), (D(2024, 3, 2),)], "d date")
    got = dims.dim_date(df, "d").orderBy("fecha").collect()
    assert [r.sk_fecha for r in got] == [20240227, 20240228, 20240229, 20240301, 20240302]
    assert got[0].dia_semana == "Tuesday" and got[2].mes == 2


def test_customer_pii_options(spark):
    import hashlib

    from almacen.config import SilverConfig
    from almacen.plans import silver

    raw = spark.createDataFrame(
        [(7, D(2024, 1, 1), "Lima", "Femenino", None, "App", 0, None)],
        "id_miembro int, fec_registro date, id_ciudad string, genero string, rango_edad string, canal_pref string, "
        "activo int, fec_ultima_compra date",
    )
    salted = silver.members(raw, SilverConfig(pii_salt="s1")).collect()[0]
    assert salted.id_miembro_hash == hashlib.sha256(b"s17").hexdigest()
    assert (salted.genero, salted.rango_edad, salted.activo) == ("F", "30-45", False)
    m = silver.members(raw)
    ref = F.lit(D(2024, 1, 31))
    assert "id_miembro_bk" not in dims.dim_customers(m, ref, keep_raw_id=False).columns
    masked = dims.mask_columns(dims.dim_customers(m, ref), ["id_miembro_bk"]).collect()[0]
    assert masked.id_miembro_bk == "n" and masked.antiguedad_dias == 30
