"""Business KPIs and views (CAT:24-39, RM:47-66, DM:83-85).

The reference documents these but ships no code; the definitions here are
ours and stated in each docstring. Money sums are exact decimals, ratios are
one floating-point division of exact operands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ratio(num: Column, den: Column) -> Column:
    """num / den as double, null when den is 0 or null."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def gross_margin(sales: DataFrame, products: DataFrame, cost_col: str = "precio_lista") -> DataFrame:
    """Per level-1 category: net sales, reference cost (units x ``cost_col``) and
    ``margen_bruto_pct`` = (sales - cost) / sales * 100."""
    a = products.select(F.col("art_id").alias("_a_id"), F.col("id_categ_n1").alias("categoria_nivel_1"),
                    F.col(cost_col).alias("_cost"))
    j = sales.join(a, sales["art_id"] == a["_a_id"], "inner")
    agg = j.groupBy("categoria_nivel_1").agg(
        F.sum("vr_total_trans").alias("_sales"),
        F.sum(F.col("qty_vendida") * F.col("_cost")).alias("_cost_sum"),
    )
    return agg.select(
        "categoria_nivel_1",
        F.col("_sales").cast("double").alias("venta_neta"),
        F.col("_cost_sum").cast("double").alias("costo_referencia"),
        (_ratio(F.col("_sales") - F.col("_cost_sum"), F.col("_sales")) * 100).alias("margen_bruto_pct"),
    )


def discount_by_channel(sales: DataFrame) -> DataFrame:
    """Per sales channel: total discount granted, sales with a discount, all sales."""
    return sales.groupBy("canal_venta").agg(
        F.sum("descuento_aplicado").cast("double").alias("total_descuentos_monto"),
        F.count_if(F.col("descuento_aplicado") > 0).alias("ventas_con_descuento"),
        F.count(F.lit(1)).alias("ventas"),
    )


def stock_coverage(stock: DataFrame, sales: DataFrame, ref: Column, days: int = 30) -> DataFrame:
    """Per article and store with snapshots in the ``days`` days ending at ``ref``:
    average physical stock / mean daily units sold over those calendar days.
    Null coverage when nothing sold."""
    lo = F.date_sub(ref, days - 1)
    s = (
        stock.filter((F.col("fec_snapshot") >= lo) & (F.col("fec_snapshot") <= ref))
        .groupBy("art_id", "id_tienda")
        .agg(F.sum("stock_fisico").alias("_stock_sum"), F.count(F.lit(1)).alias("_snaps"))
    )
    v = (
        sales.filter((F.col("fec_trans") >= lo) & (F.col("fec_trans") <= ref))
        .groupBy(F.col("art_id").alias("_v_art"), F.col("id_tienda").alias("_v_store"))
        .agg(F.sum("qty_vendida").alias("_units"))
    )
    j = s.join(v, (s["art_id"] == v["_v_art"]) & (s["id_tienda"] == v["_v_store"]), "left")
    avg_stock = F.col("_stock_sum").cast("double") / F.col("_snaps").cast("double")
    rate = F.col("_units").cast("double") / F.lit(float(days))
    return j.select(
        F.col("art_id").alias("sk_producto"),
        F.col("id_tienda").alias("sk_tienda"),
        avg_stock.alias("stock_promedio"),
        rate.alias("venta_diaria_promedio"),
        _ratio(F.col("_stock_sum") * days, F.col("_snaps") * F.col("_units")).alias("cobertura_dias_stock"),
    )


def avg_ticket(sales: DataFrame, products: DataFrame, ids_unique: bool = True) -> DataFrame:
    """Per channel and level-1 category: net sales / distinct transactions.

    Silver sales are unique by ``id_trans``, so a plain count is the distinct
    count (no expand, one shuffle less); pass ``ids_unique=False`` otherwise.
    """
    a = products.select(F.col("art_id").alias("_a_id"), F.col("id_categ_n1").alias("categoria_nivel_1"))
    j = sales.join(a, sales["art_id"] == a["_a_id"], "inner")
    agg = j.groupBy("canal_venta", "categoria_nivel_1").agg(
        F.sum("vr_total_trans").alias("_net"),
        (F.count("id_trans") if ids_unique else F.count_distinct("id_trans")).alias("transacciones"),
    )
    return agg.select(
        "canal_venta", "categoria_nivel_1", "transacciones",
        F.col("_net").cast("double").alias("venta_neta"),
        _ratio(F.col("_net"), F.col("transacciones")).alias("ticket_promedio"),
    )


def conversion(events: DataFrame, view_type: str = "view", buy_type: str = "purchase") -> DataFrame:
    """Per day: users who viewed, users who bought, and bought / viewed.

    Two partial aggregates (user-day, then day) instead of two distinct counts:
    no expand, and a hot user or day is combined before each shuffle.
    """
    per_user = events.groupBy(F.to_date("ts").alias("fecha"), "user_id").agg(
        F.max(F.col("event_type") == view_type).alias("_viewed"),
        F.max(F.col("event_type") == buy_type).alias("_bought"),
    )
    daily = per_user.groupBy("fecha").agg(
        F.count_if("_viewed").alias("usuarios_vista"),
        F.count_if("_bought").alias("usuarios_compra"),
    )
    return daily.withColumn("tasa_conversion", _ratio(F.col("usuarios_compra"), F.col("usuarios_vista")))


def sessions(events: DataFrame, gap_minutes: int, firsts: dict[str, str], lasts: dict[str, str]) -> DataFrame:
    """One row per user and session: user_id, inicio, fin, the first and last time of event types.

    A session ends where the next event is ``gap_minutes`` or more away. Events are first combined into
    slots of that length (two events of one slot are always in one session), so a user has at most as many rows as
    slots in the window over users, however many events. ``firsts`` and ``lasts`` name output columns by event type. Events
    without a user or a time belong to no session.
    """
    gap = gap_minutes * 60 * 1_000_000
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    timed = events.where(F.col("user_id").isNotNull() & F.col("ts").isNotNull()).select("user_id", "event_type", at.alias("_at"))
    picks = [F.min(F.when(F.col("event_type") == e, F.col("_at"))).alias(c) for c, e in firsts.items()]
    picks += [F.max(F.when(F.col("event_type") == e, F.col("_at"))).alias(c) for c, e in lasts.items()]
    slots = timed.groupBy("user_id", (F.col("_at") - F.pmod(F.col("_at"), F.lit(gap))).alias("_slot")).agg(F.min("_at").alias("inicio"), F.max("_at").alias("fin"), *picks)
    w = Window.partitionBy("user_id").orderBy("_slot")
    new = F.coalesce(F.col("inicio") - F.lag("fin").over(w) >= gap, F.lit(True))
    marked = slots.withColumn("_new", new.cast("long")).withColumn("_session", F.sum("_new").over(w))
    again = [F.min(c).alias(c) for c in ("inicio", *firsts)] + [F.max(c).alias(c) for c in ("fin", *lasts)]
    return marked.groupBy("user_id", "_session").agg(*again).drop("_session")


def ordered_conversion(events: DataFrame, gap_minutes: int = 30, view_type: str = "view", buy_type: str = "purchase") -> DataFrame:
    """Per day on which sessions began: sessions, those with a view, with a purchase, and with a purchase after a view.

    Unlike :func:`conversion` a purchase counts only where the same user has viewed before, in the same session.
    """
    s = sessions(events, gap_minutes, {"_view": view_type}, {"_buy": buy_type})
    daily = s.groupBy(F.to_date(F.timestamp_micros("inicio")).alias("fecha")).agg(
        F.count(F.lit(1)).alias("sesiones"),
        F.count("_view").alias("sesiones_vista"),
        F.count("_buy").alias("sesiones_compra"),
        F.count_if(F.col("_buy") > F.col("_view")).alias("sesiones_convertidas"),
    )
    return daily.withColumn("tasa_conversion", _ratio(F.col("sesiones_convertidas"), F.col("sesiones_vista")))


def returns_root_cause(returns_fact: DataFrame, products_dim: DataFrame) -> DataFrame:
    """Returns by motive, category, supplier and channel: count, units, refunds."""
    p = products_dim.select(F.col("sk_producto").alias("_p_id"), F.col("nombre_proveedor"))
    j = returns_fact.join(p, returns_fact["sk_producto"] == p["_p_id"], "left")
    return j.groupBy("motivo_descripcion", "categoria_nivel_1", "nombre_proveedor", "canal_devolucion").agg(
        F.count(F.lit(1)).alias("devoluciones"),
        F.sum("qty_devuelta").alias("unidades_devueltas"),
        F.sum("vr_reembolso").cast("double").alias("monto_reembolsado"),
    )


def store_daily(sales_fact: DataFrame) -> DataFrame:
    """Per store and day: net sales, discounts, average unit price, transactions."""
    return sales_fact.groupBy("sk_tienda", "fec_transaccion").agg(
        F.sum("vr_venta_neto").cast("double").alias("venta_neta"),
        F.sum("descuento_aplicado").cast("double").alias("descuentos"),
        (F.sum("precio_unitario_venta").cast("double") / F.count("precio_unitario_venta").cast("double")).alias(
            "precio_promedio"
        ),
        F.count(F.lit(1)).alias("transacciones"),
    )


def daily_sales(sales_fact: DataFrame, stores_dim: DataFrame, products_dim: DataFrame) -> DataFrame:
    """Commercial daily view by date, country, store, channel and category."""
    s = stores_dim.select(F.col("sk_tienda").alias("_s_id"), "pais", "nombre_tienda")
    p = products_dim.select(F.col("sk_producto").alias("_p_id"), "categoria_nivel_1")
    j = sales_fact.join(s, sales_fact["sk_tienda"] == s["_s_id"], "left").join(
        p, sales_fact["sk_producto"] == p["_p_id"], "left"
    )
    return j.groupBy("fec_transaccion", "pais", "sk_tienda", "nombre_tienda", "canal_venta", "categoria_nivel_1").agg(
        F.sum("unidades_vendidas").alias("unidades"),
        F.sum("vr_venta_neto").cast("double").alias("venta_neta"),
        F.sum("descuento_aplicado").cast("double").alias("descuentos"),
        F.count(F.lit(1)).alias("transacciones"),
    )


def segment_summary(rfm_fact: DataFrame) -> DataFrame:
    """Members and value per RFM segment."""
    return rfm_fact.groupBy("nombre_segmento").agg(
        F.count(F.lit(1)).alias("clientes"),
        F.sum("monetary_val").cast("double").alias("valor_monetario"),
        (F.sum("recency_dias").cast("double") / F.count(F.lit(1)).cast("double")).alias("recencia_promedio"),
        (F.sum("frequency_trans").cast("double") / F.count(F.lit(1)).cast("double")).alias("frecuencia_promedio"),
    )


def low_stock(inventory_fact: DataFrame) -> DataFrame:
    """Low-stock flag against the configured minimum (reorder point)."""
    return inventory_fact.select(
        "id_inventario",
        "sk_tiempo",
        "sk_producto",
        "sk_tienda",
        F.col("stock_fisico").alias("stock_disponible"),
        F.col("stock_minimo_config").alias("reorder_point"),
        (F.col("stock_fisico") <= F.col("stock_minimo_config")).alias("alerta_stock_bajo"),
    )


def leadtime_risk(inventory_fact: DataFrame, products_dim: DataFrame) -> DataFrame:
    """Stock-out risk given the supplier lead time: consumption is positive and
    coverage days are below the replenishment days of the article's supplier."""
    p = products_dim.select(F.col("sk_producto").alias("_p_id"), F.col("tiempo_repo_dias"))
    j = inventory_fact.join(p, inventory_fact["sk_producto"] == p["_p_id"], "left")
    return j.select(
        "id_inventario",
        "sk_producto",
        "sk_tienda",
        "fec_snapshot",
        "cobertura_dias",
        "tiempo_repo_dias",
        F.coalesce(
            (F.col("promedio_consumo_14dias") > 0) & (F.col("cobertura_dias") < F.col("tiempo_repo_dias")),
            F.lit(False),
        ).alias("riesgo_reposicion"),
    )
