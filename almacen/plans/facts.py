"""Gold facts: sales, inventory, returns (GD:118-221)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.config import ANONYMOUS_CUSTOMER, COVERAGE_NO_CONSUMPTION, DEFAULT_GOLD, UNKNOWN_KEY, GoldConfig
from almacen.functions.columns import date_key, map_values, net_amount, positive_flag, rounded_ratio
from almacen.operators.joins import salted_left_join, split_left_join


def fact_sales(sales: DataFrame, members: DataFrame, hot_members: Mapping | Sequence = ()) -> DataFrame:
    """Accepted sales with the customer hash (anonymous when no member matches).

    Money stays decimal here; callers cast at the edge. About one sale in twenty
    has no member: those null keys are salted so they never pile up in one task, and so
    are ``hot_members`` (found when the sales are written, :mod:`almacen.operators.heavy`).
    """
    m = members.select(F.col("id_miembro").alias("_m_id"), F.col("id_miembro_hash").alias("_m_hash"))
    v = sales
    joined = salted_left_join(v, m, "id_miembro", "_m_id", row_id=["id_trans"], hot=hot_members)
    return joined.select(
        F.col("id_trans").alias("id_transaccion"),
        date_key("fec_trans").alias("sk_tiempo"),
        F.col("fec_trans").alias("fec_transaccion"),
        F.col("art_id").alias("sk_producto"),
        F.col("id_tienda").alias("sk_tienda"),
        F.coalesce(F.col("_m_hash"), F.lit(ANONYMOUS_CUSTOMER)).alias("sk_cliente"),
        F.col("canal_venta"),
        F.col("tipo_pago"),
        F.col("qty_vendida").alias("unidades_vendidas"),
        F.col("precio_unitario_venta"),
        F.col("descuento_aplicado"),
        net_amount("qty_vendida", "precio_unitario_venta", "descuento_aplicado").alias("vr_venta_neto"),
        positive_flag("descuento_aplicado").alias("es_venta_con_descuento"),
    )


def daily_consumption(sales: DataFrame, keys=("art_id", "id_tienda"), date_col: str = "fec_trans") -> DataFrame:
    """Units sold per key and day (partial + final hash aggregate)."""
    return sales.groupBy(*keys, date_col).agg(F.sum("qty_vendida").alias("qty_diaria"))


def consumption_average(
    daily: DataFrame,
    keys=("art_id", "id_tienda"),
    date_col: str = "fec_trans",
    mode: str = "all",
    days: int = 14,
    calendar_days: bool = False,
) -> DataFrame:
    """Per key and sale day: ``_qty_sum``, ``_day_count`` and ``promedio`` (= sum / count).

    ``mode="all"``: average over every sale day of the key (the reference, whose
    column is named 14 days but takes the whole partition). ``mode="trailing"``:
    the ``days`` calendar days ending on the row's day; divided by the number of
    sale days in it, or by ``days`` when ``calendar_days``.
    The window partition per key holds at most one row per calendar day.
    """
    part = Window.partitionBy(*keys)
    if mode == "all":
        w = part
    elif mode == "trailing":
        daily = daily.withColumn("_d", F.unix_date(F.col(date_col)))
        w = part.orderBy("_d").rangeBetween(-(days - 1), 0)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    out = daily.withColumn("_qty_sum", F.sum("qty_diaria").over(w))
    if calendar_days:
        out = out.withColumn("_day_count", F.lit(days).cast("long"))
    else:
        out = out.withColumn("_day_count", F.count(F.lit(1)).over(w))
    out = out.withColumn("promedio", F.col("_qty_sum").cast("double") / F.col("_day_count").cast("double"))
    return out.drop("_d") if "_d" in out.columns else out


def fact_inventory(stock: DataFrame, consumption: DataFrame, cfg: GoldConfig = DEFAULT_GOLD) -> DataFrame:
    """Snapshots with the same-day consumption average, coverage days and stock-out alert.

    Coverage and alert are computed on the exact ratio
    ``stock * day_count / qty_sum`` (integers), so rounding and the threshold
    test do not depend on floating point; zero or missing consumption gives
    coverage 999 and no alert, never a division error.
    """
    c = consumption.select(
        F.col("art_id").alias("_c_art"),
        F.col("id_tienda").alias("_c_store"),
        F.col("fec_trans").alias("_c_day"),
        "_qty_sum",
        "_day_count",
        "promedio",
    )
    s = stock
    joined = s.join(
        c,
        (s["art_id"] == c["_c_art"]) & (s["id_tienda"] == c["_c_store"]) & (s["fec_snapshot"] == c["_c_day"]),
        "left",
    )
    return _inventory(joined, cfg)


def stock_consumption(stock: DataFrame, daily: DataFrame, mode: str = "all", days: int = 14, calendar_days: bool = False) -> DataFrame:
    """``stock`` with ``_qty_sum``, ``_day_count`` and ``promedio`` of :func:`consumption_average` on the snapshot's day.

    Snapshots and daily units are laid out once by (article, store) and meet in
    windows on that layout, where averages joined by day would be shuffled again. A group holds the days of one article
    in one store; snapshots without an article or a store match no sale and are spread by their id.
    """
    keys = [F.col("art_id"), F.col("id_tienda")]
    known = keys[0].isNotNull() & keys[1].isNotNull()
    rows = stock.withColumns(
        {"_day": F.unix_date("fec_snapshot"), "_apart": F.when(known, F.lit(0)).otherwise(F.xxhash64("id_snapshot")), "_snapshot": F.lit(True)}
    )
    sold = daily.where(known).select(
        *keys, F.unix_date("fec_trans").alias("_day"), F.lit(0).cast("long").alias("_apart"), "qty_diaria", F.lit(False).alias("_snapshot"), F.lit(1).alias("_sold")
    )
    both = rows.unionByName(sold, allowMissingColumns=True)
    same_day = Window.partitionBy("art_id", "id_tienda", "_apart", "_day")
    w = Window.partitionBy("art_id", "id_tienda", "_apart")
    if mode == "trailing":
        w = w.orderBy("_day").rangeBetween(-(days - 1), 0)
    elif mode != "all":
        raise ValueError(f"unknown mode {mode!r}")
    met = both.withColumn("_met", F.max("_sold").over(same_day))
    count = F.lit(days).cast("long") if calendar_days else F.count("_sold").over(w)
    met = met.withColumns({"_qty_sum": F.sum("qty_diaria").over(w), "_day_count": count})
    on_day = lambda c: F.when((F.col("_met") == 1) & F.col("_day").isNotNull(), c)  # noqa: E731 - null where the day has no sale
    return met.where("_snapshot").select(
        *stock.columns,
        on_day(F.col("_qty_sum")).alias("_qty_sum"),
        on_day(F.col("_day_count")).alias("_day_count"),
        on_day(F.col("_qty_sum").cast("double") / F.col("_day_count").cast("double")).alias("promedio"),
    )


def fact_inventory_of_days(stock: DataFrame, daily: DataFrame, cfg: GoldConfig = DEFAULT_GOLD) -> DataFrame:
    """:func:`fact_inventory` from daily units (:func:`daily_consumption`), with two shuffles of the consumption."""
    return _inventory(stock_consumption(stock, daily, cfg.consumption_mode, cfg.consumption_days, cfg.consumption_calendar_days), cfg)


def _inventory(joined: DataFrame, cfg: GoldConfig) -> DataFrame:
    has_use = F.coalesce(F.col("_qty_sum") > 0, F.lit(False))
    stock_days = F.col("stock_fisico").cast("long") * F.col("_day_count")
    return joined.select(
        F.col("id_snapshot").alias("id_inventario"),
        date_key("fec_snapshot").alias("sk_tiempo"),
        F.col("fec_snapshot"),
        F.col("art_id").alias("sk_producto"),
        F.col("id_tienda").alias("sk_tienda"),
        "stock_fisico",
        "stock_transito",
        "stock_reservado",
        "stock_minimo_config",
        F.coalesce(F.col("promedio"), F.lit(0.0)).alias("promedio_consumo_14dias"),
        F.when(has_use, rounded_ratio(stock_days, F.col("_qty_sum")))
        .otherwise(F.lit(COVERAGE_NO_CONSUMPTION))
        .alias("cobertura_dias"),
        (has_use & (stock_days < F.col("_qty_sum") * cfg.stockout_days)).alias("alerta_quiebre"),
        (F.col("stock_fisico") - F.col("stock_minimo_config")).alias("diferencia_stock_minimo"),
    )


def fact_returns(
    returns: DataFrame,
    sales: DataFrame,
    members: DataFrame,
    products: DataFrame,
    cfg: GoldConfig = DEFAULT_GOLD,
    hot_sales: Mapping | None = None,
    hot_members: Mapping | Sequence = (),
    co_located: bool = False,
) -> DataFrame:
    """Returns with date and customer keys, the original sale price (0 when unknown), motive text and category.

    Returns without a known sale (null or the unknown key, which may be a large
    share) and those of ``hot_sales`` (found when the returns are written,
    :mod:`almacen.operators.heavy`) are salted, so they never meet in one task. Where both tables are bucketed by
    the join key (``co_located``) they are joined apart instead, and the others need no shuffle.
    """
    v = sales.select(
        F.col("id_trans").alias("_v_id"), F.col("precio_unitario_venta").alias("_v_price"), F.col("id_miembro").alias("_v_member")
    )
    m = members.select(F.col("id_miembro").alias("_m_id"), F.col("id_miembro_hash").alias("_m_hash"))
    a = products.select(F.col("art_id").alias("_a_id"), F.col("id_categ_n1").alias("_a_cat"))
    d = returns
    hot = {UNKNOWN_KEY: 1.0, **(hot_sales or {})}
    if co_located:
        priced = split_left_join(d, v, "id_trans_origen", "_v_id", tuple(hot))
    else:
        priced = salted_left_join(d, v, "id_trans_origen", "_v_id", row_id=["id_devolucion"], hot=hot)
    joined = salted_left_join(priced, m, "_v_member", "_m_id", row_id=["id_devolucion"], hot=hot_members)
    joined = joined.join(a, F.col("art_id") == a["_a_id"], "left")
    return joined.select(
        "id_devolucion",
        "id_trans_origen",
        date_key("fec_devolucion").alias("sk_tiempo"),
        F.coalesce(F.col("_m_hash"), F.lit(ANONYMOUS_CUSTOMER)).alias("sk_cliente"),
        "fec_devolucion",
        F.col("art_id").alias("sk_producto"),
        F.col("id_tienda").alias("sk_tienda"),
        "canal_devolucion",
        "qty_devuelta",
        "vr_reembolso",
        F.coalesce(F.col("_v_price"), F.lit(0).cast("decimal(12,2)")).alias("precio_original_venta"),
        map_values("motivo_cod", cfg.motive_rules, cfg.motive_default).alias("motivo_descripcion"),
        F.col("_a_cat").alias("categoria_nivel_1"),
    )
