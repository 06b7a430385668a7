"""Gold dimensions (GD:28-116, DM:48-54)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almacen.config import DEFAULT_GOLD, NULL_CITY, ZONE_PREFIX, GoldConfig
from almacen.functions.columns import contains_map, date_key, map_values, normalise_text


def margin_rate(category: Column | str, rules, default: float) -> Column:
    """Rate by category as decimal(3,2), compared as text (never a cast error)."""
    return map_values(category, rules, default).cast("decimal(3,2)")


def dim_products(products: DataFrame, suppliers: DataFrame, cfg: GoldConfig = DEFAULT_GOLD) -> DataFrame:
    """Articles enriched with their supplier; estimated margin = round(rate * list price, 2)."""
    p = suppliers.select(
        F.col("id_proveedor").alias("_prov_id"),
        F.col("id_proveedor").alias("p_id_proveedor"),
        "razon_social",
        "pais_origen",
        "tiempo_repo_dias",
    )
    a = products
    joined = a.join(p, a["id_proveedor"] == p["_prov_id"], "left")
    margin = F.round(margin_rate(a["id_categ_n1"], cfg.margin_rules, cfg.margin_default) * a["precio_lista"], 2)
    return joined.select(
        a["art_id"].alias("sk_producto"),
        a["cod_barra"],
        a["desc_art"].alias("nombre_producto"),
        a["id_categ_n1"].alias("categoria_nivel_1"),
        a["id_categ_n2"].alias("categoria_nivel_2"),
        a["id_categ_n3"].alias("categoria_nivel_3"),
        a["precio_lista"],
        a["peso_kg"],
        a["unid_medida"],
        a["activo"],
        F.col("p_id_proveedor").alias("id_proveedor"),
        F.col("razon_social").alias("nombre_proveedor"),
        F.col("pais_origen").alias("pais_proveedor"),
        F.col("tiempo_repo_dias"),
        margin.alias("margen_estimado_categoria"),
    )


def dim_stores(stores: DataFrame, cfg: GoldConfig = DEFAULT_GOLD) -> DataFrame:
    """Stores with country fixed from the city name and the distribution zone."""
    city = F.coalesce(F.col("id_ciudad"), F.lit(NULL_CITY))
    country = contains_map(city, cfg.geo_rules, F.coalesce(F.col("id_pais"), F.lit(cfg.geo_default)))
    return stores.select(
        F.col("id_tienda").alias("sk_tienda"),
        F.col("nom_tienda").alias("nombre_tienda"),
        normalise_text("tipo_tienda").alias("tipo_tienda"),
        city.alias("ciudad"),
        F.col("metros_cuadrados"),
        F.col("fec_apertura"),
        country.alias("pais"),
        F.concat(F.lit(ZONE_PREFIX), F.upper(country)).alias("zona_distribucion_asignada"),
    )


def dim_customers(members: DataFrame, ref_date: Column, keep_raw_id: bool = True) -> DataFrame:
    """Customers keyed by the id hash; tenure in days up to the reference date."""
    cols = [
        F.col("id_miembro_hash").alias("sk_cliente"),
        F.col("id_miembro").alias("id_miembro_bk"),
        "genero",
        "rango_edad",
        "canal_pref",
        "fec_registro",
        "fec_ultima_compra",
        "activo",
        F.datediff(ref_date, F.col("fec_registro")).alias("antiguedad_dias"),
    ]
    out = members.select(*cols)
    return out if keep_raw_id else out.drop("id_miembro_bk")


def mask_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sensitive-data masking: letters to X/x, digits to n (``mask``), text kept otherwise."""
    return df.select(*[F.mask(F.col(c).cast("string")).alias(c) if c in columns else F.col(c) for c in df.columns])


def dim_date(dates: DataFrame, date_col: str) -> DataFrame:
    """One row per calendar day between the first and last date of ``date_col``.

    The only single-row step is the min/max pair; the exploded range has one row
    per calendar day, bounded by the calendar, not by the data.
    """
    bounds = dates.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    days = bounds.select(F.explode(F.sequence(F.col("_lo"), F.col("_hi"))).alias("fecha"))
    return days.select(
        date_key("fecha").alias("sk_fecha"),
        F.col("fecha"),
        F.year("fecha").alias("anio"),
        F.month("fecha").alias("mes"),
        F.date_format("fecha", "EEEE").alias("dia_semana"),
    )
