"""Retail source tables derived from the TPC-H-shaped test tables.

The given Parquet tables have no retail schema, so each of the seven source
tables is derived from them with plain column expressions (FIXTURES.md, section 2).
Everything stays lazy: the derived frames grow with the given tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen import schemas as S

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# helper columns of the sales and returns fixtures (dedupe order, not business columns)
SALES_HELPERS = ("x_supp", "x_ship")

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping
# ---------------------------------------------------------------------------
UNITS = ("UN", "KG", "LITRO", "CAJA")  # by p_partkey % 4
STORE_TYPES = (" Hipermercado", "supermercado ", "Conveniencia")  # by n_nationkey % 3
CITIES = ("Bogota", "CDMX", "Santiago", "Lima", "Quito", "Otra", None)  # by n_nationkey % 7
GENDERS = ("M", "Masculino", "F", "Femenino", None)  # by c_custkey % 5
AGE_RANGES = ("18-25", "26-35", "36-50", "51+", None, None, None)  # by c_custkey % 7
CHANNELS = (("F", "Fisico"), ("O", "Online"), ("P", "App"))  # by o_orderstatus
MOTIVES = (" def ", "DEFECTUOSO", "tal", "Talla", "ERR", "error", "ARREPENTIMIENTO")  # by l_linenumber 1..7
RETURN_CHANNELS = ("Tienda", "Correo", "Casillero")  # by l_partkey % 3
RETURN_STATES = ("APROBADO", "PENDIENTE", "RECHAZADO")  # by l_suppkey % 3
# ---------------------------------------------------------------------------


class GivenTables(dict):
    """The given Parquet tables of one folder, each opened on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._dir = spark, sf_dir.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        self[name] = frame = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return frame


def read_tables(spark: SparkSession, sf_dir: str) -> GivenTables:
    return GivenTables(spark, sf_dir)


def pick(index: Column, values) -> Column:
    """values[index] as a CASE expression (small fixed lists only)."""
    out = F.lit(None).cast("string")
    for i, v in reversed(list(enumerate(values))):
        out = F.when(index == i, F.lit(v)).otherwise(out)
    return out


def _date_plus(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def suppliers(t: dict[str, DataFrame]) -> DataFrame:
    s, n = t["supplier"], t["nation"]
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
        F.col("s_suppkey").cast("int").alias("id_proveedor"),
        F.col("s_name").alias("razon_social"),
        F.col("n_name").alias("pais_origen"),
        (1 + F.col("s_suppkey") % 15).cast("int").alias("tiempo_repo_dias"),
        ((300 + F.col("s_suppkey") % 201).cast("double") / 100).alias("calificacion_calidad"),
        F.lit(1).alias("activo"),
    )


def articles(t: dict[str, DataFrame]) -> DataFrame:
    first_supplier = t["lineitem"].groupBy("l_partkey").agg(F.min("l_suppkey").alias("x_supp"))
    p = t["part"]
    key = F.col("p_partkey")
    return p.join(first_supplier, p.p_partkey == first_supplier.l_partkey, "left").select(
        key.cast("int").alias("art_id"),
        F.concat(F.lit("770"), F.lpad(key.cast("string"), 9, "0")).alias("cod_barra"),
        F.col("p_name").alias("desc_art"),
        F.when(key % 10 == 1, F.lit("TEC")).when(key % 10 == 2, F.lit("ROPA")).otherwise(F.col("p_type")).alias("id_categ_n1"),
        F.col("p_brand").alias("id_categ_n2"),
        F.col("p_size").alias("id_categ_n3"),
        F.col("x_supp").cast("int").alias("id_proveedor"),
        F.col("p_retailprice").cast(S.MONEY).alias("precio_lista"),
        F.col("p_size").cast(S.WEIGHT).alias("peso_kg"),
        pick(key % 4, UNITS).alias("unid_medida"),
        F.when(key % 17 == 0, F.lit(None).cast("int")).otherwise(F.lit(1)).alias("activo"),
        _date_plus("1995-01-01", key % 181).alias("fec_alta"),
    )


def stores(t: dict[str, DataFrame]) -> DataFrame:
    n, r = t["nation"], t["region"]
    key = F.col("n_nationkey")
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        key.cast("int").alias("id_tienda"),
        F.col("n_name").alias("nom_tienda"),
        pick(key % 3, STORE_TYPES).alias("tipo_tienda"),
        pick(key % 7, CITIES).alias("id_ciudad"),
        F.when(key % 6 == 5, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("id_pais"),
        (100 + key * 137 % 3401).cast("int").alias("metros_cuadrados"),
        F.lit(1).alias("activo"),
        _date_plus("1990-01-01", key * 61).alias("fec_apertura"),
    )


def members(t: dict[str, DataFrame]) -> DataFrame:
    c, n = t["customer"], t["nation"]
    last_order = t["orders"].groupBy("o_custkey").agg(
        F.max(F.col("o_orderdate").cast("date")).alias("fec_ultima_compra")
    )
    key = F.col("c_custkey")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(last_order, c.c_custkey == last_order.o_custkey, "left")
        .select(
            key.cast("int").alias("id_miembro"),
            _date_plus("1994-01-01", key % 201).alias("fec_registro"),
            F.col("n_name").alias("id_ciudad"),
            pick(key % 5, GENDERS).alias("genero"),
            pick(key % 7, AGE_RANGES).alias("rango_edad"),
            F.col("c_mktsegment").alias("canal_pref"),
            F.when(key % 11 == 0, F.lit(None).cast("int"))
            .when(key % 13 == 0, F.lit(0))
            .otherwise(F.lit(1))
            .alias("activo"),
            F.col("fec_ultima_compra"),
        )
    )


def _order_lines(t: dict[str, DataFrame]) -> DataFrame:
    """Lines with their order and customer; orders meet the customers first, so the lines, the largest table, move once."""
    li, o, c = t["lineitem"], t["orders"], t["customer"]
    return li.join(o.join(c, o.o_custkey == c.c_custkey, "inner"), li.l_orderkey == o.o_orderkey, "inner")


def sales(t: dict[str, DataFrame], helpers: bool = True) -> DataFrame:
    """TRANS_VENTAS with the two helper columns x_supp, x_ship (ingest-order stand-ins)."""
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    channel = reduce(
        lambda acc, kv: acc.when(F.col("o_orderstatus") == kv[0], F.lit(kv[1])),
        CHANNELS[1:],
        F.when(F.col("o_orderstatus") == CHANNELS[0][0], F.lit(CHANNELS[0][1])),
    )
    cols = [
        F.when((F.col("l_orderkey") % 211 == 0) & (line == 1), F.lit(None).cast("long"))
        .otherwise((F.col("l_orderkey") * 10 + line).cast("long"))
        .alias("id_trans"),
        F.when(F.col("o_orderkey") % 20 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("o_custkey").cast("int"))
        .alias("id_miembro"),
        F.when(part % 97 == 0, F.lit(-1))
        .when(part % 89 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("c_nationkey").cast("int"))
        .alias("id_tienda"),
        F.when(part % 83 == 0, -part).otherwise(part).cast("int").alias("art_id"),
        F.col("o_orderdate").cast("date").alias("fec_trans"),
        F.concat(F.lpad((8 + line).cast("string"), 2, "0"), F.lit(":00:00")).alias("hra_trans"),
        F.col("l_quantity").cast("int").alias("qty_vendida"),
        F.col("l_extendedprice").cast(S.MONEY).alias("precio_unitario_venta"),
        F.when(line == 7, F.lit(None).cast(S.MONEY))
        .otherwise((F.col("l_discount") * 100).cast(S.MONEY))
        .alias("descuento_aplicado"),
        F.col("o_orderpriority").alias("tipo_pago"),
        channel.alias("canal_venta"),
    ]
    if helpers:
        cols += [
            F.col("l_suppkey").cast("long").alias("x_supp"),
            F.col("l_shipdate").cast("date").alias("x_ship"),
        ]
    return _order_lines(t).select(*cols)


def stock(t: dict[str, DataFrame]) -> DataFrame:
    snap = F.date_add(F.col("o_orderdate").cast("date"), (F.col("l_linenumber") % 2).cast("int"))
    keys = (
        _order_lines(t)
        .select(
            F.col("l_partkey").cast("int").alias("art_id"),
            F.col("c_nationkey").cast("int").alias("id_tienda"),
            snap.alias("fec_snapshot"),
        )
        .distinct()
    )
    art, store, day = F.col("art_id"), F.col("id_tienda"), F.col("fec_snapshot")
    return keys.select(
        ((art.cast("long") * 100 + store) * 100000000 + F.date_format(day, "yyyyMMdd").cast("long")).alias(
            "id_snapshot"
        ),
        art,
        store,
        day,
        ((art * 7 + store * 13 + F.dayofmonth(day)) % 500).cast("int").alias("stock_fisico"),
        F.when(art % 9 == 0, F.lit(None).cast("string"))
        .when(art % 13 == 0, F.lit("N/D"))
        .otherwise((art % 100).cast("string"))
        .alias("stock_transito"),
        (store % 50).cast("int").alias("stock_reservado"),
        (10 + art % 40).cast("int").alias("stock_minimo_config"),
        (100 + art % 500).cast("int").alias("stock_maximo_config"),
    )


def returns(t: dict[str, DataFrame]) -> DataFrame:
    li = t["lineitem"].filter(F.col("l_returnflag") == "R")
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    rid = (F.col("l_orderkey") * 10 + line).cast("long")
    return li.select(
        rid.alias("id_devolucion"),
        F.when(part % 19 == 0, F.lit(-1).cast("long")).otherwise(rid).alias("id_trans_origen"),
        part.cast("int").alias("art_id"),
        (supp % 25).cast("int").alias("id_tienda"),
        F.col("l_shipdate").cast("date").alias("fec_devolucion"),
        (1 + F.col("l_quantity").cast("int") % 2).cast("int").alias("qty_devuelta"),
        pick(line - 1, MOTIVES).alias("motivo_cod"),
        pick(part % 3, RETURN_CHANNELS).alias("canal_devolucion"),
        pick(supp % 3, RETURN_STATES).alias("estado_devolucion"),
        F.col("l_extendedprice").cast(S.MONEY).alias("vr_reembolso"),
    )


BUILDERS = {
    "MSTR_PROVEEDORES": suppliers,
    "MSTR_ARTICULOS": articles,
    "MSTR_TIENDAS": stores,
    "CRM_MIEMBROS": members,
    "TRANS_VENTAS": sales,
    "INV_STOCK_DIARIO": stock,
    "POST_DEVOLUCIONES": returns,
}


class SourceTables(dict):
    """The seven source frames keyed by source table name, each derived on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.given = read_tables(spark, sf_dir)

    def __missing__(self, name: str) -> DataFrame:
        frame = BUILDERS[name](self.given)
        self[name] = frame
        return frame

    def items(self):
        return [(name, self[name]) for name in BUILDERS]


def source_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    """All seven source frames keyed by source table name (derived lazily)."""
    return SourceTables(spark, sf_dir)
