"""Table contracts: source tables (bronze form), control frame and audit tables."""

from __future__ import annotations

from pyspark.sql import types as T

from almacen.operators.constraints import CHECK, DOMAIN, KEY, LENGTH, NOT_NULL, TYPE
from almacen.operators.constraints import Constraint as C


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


INT, LONG, STR, DATE = T.IntegerType(), T.LongType(), T.StringType(), T.DateType()
DBL, BOOL, TS = T.DoubleType(), T.BooleanType(), T.TimestampType()
MONEY = T.DecimalType(12, 2)
WEIGHT = T.DecimalType(8, 2)

SUPPLIERS = _schema(
    ("id_proveedor", INT), ("razon_social", STR), ("pais_origen", STR),
    ("tiempo_repo_dias", INT), ("calificacion_calidad", DBL), ("activo", INT),
)
# Category ids are INT in the source DDL; the level columns are kept as text
# here because loads may deliver codes (the rules compare text, see dims).
ARTICLES = _schema(
    ("art_id", INT), ("cod_barra", STR), ("desc_art", STR), ("id_categ_n1", STR),
    ("id_categ_n2", STR), ("id_categ_n3", INT), ("id_proveedor", INT),
    ("precio_lista", MONEY), ("peso_kg", WEIGHT), ("unid_medida", STR),
    ("activo", INT), ("fec_alta", DATE),
)
STORES = _schema(
    ("id_tienda", INT), ("nom_tienda", STR), ("tipo_tienda", STR), ("id_ciudad", STR),
    ("id_pais", STR), ("metros_cuadrados", INT), ("activo", INT), ("fec_apertura", DATE),
)
MEMBERS = _schema(
    ("id_miembro", INT), ("fec_registro", DATE), ("id_ciudad", STR), ("genero", STR),
    ("rango_edad", STR), ("canal_pref", STR), ("activo", INT), ("fec_ultima_compra", DATE),
)
SALES = _schema(
    ("id_trans", LONG), ("id_miembro", INT), ("id_tienda", INT), ("art_id", INT),
    ("fec_trans", DATE), ("hra_trans", STR), ("qty_vendida", INT),
    ("precio_unitario_venta", MONEY), ("descuento_aplicado", MONEY),
    ("tipo_pago", STR), ("canal_venta", STR),
)
STOCK = _schema(
    ("id_snapshot", LONG), ("art_id", INT), ("id_tienda", INT), ("fec_snapshot", DATE),
    ("stock_fisico", INT), ("stock_transito", INT), ("stock_reservado", INT),
    ("stock_minimo_config", INT), ("stock_maximo_config", INT),
)
RETURNS = _schema(
    ("id_devolucion", LONG), ("id_trans_origen", LONG), ("art_id", INT), ("id_tienda", INT),
    ("fec_devolucion", DATE), ("qty_devuelta", INT), ("motivo_cod", STR),
    ("canal_devolucion", STR), ("estado_devolucion", STR), ("vr_reembolso", MONEY),
)

# source table name -> (contract, primary key)
SOURCES = {
    "MSTR_PROVEEDORES": (SUPPLIERS, "id_proveedor"),
    "MSTR_ARTICULOS": (ARTICLES, "art_id"),
    "MSTR_TIENDAS": (STORES, "id_tienda"),
    "CRM_MIEMBROS": (MEMBERS, "id_miembro"),
    "TRANS_VENTAS": (SALES, "id_trans"),
    "INV_STOCK_DIARIO": (STOCK, "id_snapshot"),
    "POST_DEVOLUCIONES": (RETURNS, "id_devolucion"),
}

# What the source tables promise: primary keys and text lengths of the source DDL, keys that silver relies on,
# and the codes of the reference's source data
CONSTRAINTS = {
    "MSTR_PROVEEDORES": (
        C(KEY, "id_proveedor"), C(NOT_NULL, "id_proveedor"), C(LENGTH, "razon_social", 150), C(LENGTH, "pais_origen", 50),
        C(CHECK, "tiempo_repo_dias", "tiempo_repo_dias >= 0"),
    ),
    "MSTR_ARTICULOS": (
        C(KEY, "art_id"), C(NOT_NULL, "art_id"), C(NOT_NULL, "activo"), C(LENGTH, "cod_barra", 50), C(LENGTH, "desc_art", 200),
        C(LENGTH, "unid_medida", 20), C(CHECK, "precio_lista", "precio_lista >= 0"),
    ),
    "MSTR_TIENDAS": (
        C(KEY, "id_tienda"), C(NOT_NULL, "id_tienda"), C(NOT_NULL, "id_ciudad"), C(LENGTH, "nom_tienda", 100), C(LENGTH, "tipo_tienda", 50),
    ),
    "CRM_MIEMBROS": (
        C(KEY, "id_miembro"), C(NOT_NULL, "id_miembro"), C(NOT_NULL, "genero"), C(DOMAIN, "genero", ("M", "F")), C(LENGTH, "rango_edad", 20),
    ),
    "TRANS_VENTAS": (
        C(KEY, "id_trans"), C(NOT_NULL, "id_trans"), C(NOT_NULL, "id_miembro"), C(NOT_NULL, "id_tienda"),
        C(DOMAIN, "canal_venta", ("Fisico", "Online", "App")), C(LENGTH, "hra_trans", 8), C(CHECK, "art_id", "art_id > 0"),
        C(CHECK, "qty_vendida", "qty_vendida > 0"), C(CHECK, "descuento_aplicado", "descuento_aplicado BETWEEN 0 AND precio_unitario_venta"),
    ),
    "INV_STOCK_DIARIO": (
        C(KEY, "id_snapshot"), C(NOT_NULL, "id_snapshot"), C(TYPE, "stock_transito", "int"), C(CHECK, "stock_fisico", "stock_fisico >= stock_minimo_config"),
    ),
    "POST_DEVOLUCIONES": (
        C(KEY, "id_devolucion"), C(NOT_NULL, "id_devolucion"), C(CHECK, "id_trans_origen", "id_trans_origen > 0"),
        C(DOMAIN, "estado_devolucion", ("APROBADO", "PENDIENTE")), C(LENGTH, "motivo_cod", 50),
    ),
}

CONTROL = _schema(
    ("PkControlCargas", INT), ("EsquemaFuente", STR), ("NombreTablaFuente", STR),
    ("ColumnasArchivoFuente", STR), ("FiltrosArchivoFuente", STR),
    ("EsquemaDestino", STR), ("NombreTablaDestino", STR), ("IndicadorCargaActiva", INT),
)
LOAD_AUDIT = _schema(
    ("IdLote", STR), ("NombreTablaDestino", STR), ("NombreTablaFuente", STR),
    ("Estado", STR), ("RegistrosCopiados", LONG), ("MensajeError", STR), ("FechaRegistro", TS),
)
QUALITY = _schema(
    ("execution_id", STR), ("table_name", STR), ("total_records", LONG),
    ("duplicate_records", LONG), ("accepted_records", LONG), ("rejected_records", LONG),
    ("conversion_failures", LONG), ("pct_conformed", DBL), ("null_analysis", STR), ("processed_at", TS),
)
