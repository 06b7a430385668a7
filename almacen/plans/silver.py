"""Silver: typed, deduplicated, standardised source tables (SV)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen import schemas as S
from almacen.config import DEFAULT_SILVER, FAILURES, ROWS, UNKNOWN_KEY, SilverConfig
from almacen.functions.columns import flag_with_default, hash_pii, map_values, net_amount, normalise_text
from almacen.operators.contract import apply_contract, failure_count
from almacen.operators.dedupe import dedupe_latest
from almacen.operators.impute import impute_from_group
from almacen.operators.integrity import Reference, check_references


# columns whose nulls the audit counts
NULL_COLUMNS = {
    "CRM_MIEMBROS": ("genero", "rango_edad", "activo"),
    "MSTR_ARTICULOS": ("id_proveedor", "activo"),
    "MSTR_PROVEEDORES": ("pais_origen",),
    "MSTR_TIENDAS": ("id_ciudad", "id_pais"),
    "TRANS_VENTAS": ("id_miembro", "id_tienda", "descuento_aplicado"),
    "INV_STOCK_DIARIO": ("stock_transito",),
    "POST_DEVOLUCIONES": ("id_trans_origen",),
}

Watch = Callable[[DataFrame], DataFrame]


def typed_unique(df: DataFrame, table: str, order_by: Sequence[str] = (), watch: Watch | None = None) -> DataFrame:
    """Contract types (lenient) then one row per primary key, newest first.

    ``watch`` sees the result with two more columns, the number of source rows
    behind each row and of their values that did not convert, before they go.
    """
    if watch is None and ROWS not in df.columns:
        schema, key = S.SOURCES[table]
        typed = df.drop(FAILURES) if FAILURES in df.columns else apply_contract(df, schema)
        return dedupe_latest(typed, [key], order_by)
    counted = counted_unique(df, table, order_by)
    return (counted if watch is None else watch(counted)).drop(ROWS, FAILURES)


def counted_types(df: DataFrame, table: str) -> DataFrame:
    """Contract types and ``_failures``; a frame that has ``_failures`` (``bronze.read_days``) is typed already."""
    schema, _ = S.SOURCES[table]
    return df if FAILURES in df.columns else apply_contract(df.withColumn(FAILURES, failure_count(df, schema)), schema)


def counted_unique(df: DataFrame, table: str, order_by: Sequence[str] = ()) -> DataFrame:
    """:func:`typed_unique` with the columns ``_rows`` and ``_failures`` that the audit adds up.

    A frame that has ``_rows`` comes from the kept state (:mod:`almacen.plans.incremental`): it is unique already.
    """
    if ROWS in df.columns:
        return df
    _, key = S.SOURCES[table]
    return dedupe_latest(counted_types(df, table), [key], order_by, count_as=ROWS, sums=[FAILURES])


def members(raw: DataFrame, cfg: SilverConfig = DEFAULT_SILVER, order_by: Sequence[str] = ()) -> DataFrame:
    """CRM_MIEMBROS: dedupe, age imputation by channel, gender, PII hash, dates, flag."""
    df = typed_unique(raw, "CRM_MIEMBROS", order_by)
    df = impute_from_group(df, "rango_edad", "canal_pref", "id_miembro", cfg.age_default)
    return df.select(
        *[c for c in df.columns if c not in ("genero", "activo")],
        map_values("genero", cfg.gender_rules, cfg.gender_default).alias("genero"),
        hash_pii("id_miembro", cfg.pii_salt).alias("id_miembro_hash"),
        flag_with_default("activo", True).alias("activo"),
    )


def products(raw: DataFrame, order_by: Sequence[str] = (), watch: Watch | None = None) -> DataFrame:
    """MSTR_ARTICULOS: dedupe, typed (money kept decimal), active flag."""
    df = typed_unique(raw, "MSTR_ARTICULOS", order_by, watch)
    return df.withColumn("activo", flag_with_default("activo", True))


def suppliers(raw: DataFrame, order_by: Sequence[str] = (), watch: Watch | None = None) -> DataFrame:
    return typed_unique(raw, "MSTR_PROVEEDORES", order_by, watch)


def stores(raw: DataFrame, order_by: Sequence[str] = (), watch: Watch | None = None) -> DataFrame:
    df = typed_unique(raw, "MSTR_TIENDAS", order_by, watch)
    return df.withColumn("tipo_tienda", normalise_text("tipo_tienda")).withColumn(
        "metros_cuadrados", F.col("metros_cuadrados").cast("double")
    )


def sales_clean(raw: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """TRANS_VENTAS: dedupe, typed, discount 0 when missing, net amount (exact decimal)."""
    return with_net_amount(typed_unique(raw, "TRANS_VENTAS", order_by))


def with_net_amount(df: DataFrame) -> DataFrame:
    """Discount 0 when missing, and the net amount ``vr_total_trans``."""
    disc = F.coalesce(F.col("descuento_aplicado"), F.lit(0).cast(S.MONEY)).cast(S.MONEY)
    return df.withColumn("descuento_aplicado", disc).withColumn(
        "vr_total_trans", net_amount("qty_vendida", "precio_unitario_venta", "descuento_aplicado")
    )


def sales_references(products_df: DataFrame, stores_df: DataFrame) -> list[Reference]:
    return [
        Reference("art_id", products_df, "art_id", "art"),
        Reference("id_tienda", stores_df, "id_tienda", "tienda", hot=(UNKNOWN_KEY,)),
    ]


def sales_split(
    clean: DataFrame,
    products_df: DataFrame,
    stores_df: DataFrame,
    cfg: SilverConfig = DEFAULT_SILVER,
    run_id: str | None = None,
    run_ts=None,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): article and store must exist; each row has one outcome."""
    return check_references(
        clean,
        "id_trans",
        sales_references(products_df, stores_df),
        cfg.reject_reason,
        cfg.null_key_reason,
        run_id,
        run_ts,
        cfg.reject_detail,
    )


def stock(raw: DataFrame, order_by: Sequence[str] = (), watch: Watch | None = None) -> DataFrame:
    df = typed_unique(raw, "INV_STOCK_DIARIO", order_by, watch)
    for c in ("stock_fisico", "stock_transito", "stock_reservado"):
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return df


def returns(raw: DataFrame, order_by: Sequence[str] = (), watch: Watch | None = None) -> DataFrame:
    df = typed_unique(raw, "POST_DEVOLUCIONES", order_by, watch)
    return df.withColumn("motivo_cod", normalise_text("motivo_cod"))
