"""

Every query reads the given test tables (via the derived source frames of
``almacen.sources.testdata``) and returns a lazy DataFrame. Money leaves as
double (exact decimal inside); clock columns (run id, run time) are left out.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen import schemas as S
from almacen.config import DEFAULT_GOLD, DEFAULT_SILVER, FAILURES, INGEST_TS, GoldConfig, SilverConfig
from almacen.functions import privacy
from almacen.functions.columns import edge
from almacen.operators.constraints import violations
from almacen.operators.contract import apply_contract
from almacen.operators.dedupe import dedupe_latest
from almacen.operators import heavy
from almacen.operators.impute import impute_from_group
from almacen.operators.integrity import accepted_condition, flag_references
from almacen.operators.joins import salted_left_join
from almacen.operators.quality import null_counts, quality_metrics
from almacen.plans import dims, facts, incremental, kpis, rfm, rolling, silver
from almacen.session import checkpoint_dir, reliable_checkpoint
from almacen.sources import bronze
from almacen.sources.sinks import put_rows
from almacen.sources.testdata import SALES_HELPERS, source_tables

# Dedupe order of the fixture tables: the ingest-time stand-in first, then the
# remaining columns (all descending, nulls last); FIXTURES.md section 2.
SALES_ORDER = (
    "x_ship", "art_id", "x_supp", "id_tienda", "id_miembro", "fec_trans", "qty_vendida",
    "precio_unitario_venta", "descuento_aplicado", "tipo_pago", "canal_venta",
)
RETURNS_ORDER = ("fec_devolucion",)

# Fixed run context of the registered queries (no clock in compared output).
QUERY_RUN_ID = "EXEC_QUERY"
QUERY_RUN_TS = dt.datetime(2000, 1, 1)
SECOND_DAY = dt.date(1997, 1, 1)  # sales shipped from here on are the second ingest day of the incremental queries


class Layers:
    """Lazily built silver and gold frames over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, scfg: SilverConfig = DEFAULT_SILVER,
                 gcfg: GoldConfig = DEFAULT_GOLD):
        self.spark, self.sf_dir, self.scfg, self.gcfg = spark, sf_dir, scfg, gcfg
        self.src = source_tables(spark, sf_dir)

    # silver -------------------------------------------------------------
    @cached_property
    def members(self) -> DataFrame:
        return silver.members(self.src["CRM_MIEMBROS"], self.scfg)

    @cached_property
    def products(self) -> DataFrame:
        return silver.products(self.src["MSTR_ARTICULOS"])

    @cached_property
    def suppliers(self) -> DataFrame:
        return silver.suppliers(self.src["MSTR_PROVEEDORES"])

    @cached_property
    def stores(self) -> DataFrame:
        return silver.stores(self.src["MSTR_TIENDAS"])

    @cached_property
    def sales_clean(self) -> DataFrame:
        return silver.sales_clean(self.src["TRANS_VENTAS"], SALES_ORDER)

    @cached_property
    def sales_split(self) -> tuple[DataFrame, DataFrame]:
        acc, rej = silver.sales_split(self.sales_clean, self.products, self.stores, self.scfg)
        return acc.drop(*SALES_HELPERS), rej.drop(*SALES_HELPERS)

    @property
    def sales(self) -> DataFrame:
        return self.sales_split[0]

    @cached_property
    def stock(self) -> DataFrame:
        return silver.stock(self.src["INV_STOCK_DIARIO"])

    @cached_property
    def returns(self) -> DataFrame:
        return silver.returns(self.src["POST_DEVOLUCIONES"], RETURNS_ORDER)

    # gold ---------------------------------------------------------------
    @cached_property
    def ref_date(self):
        return rfm.reference_date(self.sales, self.gcfg.as_of)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dims.dim_products(self.products, self.suppliers, self.gcfg)

    @cached_property
    def dim_stores(self) -> DataFrame:
        return dims.dim_stores(self.stores, self.gcfg)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dims.dim_customers(self.members, self.ref_date, self.gcfg.keep_raw_member_id)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return facts.fact_sales(self.sales, self.members)

    @cached_property
    def daily(self) -> DataFrame:
        return facts.daily_consumption(self.sales)

    def consumption(self, mode: str = "all") -> DataFrame:
        return facts.consumption_average(self.daily, mode=mode, days=self.gcfg.consumption_days)

    @cached_property
    def fact_inventory(self) -> DataFrame:
        return facts.fact_inventory_of_days(self.stock, self.daily, self.gcfg)

    @cached_property
    def fact_returns(self) -> DataFrame:
        return facts.fact_returns(self.returns, self.sales, self.members, self.products, self.gcfg)

    @cached_property
    def member_days(self) -> DataFrame:
        """Checkpointed once: the reference date and the RFM base both read it, the sales are read once."""
        return reliable_checkpoint(rfm.member_days(self.sales))

    def _base(self, with_ref: bool) -> DataFrame:
        ref = rfm.reference_date(self.member_days, self.gcfg.as_of)
        return rfm.base_of_days(self.member_days, ref, self.gcfg.rfm_days, self.gcfg.rfm_include_anonymous, with_ref)

    @cached_property
    def rfm_base(self) -> DataFrame:
        return self._base(with_ref=False)

    @cached_property
    def rfm_scored(self) -> DataFrame:
        """Scores over a base that carries its reference date; the keyed frame is checkpointed once."""
        return rfm.rfm_scores(self._base(with_ref=True), self.gcfg.rfm_tiles, materialize=reliable_checkpoint)

    @cached_property
    def rfm_scores(self) -> DataFrame:
        return self.rfm_scored.drop("fec_calculo_rfm")

    @cached_property
    def rfm_segments(self) -> DataFrame:
        return rfm.rfm_segments(self.rfm_scored, self.members, None, self.gcfg)


def _q(build: Callable[[Layers], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return edge(build(Layers(spark, sf_dir)))

    run.__doc__ = build.__doc__
    return run


# --- bronze ---------------------------------------------------------------
BRONZE_RUN = bronze.RunInfo("RUN_QUERY", QUERY_RUN_TS)


def _loads(x: Layers) -> list[bronze.Load]:
    return bronze.collect_loads(bronze.active_loads(bronze.example_control(x.spark)))


def q_bronze_extract(x: Layers) -> DataFrame:
    """Control table -> active loads -> configured column list, filter and lineage of the sales load."""
    load = next(ld for ld in _loads(x) if ld.source_table == "TRANS_VENTAS")
    return bronze.extract(x.src[load.source_table], load, BRONZE_RUN)


def _scratch(x: Layers, name: str) -> str:
    return f"{checkpoint_dir(x.spark).rstrip('/')}/almacen/{name}-{uuid.uuid4().hex}"


def q_bronze_load_audit(x: Layers) -> DataFrame:
    """The audit that the loop leaves: status and rows copied of each active load, one of which has no source.

    The run is repeated, as after a failure: its rows are replaced, not added to.
    """
    root = _scratch(x, "bronze")
    broken = [(90, "dbo", "SIN_FUENTE", "*", None, "bronze", "SIN_FUENTE", 1)]
    control = bronze.example_control(x.spark).unionByName(x.spark.createDataFrame(broken, S.CONTROL))
    keys = ("IdLote", "NombreTablaDestino")
    for _ in range(2):
        try:
            bronze.load_all(x.spark, control, lambda load: x.src[load.source_table], root, BRONZE_RUN, QUERY_RUN_TS.date(),
                            lambda row: put_rows(row, f"{root}/audit", keys, as_path=True))
        except bronze.LoadFailed:  # the audit has it
            pass
    audit = x.spark.read.parquet(f"{root}/audit")
    return audit.select(*keys, "NombreTablaFuente", "Estado", "RegistrosCopiados", F.col("MensajeError").isNotNull().alias("ConError"))


def q_bronze_days_by_contract(x: Layers) -> DataFrame:
    """Two days of stock snapshots, in transit as a number on the first day and as text on the second, read by the contract."""
    root, table = _scratch(x, "bronze"), "INV_STOCK_DIARIO"
    even = F.col("art_id") % 2 == 0
    number = x.src[table].where(even).withColumn("stock_transito", F.col("stock_transito").try_cast("int"))
    bronze.write_raw(number, root, table, dt.date(2000, 1, 1))
    bronze.write_raw(x.src[table].where(~even), root, table, dt.date(2000, 1, 2))
    out = bronze.read_days(x.spark, root, table, S.STOCK)
    return out.select("id_snapshot", "art_id", "stock_transito", "stock_fisico", bronze.PARTITION_COL, F.col(FAILURES).alias("sin_convertir"))


def q_bronze_lenient_cast(x: Layers) -> DataFrame:
    """Sales delivered as text, some of it spoiled, typed back by the contract with try_cast (bad values become null)."""
    text = x.src["TRANS_VENTAS"].drop(*SALES_HELPERS)
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    art = F.col("art_id").cast("int")
    text = text.withColumns({
        "qty_vendida": F.when(art % 101 == 0, F.lit("x1")).otherwise(F.col("qty_vendida")),
        "fec_trans": F.when(art % 103 == 0, F.lit("2024-13-45")).otherwise(F.col("fec_trans")),
    })
    return apply_contract(text, S.SALES)


# --- silver ---------------------------------------------------------------
def q_silver_dedupe_latest(x: Layers) -> DataFrame:
    """Sales deduplicated by id_trans, newest ingest first."""
    return dedupe_latest(x.src["TRANS_VENTAS"], ["id_trans"], SALES_ORDER).drop(*SALES_HELPERS)


def q_silver_members(x: Layers) -> DataFrame:
    return x.members


def q_silver_impute_partition(x: Layers) -> DataFrame:
    """Age range imputed from the member's channel (donor: least member id), default 30-45."""
    raw = x.src["CRM_MIEMBROS"].select("id_miembro", "canal_pref", "rango_edad")
    out = impute_from_group(raw, "rango_edad", "canal_pref", "id_miembro", x.scfg.age_default)
    return out.join(raw.select("id_miembro", F.col("rango_edad").alias("rango_edad_origen")), "id_miembro")


def q_silver_products(x: Layers) -> DataFrame:
    return x.products


def q_silver_suppliers(x: Layers) -> DataFrame:
    return x.suppliers


def q_silver_stores(x: Layers) -> DataFrame:
    return x.stores


def q_silver_sales(x: Layers) -> DataFrame:
    return x.sales_clean.drop(*SALES_HELPERS)


def q_incremental_silver_sales(x: Layers) -> DataFrame:
    """Sales of two ingest days, the second merged into the state that the first left: as if all had been read at once."""
    path, early = _scratch(x, "estado"), F.coalesce(F.col("x_ship") < F.lit(SECOND_DAY), F.lit(True))
    raw = x.src["TRANS_VENTAS"]
    for day, rows in ((dt.date(2000, 1, 1), raw.where(early)), (dt.date(2000, 1, 2), raw.where(~early))):
        stamped = rows.withColumns({INGEST_TS: F.lit(day).cast("timestamp"), bronze.PARTITION_COL: F.lit(day)})
        incremental.merge_days(stamped, "TRANS_VENTAS", path, 16, SALES_ORDER)
    clean = silver.sales_clean(incremental.current(x.spark, "TRANS_VENTAS", path), SALES_ORDER)
    return clean.drop(*SALES_HELPERS, INGEST_TS, bronze.PARTITION_COL)


def q_silver_ri_accepted(x: Layers) -> DataFrame:
    return x.sales


def q_silver_ri_rejected(x: Layers) -> DataFrame:
    return x.sales_split[1].drop("execution_id", "rejected_at")


def q_silver_stock(x: Layers) -> DataFrame:
    return x.stock


def q_silver_returns(x: Layers) -> DataFrame:
    return x.returns


def quality_frames(x: Layers) -> list[DataFrame]:
    """One single-pass audit row per source table (sales: split flags on the deduped rows)."""
    out = []
    for table, frame in x.src.items():
        order = SALES_ORDER if table == "TRANS_VENTAS" else RETURNS_ORDER if table == "POST_DEVOLUCIONES" else ()
        deduped = silver.counted_unique(frame, table, order)
        ok = None
        if table == "TRANS_VENTAS":
            refs = silver.sales_references(x.products, x.stores)
            deduped = flag_references(deduped, "id_trans", refs)
            ok = accepted_condition(refs)
        out.append(quality_metrics(table, deduped, silver.ROWS, ok, silver.NULL_COLUMNS[table], QUERY_RUN_ID,
                                   QUERY_RUN_TS, silver.FAILURES))
    return out


def q_dq_metrics(x: Layers) -> DataFrame:
    """One audit row per source table: total, duplicates, accepted, rejected, bad values, pct, null analysis."""
    frames = quality_frames(x)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.drop("execution_id", "processed_at")


def q_dq_null_counts(x: Layers) -> DataFrame:
    """Nulls per column of every raw source table, long form (table, column, nulls)."""
    out = None
    for table, frame in x.src.items():
        cols = [c for c in frame.columns if c not in SALES_HELPERS]
        counts = null_counts(frame, cols)
        long = counts.unpivot([], [f"null_{c}" for c in cols], "columna", "nulos").select(
            F.lit(table).alias("tabla"), F.regexp_replace("columna", "^null_", "").alias("columna"), "nulos"
        )
        out = long if out is None else out.unionByName(long)
    return out


def q_dq_constraints(x: Layers) -> DataFrame:
    """Rows of every raw source table that break what the table promises."""
    frames = [violations(frame, table, S.CONSTRAINTS[table]) for table, frame in x.src.items()]
    return reduce(DataFrame.unionByName, frames)


# --- dimensions -------------------------------------------------------------
def q_dim_products(x: Layers) -> DataFrame:
    return x.dim_products


def q_dim_stores(x: Layers) -> DataFrame:
    return x.dim_stores


def q_dim_customers(x: Layers) -> DataFrame:
    return x.dim_customers


def q_dim_date(x: Layers) -> DataFrame:
    return dims.dim_date(x.sales, "fec_trans")


def q_mask_customers(x: Layers) -> DataFrame:
    return dims.mask_columns(x.dim_customers, ["id_miembro_bk"])


QUERY_KEYS = privacy.Keys({"v1": b"clave de ejemplo", "v2": b"otra clave, mas larga que un bloque de sesenta y cuatro bytes, de ejemplo"}, "v1")
CUSTOMER_POLICY = {
    "id_miembro_bk": privacy.PSEUDONYM, "canal_pref": privacy.MASK, "fec_registro": privacy.MONTH, "genero": privacy.KEEP,
    "rango_edad": privacy.KEEP, "fec_ultima_compra": privacy.DROP,
}


def q_pseudonymised_customers(x: Layers) -> DataFrame:
    """Customers by policy, with keyed pseudonyms of the first key and, after rotation, of the second."""
    first = privacy.apply_policy(x.dim_customers, CUSTOMER_POLICY, QUERY_KEYS)
    walk = privacy.crosswalk(x.members, "id_miembro", QUERY_KEYS, "v1", "v2")
    return privacy.rotate(first.withColumn("seudonimo_v1", F.col("id_miembro_bk")), "id_miembro_bk", walk)


# --- aggregates and windows ---------------------------------------------------
def q_agg_daily_consumption(x: Layers) -> DataFrame:
    return x.daily


def q_agg_reference_date(x: Layers) -> DataFrame:
    return x.spark.range(1).select(x.ref_date.alias("fecha_referencia"))


def q_win_avg_whole(x: Layers) -> DataFrame:
    return x.consumption("all")


def q_win_avg_14d(x: Layers) -> DataFrame:
    return x.consumption("trailing")


def q_win_avg_14d_category(x: Layers) -> DataFrame:
    """Trailing 14-day average per level-1 category and store, a grain at which most windows hold several days."""
    keys = ("id_categ_n1", "id_tienda")
    sold = x.sales.join(x.products.select(F.col("art_id").alias("_a_id"), "id_categ_n1"), F.col("art_id") == F.col("_a_id"))
    return facts.consumption_average(facts.daily_consumption(sold, keys), keys, mode="trailing", days=x.gcfg.consumption_days)


# --- facts ----------------------------------------------------------------
def q_fact_sales(x: Layers) -> DataFrame:
    return x.fact_sales


def q_fact_inventory(x: Layers) -> DataFrame:
    return x.fact_inventory


def q_fact_returns(x: Layers) -> DataFrame:
    return x.fact_returns


def q_join_heavy_hitters(x: Layers) -> DataFrame:
    """Returns of which every third names one and the same sale, with that sale's price and channel.

    The hot key is not known beforehand: a sketch of the returns finds it (one aggregate), and
    the join salts it by its share.
    """
    sale = x.returns.where("id_trans_origen > 0").select(F.min("id_trans_origen")).scalar()
    origin = F.when(F.col("id_devolucion") % 3 == 0, sale).otherwise(F.col("id_trans_origen"))
    returns = reliable_checkpoint(x.returns.select("id_devolucion", origin.alias("id_trans_origen"), "vr_reembolso"))
    sold = x.sales.select(F.col("id_trans").alias("_v_id"), "precio_unitario_venta", "canal_venta")
    hot = heavy.measure(returns, "id_trans_origen")
    return salted_left_join(returns, sold, "id_trans_origen", "_v_id", row_id=["id_devolucion"], hot=hot).drop("_v_id")


# --- RFM ------------------------------------------------------------------
def q_rfm_base(x: Layers) -> DataFrame:
    return x.rfm_base


def q_incremental_rfm_base(x: Layers) -> DataFrame:
    """The base rolled forward over three batches of sales, some of which come a batch or two late."""
    path = _scratch(x, "rfm")
    sales = reliable_checkpoint(x.sales.select("id_trans", "id_miembro", "fec_trans", "vr_total_trans"))
    late = F.col("id_trans") % 50 == 0
    batch = F.when(F.col("fec_trans") < dt.date(2001, 5, 20), F.when(late, 3).otherwise(1))
    batch = batch.when(F.col("fec_trans") < dt.date(2001, 7, 10), 2).otherwise(3)
    for i in (1, 2, 3):
        rolling.advance(x.spark, path, sales.where(batch == i), f"2001-0{i}", x.gcfg.rfm_days)
    return rolling.rolled_base(x.spark, path)


def q_rfm_scores(x: Layers) -> DataFrame:
    return x.rfm_scores


def q_rfm_segments(x: Layers) -> DataFrame:
    return x.rfm_segments


def q_rfm_churn_flag(x: Layers) -> DataFrame:
    return rfm.churn_flag(x.rfm_segments)


# --- inventory rules, KPIs, views ---------------------------------------------
def q_inventory_low_stock(x: Layers) -> DataFrame:
    return kpis.low_stock(x.fact_inventory)


def q_inventory_leadtime_risk(x: Layers) -> DataFrame:
    return kpis.leadtime_risk(x.fact_inventory, x.dim_products)


def q_kpi_gross_margin(x: Layers) -> DataFrame:
    return kpis.gross_margin(x.sales, x.products)


def q_kpi_discount_by_channel(x: Layers) -> DataFrame:
    return kpis.discount_by_channel(x.sales)


def q_kpi_stock_coverage_30d(x: Layers) -> DataFrame:
    return kpis.stock_coverage(x.stock, x.sales, x.ref_date, 30)


def q_kpi_avg_ticket(x: Layers) -> DataFrame:
    return kpis.avg_ticket(x.sales, x.products)


def q_kpi_conversion(x: Layers) -> DataFrame:
    return kpis.conversion(x.src.given["events"])


def q_kpi_ordered_conversion(x: Layers) -> DataFrame:
    """Sessions in which a purchase came after a view, by the day the session began. Twelve hours without an event end a
    session, as the given users act a few times a day."""
    return kpis.ordered_conversion(x.src.given["events"], gap_minutes=720)


def q_kpi_returns_root_cause(x: Layers) -> DataFrame:
    return kpis.returns_root_cause(x.fact_returns, x.dim_products)


def q_view_store_daily(x: Layers) -> DataFrame:
    return kpis.store_daily(x.fact_sales)


def q_view_daily_sales(x: Layers) -> DataFrame:
    return kpis.daily_sales(x.fact_sales, x.dim_stores, x.dim_products)


def q_view_rfm_segments(x: Layers) -> DataFrame:
    return kpis.segment_summary(x.rfm_segments)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: _q(fn) for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
