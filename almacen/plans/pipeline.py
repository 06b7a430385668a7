"""Stage runner: bronze -> silver -> gold, each layer written once (PL, SV, GD).

Pure plan functions live in the other modules; this is the thin layer that
makes the run id and run time once, writes every table, appends the audit
rows, and reads each written layer back, so every stage starts from stored
tables (lineage is cut at each layer and a lost executor recomputes at most
one stage).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from almacen import schemas as S
from almacen.config import (
    DEFAULT_GOLD,
    DEFAULT_SILVER,
    GOLD_RUN_FORMAT,
    SILVER_RUN_FORMAT,
    GoldConfig,
    RunContext,
    SilverConfig,
)
from almacen.functions.columns import edge
from almacen.operators import heavy
from almacen.operators.integrity import accepted_condition, flag_references, split_flagged
from almacen.operators.quality import quality_aggregates, quality_row
from almacen.plans import dims, facts, incremental, rfm, silver
from almacen.session import reliable_checkpoint, tune
from almacen.sources import bronze
from almacen.sources.sinks import append_rows, put_rows, read_table, write_table

# silver table name per source table
SILVER_TABLES = {
    "CRM_MIEMBROS": "crm_miembros",
    "MSTR_ARTICULOS": "mstr_articulos",
    "MSTR_PROVEEDORES": "mstr_proveedores",
    "MSTR_TIENDAS": "mstr_tiendas",
    "TRANS_VENTAS": "trans_ventas",
    "INV_STOCK_DIARIO": "inv_stock_diario",
    "POST_DEVOLUCIONES": "post_devoluciones",
}
QUALITY_TABLE = "data_quality_metrics"
REJECTS_TABLE = "silver_rejected_records"
LOADS_TABLE = "bronze_load_audit"
# join keys that hold a large share of a silver table's rows, measured when it is written
HOT_TABLE = "silver_hot_keys"
HOT_COLUMNS = {"TRANS_VENTAS": ("id_miembro",), "POST_DEVOLUCIONES": ("id_trans_origen",)}


@dataclass
class Store:
    """Where layers are written: a folder of Parquet tables, or catalog tables.

    With catalog tables, ``buckets`` maps a table to ``(n, keys)``: tables
    bucketed on their join keys with the same ``n`` are joined without a shuffle
    (``CO_LOCATED`` below: sales by ``id_trans`` and returns by
    ``id_trans_origen`` for ``fact_returns``).
    """

    root: str
    fmt: str = "parquet"
    as_path: bool = True
    buckets: dict[str, tuple[int, tuple[str, ...]]] = field(default_factory=dict)

    def target(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}" if self.as_path else name

    def write(self, df: DataFrame, name: str, mode: str = "overwrite") -> None:
        bucket = None if self.as_path else self.buckets.get(name)
        write_table(df, self.target(name), mode=mode, fmt=self.fmt, as_path=self.as_path, bucket_by=bucket)

    def append(self, df: DataFrame, name: str) -> None:
        append_rows(df, self.target(name), fmt=self.fmt, as_path=self.as_path)

    def put(self, df: DataFrame, name: str, keys: Sequence[str]) -> None:
        """Audit rows by run: a repeated run replaces its own."""
        put_rows(df, self.target(name), keys, fmt=self.fmt, as_path=self.as_path)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return read_table(spark, self.target(name), fmt=self.fmt, as_path=self.as_path)


def co_located(n: int) -> dict[str, tuple[int, tuple[str, ...]]]:
    """Bucket layout for catalog stores: sales and returns on the returns join key.

    Opt-in: the join then reads both sides without a shuffle, but AQE cannot
    split a bucket, so use it only when no single origin id holds a large share
    of the returns; the default unbucketed layout keeps AQE skew-join splitting.
    """
    return {"trans_ventas": (n, ("id_trans",)), "post_devoluciones": (n, ("id_trans_origen",))}


@dataclass
class SilverResult:
    run: RunContext
    written: list[str] = field(default_factory=list)
    hot: list[tuple] = field(default_factory=list)  # (table, column, key, share of the rows)

    def heavy(self, table: str, found: dict) -> None:
        for column in HOT_COLUMNS.get(table, ()):
            self.hot += [(SILVER_TABLES[table], column, str(k), s) for k, s in heavy.shares(found, column).items()]


def hot_keys(spark: SparkSession, store: Store, table: str, column: str) -> dict[int, float]:
    """The keys of one column that were heavy when ``table`` was written; at most 1 / ``heavy.SHARE`` of them."""
    rows = store.read(spark, HOT_TABLE).where((F.col("tabla") == table) & (F.col("columna") == column))
    return {int(r["llave"]): r["proporcion"] for r in rows.select("llave", "proporcion").collect()}


def run_silver(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    store: Store,
    run: RunContext | None = None,
    cfg: SilverConfig = DEFAULT_SILVER,
    order_by: dict[str, tuple[str, ...]] | None = None,
) -> SilverResult:
    """Clean every source table, write it, append its quality row; sales also write rejects.

    Every table is read once: the audit counts of the masters, stock and returns
    are observed on the write itself. Members are read twice, as their donors come from the
    whole table. Sales are deduplicated and flagged once and checkpointed; the
    accepted table, the rejects and the quality row come from the checkpoint.
    """
    run = run or RunContext.now()
    order_by = order_by or {}
    out = SilverResult(run)

    def audit(counts: DataFrame, table: str) -> None:
        nulls = silver.NULL_COLUMNS[table]
        store.put(quality_row(table, counts, nulls, run.run_id, run.run_ts), QUALITY_TABLE, ("execution_id", "table_name"))

    watched = {
        "MSTR_ARTICULOS": silver.products,
        "MSTR_PROVEEDORES": silver.suppliers,
        "MSTR_TIENDAS": silver.stores,
        "INV_STOCK_DIARIO": silver.stock,
        "POST_DEVOLUCIONES": silver.returns,
    }
    for table, build in watched.items():
        seen = Observation()
        aggregates = quality_aggregates(silver.ROWS, None, silver.NULL_COLUMNS[table], silver.FAILURES)
        sketches = heavy.metrics(HOT_COLUMNS[table]) if table in HOT_COLUMNS else []
        frame = build(sources[table], order_by.get(table, ()), lambda df: df.observe(seen, *aggregates, *sketches))
        store.write(frame, SILVER_TABLES[table])
        out.written.append(SILVER_TABLES[table])
        found = seen.get
        out.heavy(table, found)
        counts = {name: n for name, n in found.items() if name != "_all" and not name.startswith("_heavy_")}
        schema = ", ".join(f"{name} long" for name in counts)
        audit(spark.createDataFrame([tuple(counts.values())], schema), table)

    order = order_by.get("CRM_MIEMBROS", ())
    store.write(silver.members(sources["CRM_MIEMBROS"], cfg, order), SILVER_TABLES["CRM_MIEMBROS"])
    out.written.append(SILVER_TABLES["CRM_MIEMBROS"])
    counted = silver.counted_unique(sources["CRM_MIEMBROS"], "CRM_MIEMBROS", order)
    aggregates = quality_aggregates(silver.ROWS, None, silver.NULL_COLUMNS["CRM_MIEMBROS"], silver.FAILURES)
    audit(counted.agg(*aggregates), "CRM_MIEMBROS")

    refs = silver.sales_references(store.read(spark, "mstr_articulos"), store.read(spark, "mstr_tiendas"))
    counted = silver.counted_unique(sources["TRANS_VENTAS"], "TRANS_VENTAS", order_by.get("TRANS_VENTAS", ()))
    flagged = reliable_checkpoint(flag_references(counted, "id_trans", refs))
    typed = silver.with_net_amount(flagged)
    columns = [*(c for c in counted.columns if c not in (silver.ROWS, silver.FAILURES)), "vr_total_trans"]
    accepted, rejected = split_flagged(
        typed, columns, refs, cfg.reject_reason, cfg.null_key_reason, run.run_id, run.run_ts, cfg.reject_detail
    )
    accepted, seen = heavy.watch(accepted, HOT_COLUMNS["TRANS_VENTAS"])
    store.write(accepted, SILVER_TABLES["TRANS_VENTAS"])
    out.written.append(SILVER_TABLES["TRANS_VENTAS"])
    out.heavy("TRANS_VENTAS", seen.get)
    store.put(rejected, REJECTS_TABLE, ("execution_id",))
    ok, nulls = accepted_condition(refs), silver.NULL_COLUMNS["TRANS_VENTAS"]
    audit(flagged.agg(*quality_aggregates(silver.ROWS, ok, nulls, silver.FAILURES)), "TRANS_VENTAS")
    store.write(spark.createDataFrame(out.hot, "tabla string, columna string, llave string, proporcion double"), HOT_TABLE)
    return out


GOLD_TABLES = ("dim_productos", "dim_tiendas", "dim_clientes", "dim_tiempo", "fact_ventas", "fact_inventario",
               "fact_devoluciones", "fact_rfm_clientes")


def run_gold(
    spark: SparkSession,
    store: Store,
    cfg: GoldConfig = DEFAULT_GOLD,
    run: RunContext | None = None,
    money: Callable[[DataFrame], DataFrame] | None = None,
) -> RunContext:
    """Build and write the star schema and RFM from the stored silver tables.

    The reference date is computed once and written with the RFM table; money
    columns are cast to double at the edge unless ``money`` says otherwise.
    """
    run = run or RunContext.now(GOLD_RUN_FORMAT)
    cast = money or edge
    t = {name: store.read(spark, name) for name in SILVER_TABLES.values()}
    sales, members = t["trans_ventas"], t["crm_miembros"]
    ref = rfm.reference_date(sales, cfg.as_of)
    hot_members = hot_keys(spark, store, "trans_ventas", "id_miembro")

    store.write(cast(dims.dim_products(t["mstr_articulos"], t["mstr_proveedores"], cfg)), "dim_productos")
    store.write(cast(dims.dim_stores(t["mstr_tiendas"], cfg)), "dim_tiendas")
    store.write(cast(dims.dim_customers(members, ref, cfg.keep_raw_member_id)), "dim_clientes")
    store.write(dims.dim_date(sales, "fec_trans"), "dim_tiempo")
    store.write(cast(facts.fact_sales(sales, members, hot_members)), "fact_ventas")
    inventory = facts.fact_inventory_of_days(t["inv_stock_diario"], facts.daily_consumption(sales), cfg)
    store.write(cast(inventory), "fact_inventario")
    returned = facts.fact_returns(
        t["post_devoluciones"], sales, members, t["mstr_articulos"], cfg,
        hot_keys(spark, store, "post_devoluciones", "id_trans_origen"), hot_members, "post_devoluciones" in store.buckets,
    )
    store.write(cast(returned), "fact_devoluciones")

    store.write(cast(rfm.rfm(sales, members, cfg, reliable_checkpoint)), "fact_rfm_clientes")
    return run


def run_medallion(
    spark: SparkSession,
    sources: dict[str, DataFrame] | None,
    root: str,
    scfg: SilverConfig = DEFAULT_SILVER,
    gcfg: GoldConfig = DEFAULT_GOLD,
    order_by: dict[str, tuple[str, ...]] | None = None,
    now: dt.datetime | None = None,
    store: Store | None = None,
    control: DataFrame | None = None,
    read_source: Callable[[bronze.Load], DataFrame] | None = None,
    audit: Callable[[DataFrame], None] | None = None,
    buckets: int | None = None,
) -> Store:
    """Bronze, silver, gold in sequence, into ``root`` or ``store`` (PL).

    With ``control`` and ``read_source`` the active loads are ingested below
    ``root`` first and silver takes all their ingested days, the newest row of a key winning: typed
    by contract from the raw days or, with ``buckets``, from kept states that only this run's day is merged
    into (:mod:`almacen.plans.incremental`). Each load's audit row goes to ``audit`` (default: the table
    ``bronze_load_audit``, one row for each run and load). A
    failed load raises after the loop and silver does not start. Otherwise
    ``sources`` holds the seven source frames.
    """
    tune(spark)
    store = store or Store(root)
    ts = now or dt.datetime.now()
    if control is not None:
        run = bronze.RunInfo(ts.strftime(SILVER_RUN_FORMAT), ts)
        audit = audit or (lambda row: store.put(row, LOADS_TABLE, ("IdLote", "NombreTablaDestino")))
        done = bronze.load_all(spark, control, read_source, root, run, ts.date(), audit)
        sources = {}
        for load, *_ in done:
            table, target = load.source_table, load.target_table
            if buckets:
                order = (order_by or {}).get(table, ())
                sources[table] = incremental.refresh(spark, root, table, target, ts.date(), buckets, order)
            else:
                sources[table] = bronze.read_days(spark, root, target, S.SOURCES[table][0])
    run_silver(spark, sources, store, RunContext(ts.strftime(SILVER_RUN_FORMAT), ts), scfg, order_by)
    run_gold(spark, store, gcfg, RunContext(ts.strftime(GOLD_RUN_FORMAT), ts))
    return store
