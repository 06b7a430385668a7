"""Bronze: control-table driven ingest into dated raw Parquet (BR, I1-I9).

The control table is tiny (one row per configured load) and is the only frame
read on the driver; every load is a Spark job that reads, projects, filters and
writes on the executors.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almacen import schemas as S
from almacen.config import FAILURES, INGEST_TS, SOURCE_SYSTEM
from almacen.operators.contract import apply_contract, failure_count
from almacen.sources.sinks import read_jdbc, read_jdbc_split

CONTROL_COLUMNS = (
    "PkControlCargas", "EsquemaFuente", "NombreTablaFuente", "ColumnasArchivoFuente",
    "FiltrosArchivoFuente", "EsquemaDestino", "NombreTablaDestino",
)
SOURCE_COL, BATCH_COL = "SistemaFuente", "IdLote"
PARTITION_COL = "fecha_ingesta"
LOADED, FAILED = "SATISFACTORIO", "FALLA"


@dataclass(frozen=True)
class Load:
    pk: int
    source_schema: str
    source_table: str
    columns: str
    filter: str | None
    target_schema: str
    target_table: str


@dataclass(frozen=True)
class RunInfo:
    run_id: str
    run_ts: dt.datetime


def active_loads(control: DataFrame) -> DataFrame:
    """Configured loads with ``IndicadorCargaActiva = 1``, in key order."""
    return control.filter(F.col("IndicadorCargaActiva") == 1).select(*CONTROL_COLUMNS).orderBy("PkControlCargas")


def collect_loads(loads: DataFrame) -> list[Load]:
    """The (tiny) list of active loads for the sequential loop."""
    return [
        Load(r.PkControlCargas, r.EsquemaFuente, r.NombreTablaFuente, r.ColumnasArchivoFuente,
             r.FiltrosArchivoFuente, r.EsquemaDestino, r.NombreTablaDestino)
        for r in loads.collect()
    ]


def split_columns(columns: str) -> list[str]:
    """Configured column list -> expressions (``*`` or empty means all columns)."""
    parts = [c.strip() for c in (columns or "").split(",")]
    parts = [c for c in parts if c]
    return parts or ["*"]


def add_lineage(df: DataFrame, run: RunInfo, source_system: str = SOURCE_SYSTEM) -> DataFrame:
    """Ingest time, source system and batch id columns."""
    return df.withColumns({
        INGEST_TS: F.lit(run.run_ts).cast("timestamp"),
        SOURCE_COL: F.lit(source_system),
        BATCH_COL: F.lit(run.run_id),
    })


def extract(source: DataFrame, load: Load, run: RunInfo) -> DataFrame:
    """Configured columns, the configured filter only when non-empty, lineage.

    Column list and filter are parsed as Spark SQL expressions
    (``selectExpr``/``where``), never concatenated into a query string, and the
    filter is applied before the projection so it can reach the scan.
    """
    df = source
    if load.filter and load.filter.strip():
        df = df.where(load.filter)
    return add_lineage(df.selectExpr(*split_columns(load.columns)), run)


def jdbc_source(
    spark: SparkSession, url: str, rows_per_slice: int = 1_000_000, most: int = 200, properties: dict | None = None, quote: str = '"'
) -> Callable[[Load], DataFrame]:
    """``read_source`` for :func:`load_all` over JDBC: each load's table, split by its primary key where that is a number.

    Column list and filter of the control row are applied by :func:`extract` and pushed into every slice's query.
    """

    def read(load: Load) -> DataFrame:
        schema = f"{load.source_schema}." if load.source_schema else ""
        table = f"{schema}{load.source_table}"
        contract, key = S.SOURCES.get(load.source_table, (None, None))
        if key is None or not isinstance(contract[key].dataType, T.IntegralType):
            return read_jdbc(spark, url, table=table, properties=properties)
        return read_jdbc_split(spark, url, table, f"{quote}{key}{quote}", rows_per_slice, most, properties)

    return read


def raw_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/raw/{table}"


def write_raw(df: DataFrame, root: str, table: str, day: dt.date) -> None:
    """I4: snappy Parquet under ``raw/<table>/fecha_ingesta=<day>``.

    A ``k=v`` folder per day (instead of ``yyyy/MM/dd``) keeps partition
    discovery and pruning; each day's folder is overwritten on re-run (dynamic
    partition overwrite), other days stay.
    """
    (
        df.withColumn(PARTITION_COL, F.lit(day).cast("date"))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COL)
        .parquet(raw_path(root, table))
    )


def read_raw(spark: SparkSession, root: str, table: str, since: dt.date | None = None) -> DataFrame:
    """Every ingested day of one table (``since`` prunes older day folders).

    Day files are merged by schema, so a column that a later day added is read (null before).
    """
    df = spark.read.option("mergeSchema", "true").parquet(raw_path(root, table))
    if since is not None:
        df = df.filter(F.col(PARTITION_COL) >= F.lit(since).cast("date"))
    return df


def day_folders(spark: SparkSession, root: str, table: str, since: dt.date | None = None) -> list[tuple[dt.date, str, str]]:
    """(day, folder, one of its files) of every ingested day of a table, from the listing alone; no days, no entries."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(raw_path(root, table))
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for day in fs.listStatus(top) if fs.exists(top) else []:
        key, _, value = day.getPath().getName().partition("=")
        if key != PARTITION_COL or (since is not None and dt.date.fromisoformat(value) < since):
            continue
        files = [f.getPath() for f in fs.listStatus(day.getPath())]
        parts = sorted(f.toString() for f in files if not f.getName().startswith(("_", ".")))
        if parts:
            out.append((dt.date.fromisoformat(value), day.getPath().toString(), parts[0]))
    return sorted(out)


def read_days(
    spark: SparkSession, root: str, table: str, contract: T.StructType, since: dt.date | None = None
) -> DataFrame:
    """Every ingested day of one table (from ``since`` on), typed by its contract.

    A source may change over time: a column is added, goes, or changes its type from
    one day to the next. So no schema is merged from the files: the footer of one file of each
    day says what that day holds, days that hold the same are read by one scan, each group is
    cast to ``contract`` (a missing column is null, a value that does not convert is null), and
    the groups are united by name. ``_failures`` counts a row's values that did not convert. Lineage columns keep their
    types, other columns outside the contract are kept as text. Rows of no day: an empty frame.
    """
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for _, folder, part in day_folders(spark, root, table, since):
        held = spark.read.parquet(part).schema
        groups.setdefault(held.json(), (held, []))[1].append(folder)
    if not groups:
        day = T.StructType([*contract.fields, T.StructField(PARTITION_COL, T.DateType()), T.StructField(FAILURES, T.LongType())])
        return spark.createDataFrame([], day)
    frames = []
    names = {f.name for f in contract.fields}
    for held, folders in groups.values():
        df = spark.read.schema(held).option("basePath", raw_path(root, table)).parquet(*folders)
        extra = [f.name for f in held.fields if f.name not in names]
        kinds = {c: "timestamp" if c == INGEST_TS else "string" for c in extra}
        df = df.withColumn(FAILURES, failure_count(df, contract))
        day = F.col(PARTITION_COL).cast("date").alias(PARTITION_COL)
        frames.append(
            apply_contract(df, contract, keep_extra=False, more=[*[F.col(c).cast(k).alias(c) for c, k in kinds.items()], day, F.col(FAILURES)])
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def audit_row(spark: SparkSession, run: RunInfo, load: Load, status: str, rows: int | None, error: str | None):
    """One audit row for a load's success or failure."""
    return spark.createDataFrame(
        [(run.run_id, load.target_table, load.source_table, status, rows, error, run.run_ts)], S.LOAD_AUDIT
    )


class LoadFailed(RuntimeError):
    """Some loads failed; ``results`` has (load, status, rows, error) of all."""

    def __init__(self, results: list):
        self.results = results
        failed = [(load.source_table, error) for load, status, _, error in results if status == FAILED]
        super().__init__("; ".join(f"{table}: {error}" for table, error in failed))


def load_all(
    spark: SparkSession,
    control: DataFrame,
    read_source: Callable[[Load], DataFrame],
    root: str,
    run: RunInfo,
    day: dt.date,
    audit: Callable[[DataFrame], None] | None = None,
) -> list[tuple[Load, str, int | None, str | None]]:
    """Run every active load in order; a failed load is audited and the rest go on.

    Rows copied are counted with an ``Observation`` on the write itself (no
    second scan). Returns ``(load, status, rows, error)`` per load, or raises
    :class:`LoadFailed` with them after the last load when any failed.
    """
    results = []
    for load in collect_loads(active_loads(control)):
        try:
            obs = Observation(f"rows_{load.pk}")
            df = extract(read_source(load), load, run).observe(obs, F.count(F.lit(1)).alias("rows"))
            write_raw(df, root, load.target_table, day)
            rows = int(obs.get["rows"])
            results.append((load, LOADED, rows, None))
        except Exception as exc:  # noqa: BLE001 - any load failure is audited, the loop goes on
            results.append((load, FAILED, None, str(exc)))
        if audit is not None:
            _, status, rows, error = results[-1]
            audit(audit_row(spark, run, load, status, rows, error))
    if any(status == FAILED for _, status, _, _ in results):
        raise LoadFailed(results)
    return results


def example_control(spark: SparkSession, tables: Iterable[str] = tuple(S.SOURCES)) -> DataFrame:
    """A control table with one active load per source table; sales are limited
    to a column list and a channel filter, returns are configured inactive."""
    rows = []
    for i, t in enumerate(tables, start=1):
        cols, filt, active = "*", None, 1
        if t == "TRANS_VENTAS":
            cols = "id_trans, id_miembro, id_tienda, art_id, fec_trans, qty_vendida, precio_unitario_venta, canal_venta"
            filt = "canal_venta = 'Online'"
        if t == "POST_DEVOLUCIONES":
            active = 0
        rows.append((i, "dbo", t, cols, filt, "bronze", t, active))
    return spark.createDataFrame(rows, S.CONTROL)
