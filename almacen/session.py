"""Session helpers: recommended SQL settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the library relies on; set only where the session left them unset.
RECOMMENDED_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED_SQL_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none and runs a local master (tests) a fresh
    scratch folder is set; a cluster without the setting is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. remote sessions: the server side owns the folder
        return conf_dir
    if conf_dir:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local one cannot serve a cluster")
    local = tempfile.mkdtemp(prefix="almacen-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "almacen") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ALMACEN_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    scratch = tempfile.mkdtemp(prefix="almacen-local-")  # one machine: its local folder is shared by all tasks
    builder = builder.config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
    builder = builder.config("spark.checkpoint.dir", os.environ.get("ALMACEN_CHECKPOINT_DIR", f"{scratch}/checkpoint"))
    for key, value in RECOMMENDED_SQL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
