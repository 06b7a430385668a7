"""Data-quality metrics (A4, A5): one audit row per checked table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almacen.functions.columns import rounded_ratio


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: ``null_<col>`` = number of nulls, for each column."""
    if not columns:
        return df.agg(F.count(F.lit(1)).alias("_rows")).select()
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def quality_aggregates(
    rows_col: str, accepted: Column | None = None, null_columns: Sequence[str] = (), failures_col: str | None = None
) -> list[Column]:
    """The counts behind an audit row, as aggregates over a deduplicated frame (also for an ``Observation``)."""
    ok = F.lit(True) if accepted is None else accepted
    failures = F.sum(failures_col) if failures_col else F.lit(0)
    return [
        F.coalesce(F.sum(rows_col), F.lit(0)).cast("long").alias("total_records"),
        F.count(F.lit(1)).alias("unique_records"),
        F.count_if(ok).alias("accepted_records"),
        F.count_if(~ok).alias("rejected_records"),
        F.coalesce(failures, F.lit(0)).cast("long").alias("conversion_failures"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_columns],
    ]


def quality_row(
    table: str, counts: DataFrame, null_columns: Sequence[str] = (), run_id: str | None = None, run_ts=None
) -> DataFrame:
    """The audit row from the one row of :func:`quality_aggregates`."""
    nulls = [F.col(f"null_{c}").alias(c) for c in null_columns]
    return counts.select(
        F.lit(run_id).cast("string").alias("execution_id"),
        F.lit(table).alias("table_name"),
        F.col("total_records"),
        (F.col("total_records") - F.col("unique_records")).alias("duplicate_records"),
        F.col("accepted_records"),
        F.col("rejected_records"),
        F.col("conversion_failures"),
        F.when(F.col("total_records") > 0, rounded_ratio(F.col("accepted_records") * 100, F.col("total_records")))
        .otherwise(F.lit(0.0))
        .alias("pct_conformed"),
        (F.to_json(F.struct(*nulls)) if nulls else F.lit("{}")).alias("null_analysis"),
        (F.lit(run_ts) if run_ts is not None else F.lit(None)).cast("timestamp").alias("processed_at"),
    )


def quality_metrics(
    table: str,
    deduped: DataFrame,
    rows_col: str,
    accepted: Column | None = None,
    null_columns: Sequence[str] = (),
    run_id: str | None = None,
    run_ts=None,
    failures_col: str | None = None,
) -> DataFrame:
    """One audit row from one aggregate over the deduplicated frame.

    ``rows_col`` holds the number of source rows behind each kept row (see
    ``dedupe_latest(count_as=...)``), ``failures_col`` the number of their values
    that did not convert, ``accepted`` is the row's outcome (all accepted when
    None). total, duplicates, accepted, rejected, conversion failures, pct
    conformed = round(accepted / total * 100, 2) HALF_UP (0 when empty), and the
    null count of each of ``null_columns`` as JSON.
    """
    counts = deduped.agg(*quality_aggregates(rows_col, accepted, null_columns, failures_col))
    return quality_row(table, counts, null_columns, run_id, run_ts)
