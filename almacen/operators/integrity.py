"""Referential integrity split into accepted and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almacen.operators.joins import salted_left_join


@dataclass(frozen=True)
class Reference:
    """Rows of the checked table must have ``column`` among ``keys[key]``."""

    column: str
    keys: DataFrame
    key: str
    label: str
    hot: tuple = ()  # values of ``column`` that very many rows may have, such as a key for "unknown"


def flag_references(df: DataFrame, id_col: str, refs: Sequence[Reference]) -> DataFrame:
    """Adds one boolean ``_ok_<label>`` per reference and ``_ok_id`` (key not null).

    One left join per reference against its distinct key set, null and hot keys
    salted; AQE broadcasts a key set whose measured size allows it. Every input
    row comes out exactly once.
    """
    key_sets = [
        ref.keys.select(F.col(ref.key).alias(f"_k_{ref.label}"))
        .where(F.col(f"_k_{ref.label}").isNotNull())
        .distinct()
        .withColumn(f"_ok_{ref.label}", F.lit(True))
        for ref in refs
    ]
    out = df
    for ref, keys in zip(refs, key_sets, strict=True):
        out = salted_left_join(out, keys, ref.column, f"_k_{ref.label}", row_id=df.columns, hot=ref.hot)
        out = out.drop(f"_k_{ref.label}")
        out = out.withColumn(f"_ok_{ref.label}", F.coalesce(F.col(f"_ok_{ref.label}"), F.lit(False)))
    return out.withColumn("_ok_id", F.col(id_col).isNotNull())


def _flags(refs: Sequence[Reference]) -> list[str]:
    return ["_ok_id"] + [f"_ok_{r.label}" for r in refs]


def accepted_condition(refs: Sequence[Reference]) -> Column:
    cond = F.lit(True)
    for name in _flags(refs):
        cond = cond & F.col(name)
    return cond


def reject_reason(refs: Sequence[Reference], reason: str, null_key_reason: str, detail: bool = False) -> Column:
    """Reason text: null key first, else the fixed reason (optionally naming the failed references)."""
    base = F.lit(reason)
    if detail:
        missing = F.concat_ws(",", *[F.when(~F.col(f"_ok_{r.label}"), F.lit(r.label)) for r in refs])
        base = F.concat(base, F.lit(":"), missing)
    return F.when(~F.col("_ok_id"), F.lit(null_key_reason)).otherwise(base)


def check_references(
    df: DataFrame,
    id_col: str,
    refs: Sequence[Reference],
    reason: str,
    null_key_reason: str,
    run_id: str | None = None,
    run_ts=None,
    detail: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). Rejected rows carry motivo_rechazo, execution_id, rejected_at.

    Both come from one flagged frame, so each row has exactly one outcome; write
    them from a materialised flagged frame to scan the input once.
    """
    return split_flagged(flag_references(df, id_col, refs), df.columns, refs, reason, null_key_reason, run_id, run_ts, detail)


def split_flagged(
    flagged: DataFrame,
    columns: Sequence[str],
    refs: Sequence[Reference],
    reason: str,
    null_key_reason: str,
    run_id: str | None = None,
    run_ts=None,
    detail: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a frame from :func:`flag_references`."""
    ok = accepted_condition(refs)
    accepted = flagged.filter(ok).select(*columns)
    rejected = flagged.filter(~ok).select(
        *columns,
        reject_reason(refs, reason, null_key_reason, detail).alias("motivo_rechazo"),
        F.lit(run_id).cast("string").alias("execution_id"),
        (F.lit(run_ts) if run_ts is not None else F.lit(None)).cast("timestamp").alias("rejected_at"),
    )
    return accepted, rejected
