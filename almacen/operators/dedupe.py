"""Deduplication by key (T1) and key sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.config import INGEST_TS


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), count_as: str | None = None, sums: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the greatest row by ingest time (``FechaIngesta``, where the
    frame has it), ``order_by``, then every other column, each descending with
    nulls last. So the newest ingest wins. Null keys form one group.

    Expressed as ``groupBy(keys).agg(max(struct(order..., rest...)))``: a
    declarative aggregate, so each map task keeps one row per key before the
    shuffle (a hot key never reaches one reducer whole) and the survivor is the
    same on every run and every action. ``count_as`` adds the number of source
    rows of each key (for quality metrics, in the same pass), and the columns
    ``sums`` are added up over the key's rows.
    """
    keys = list(keys)
    newest = [INGEST_TS] if INGEST_TS in df.columns and INGEST_TS not in order_by else []
    order = [c for c in (*newest, *order_by) if c not in keys]
    order = [c for c in order if c not in sums]
    rest = [c for c in df.columns if c not in keys and c not in order and c not in sums]
    ranked = [*order, *rest]
    extra = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    extra += [F.sum(c).alias(c) for c in sums]
    if not ranked:
        return df.groupBy(*keys).agg(*extra) if extra else df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_best"), *extra)
    by_name = {c: F.col(f"_best.{c}") for c in ranked}
    cols = [by_name[c].alias(c) if c in by_name else F.col(c) for c in df.columns]
    return best.select(*cols, *([F.col(count_as)] if count_as else []))
