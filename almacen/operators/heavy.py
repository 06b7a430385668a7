"""Heavy hitters: join keys that hold a large share of the rows, found while the rows are written.

The sketch is Spark's ``approx_top_k`` (frequent items): it is kept per task, merged, and
tracks a fixed number of keys, so it costs no shuffle of rows and can ride on a write as an
observed metric. A count is never too small, and too large by at most about 3.5 / ``TRACKED`` of
the rows: no key above the threshold is missed, and a key wrongly listed only gets a few salts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

SHARE = 0.01  # a key with more of the rows than this is heavy; there are at most 100 of them
TRACKED = 2048  # keys that the sketch keeps


def sketch(column: str) -> Column:
    """Aggregate: the most frequent values of ``column``, an array of (item, count) of at most ``TRACKED`` / 2 items."""
    return F.expr(f"approx_top_k(`{column}`, {TRACKED // 2}, {TRACKED})")


def metrics(columns) -> list[Column]:
    """Aggregates to observe on a frame: its rows and the sketch of each column."""
    return [F.count(F.lit(1)).alias("_all"), *[sketch(c).alias(f"_heavy_{c}") for c in columns]]


def shares(found: Mapping, column: str, share: float = SHARE) -> dict:
    """Heavy keys of ``column`` and the share of the rows each holds, from a row of :func:`metrics`. Nulls are not listed."""
    total = found["_all"]
    if not total:
        return {}
    items = [(x["item"], x["count"] / total) for x in found[f"_heavy_{column}"] or []]
    return {k: min(s, 1.0) for k, s in items if k is not None and s > share}


def measure(df: DataFrame, column: str, share: float = SHARE) -> dict:
    """Heavy keys of ``column`` by one aggregate of ``df``: for frames that were not observed when written."""
    return shares(df.select(column).agg(*metrics([column])).first().asDict(), column, share)


def watch(df: DataFrame, columns) -> tuple[DataFrame, Observation]:
    """``df`` to be written, and the observation that holds its :func:`metrics` afterwards."""
    seen = Observation()
    return df.observe(seen, *metrics(columns)), seen
