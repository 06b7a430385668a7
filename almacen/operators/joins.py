"""Join helpers for skewed keys. Join strategies are left to AQE, which knows the measured sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almacen.config import DEFAULT_JOIN


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _is_hot(key: Column, hot: Sequence) -> Column:
    return F.coalesce(key.isin(list(hot)), F.lit(False)) if hot else F.lit(False)


def _salts(key: Column, hot: Mapping, most: int, otherwise: int) -> Column:
    """Number of salts of a key: a power of two of at least twice its share of ``most``, ``otherwise`` where it is not hot."""
    by_count: dict[int, list] = {}
    for value, share in hot.items():
        salts = 2
        while salts < min(2 * share * most, most):
            salts *= 2
        by_count.setdefault(min(salts, most), []).append(value)
    out = F.lit(otherwise)
    for salts, values in by_count.items():
        out = F.when(_is_hot(key, values), F.lit(salts)).otherwise(out)
    return out


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    row_id: Sequence[str],
    salts: int | None = None,
    hot: Sequence | Mapping = (),
) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``, safe for hot keys and nulls.

    Both sides are keyed by ``(key, salt)``. Rows whose key is null (they can never
    match) or one of the ``hot`` values get a salt from a hash of ``row_id``, so
    they spread over all partitions instead of landing in one; ``right`` has salt 0, and
    its rows of a ``hot`` key, if there are any, one copy per salt. ``hot`` may give each
    value's share of the rows (see :mod:`almacen.operators.heavy`): its salts, and with them the copies, then follow the
    share, so all hot keys together have about four times as many as there are partitions. The default
    number of salts is the session's shuffle partition count (at least
    ``JoinConfig.null_key_salts``).
    """
    n = salts or max(DEFAULT_JOIN.null_key_salts, _shuffle_partitions(left))
    shares = hot if isinstance(hot, Mapping) else dict.fromkeys(hot, 1.0)
    key = F.col(left_key)
    # One struct key (key, salt) on both sides: a separate literal salt column on
    # the right would be constant-folded out of the join keys, and the shuffle
    # would again hash on the key alone.
    own = F.when(key.isNull(), F.lit(n)).otherwise(_salts(key, shares, n, 0))
    salt = F.when(own > 0, 1 + F.pmod(F.xxhash64(*row_id), own)).otherwise(F.lit(0))
    key_type = left.schema[left_key].dataType
    l2 = left.withColumn("_jk_l", F.struct(key.alias("k"), salt.cast("int").alias("s")))
    r2 = right.withColumn("_jk_s", F.lit(0))
    if shares:
        theirs = _salts(F.col(right_key), shares, n, 0)
        copies = F.when(theirs > 0, F.sequence(F.lit(1), theirs)).otherwise(F.array(F.lit(0)))
        r2 = right.withColumn("_jk_s", F.explode(copies))
    r2 = r2.withColumn("_jk_r", F.struct(F.col(right_key).cast(key_type).alias("k"), F.col("_jk_s").alias("s")))
    return l2.join(r2, l2["_jk_l"] == r2["_jk_r"], "left").drop("_jk_l", "_jk_r", "_jk_s")


def split_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: Sequence) -> DataFrame:
    """``left LEFT JOIN right`` with the null and ``hot`` keys joined apart from the others.

    The others keep the plain equi-join (a bucketed layout still needs no
    shuffle). Rows with a null key get nulls; those with a ``hot`` key meet only the
    rows of ``right`` that have one. ``right`` is unique by ``right_key``, so these
    are at most ``len(hot)`` rows, which bounds the broadcast.
    """
    key = F.col(left_key)
    apart = key.isNull() | _is_hot(key, hot)
    common = left.where(~apart).join(right.where(~_is_hot(F.col(right_key), hot)), key == F.col(right_key), "left")
    few = F.broadcast(right.where(_is_hot(F.col(right_key), hot)))
    return common.unionByName(left.where(apart).join(few, key == F.col(right_key), "left"))
