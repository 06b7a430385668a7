"""Null imputation from the row's group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_donors(df: DataFrame, target: str, group: str, order_key: str) -> DataFrame:
    """Per group, the non-null ``target`` of the row with the least ``order_key``.

    A partial aggregate (one row per group leaves each map task), not a window
    over a whole group.
    """
    return (
        df.filter(F.col(target).isNotNull())
        .groupBy(group)
        .agg(F.min_by(F.col(target), F.col(order_key)).alias("_donor"))
        .withColumnRenamed(group, "_donor_group")
    )


def impute_from_group(
    df: DataFrame, target: str, group: str, order_key: str, default: str | None = None
) -> DataFrame:
    """``target = coalesce(target, donor of the row's group, default)``.

    Null groups form one group, as a window partition would. The donor table has
    one row per group; AQE broadcasts it when its measured size allows it.
    """
    donors = group_donors(df, target, group, order_key)
    joined = df.join(donors, df[group].eqNullSafe(donors["_donor_group"]), "left")
    filled = F.coalesce(F.col(target), F.col("_donor"), F.lit(default))
    return joined.select(*[filled.alias(c) if c == target else df[c] for c in df.columns])
