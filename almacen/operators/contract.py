"""Lenient typing against a table contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lenient(col: Column, dtype: T.DataType) -> Column:
    """``try_cast`` that never raises; text dates go through ``try_to_date``."""
    if isinstance(dtype, T.DateType):
        return F.when(col.isNull(), F.lit(None).cast("date")).otherwise(
            F.coalesce(col.try_cast("date"), F.try_to_date(col.cast("string")))
        )
    return col.try_cast(dtype)


def apply_contract(df: DataFrame, schema: T.StructType, keep_extra: bool = True, more: Sequence[Column] = ()) -> DataFrame:
    """Columns of ``schema`` in contract order and type; missing ones are null.

    Values that do not convert become null instead of failing the job; count
    them with :func:`cast_failures`. ``more`` are columns of ``df`` to add to them.
    """
    present = set(df.columns)
    cols = [
        (lenient(F.col(f.name), f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    if keep_extra:
        names = {f.name for f in schema.fields}
        cols += [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols, *more)


def failure_count(df: DataFrame, schema: T.StructType) -> Column:
    """Number of a row's non-null values that would not convert to the contract's types."""
    present = set(df.columns)
    total = F.lit(0).cast("long")
    for f in schema.fields:
        if f.name in present and df.schema[f.name].dataType != f.dataType:
            total = total + (F.col(f.name).isNotNull() & lenient(F.col(f.name), f.dataType).isNull()).cast("long")
    return total


def cast_failures(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per contract column, how many non-null values would not convert."""
    present = set(df.columns)
    aggs = [
        F.count_if(F.col(f.name).isNotNull() & lenient(F.col(f.name), f.dataType).isNull()).alias(f.name)
        for f in schema.fields
        if f.name in present
    ]
    return df.agg(*aggs)
