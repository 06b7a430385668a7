"""Column expressions for the cleaning and business rules."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_values(col: Column | str, rules: Sequence[tuple[Iterable, object]], default=None) -> Column:
    """First matching rule wins: ``CASE WHEN col IN (values) THEN out ... ELSE default``.

    ``col`` is compared as text, so a numeric code column never raises a cast
    error against text values under ANSI mode.
    """
    c = _col(col).cast("string")
    expr = None
    for values, out in rules:
        cond = c.isin([str(v) for v in values])
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def contains_map(col: Column | str, rules: Sequence[tuple[str, object]], otherwise: Column) -> Column:
    """First rule whose key is a substring of ``upper(col)`` wins, else ``otherwise``."""
    c = F.upper(_col(col))
    expr = None
    for key, out in rules:
        cond = c.contains(key)
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    return otherwise if expr is None else expr.otherwise(otherwise)


def hash_pii(col: Column | str, salt: str | None = None) -> Column:
    """SHA-256 hex of the value as text, optionally salted (salt prefix)."""
    text = _col(col).cast("string")
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.sha2(text, 256)


def flag_with_default(col: Column | str, default: bool = True) -> Column:
    """Lenient boolean: ``coalesce(try_cast(col as boolean), default)``."""
    return F.coalesce(_col(col).try_cast("boolean"), F.lit(default))


def normalise_text(col: Column | str) -> Column:
    return F.upper(F.trim(_col(col)))


def net_amount(qty: Column | str, price: Column | str, discount: Column | str) -> Column:
    """qty * price - discount, null-propagating, exact for decimal inputs."""
    return _col(qty) * _col(price) - _col(discount)


def positive_flag(col: Column | str) -> Column:
    """``col > 0`` with null read as false."""
    return F.coalesce(_col(col) > 0, F.lit(False))


def date_key(col: Column | str) -> Column:
    """yyyyMMdd as int."""
    return F.date_format(_col(col), "yyyyMMdd").cast("int")


def edge(df: DataFrame) -> DataFrame:
    """Decimals to double at the output edge (the reference's money type)."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def whole_div(a: Column, b: Column) -> Column:
    """SQL ``a div b``: the whole part of the quotient, in integer arithmetic; null for b = 0."""
    return F.call_function("div", a, F.when(b != 0, b))


def rounded_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """round(num / den, scale) HALF_UP (ties away from zero), exact for integral
    num and den > 0.

    Integer arithmetic only (SQL ``div``), so the result does not depend on binary
    floating point: with ``a = 2 * 10^s * |num| + den`` and ``b = 2 * den`` the
    rounded magnitude is ``a div b / 10^s``. ``a`` must stay below 2^63.
    """
    unit = 10**scale
    n = num.cast("long")
    a = F.abs(n) * F.lit(2 * unit).cast("long") + den.cast("long")
    b = den.cast("long") * 2
    q = whole_div(a, b) * F.when(n < 0, F.lit(-1)).otherwise(F.lit(1))
    return (q.cast("decimal(38,0)") / F.lit(unit)).cast(f"decimal(38,{scale})").cast("double")
