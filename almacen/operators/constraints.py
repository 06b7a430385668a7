"""Declared constraints, all evaluated in one aggregate pass over a table.

Source tables come with promises (a key is unique, a column is never null, a code is one of
a list) that nothing enforces on raw files. A :class:`Constraint` states one; :func:`violations`
counts the rows that break each. Rows are grouped once by the table's key, with map-side
partial sums of all other conditions, so a hot key is one row a task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almacen.operators.contract import lenient

KEY, NOT_NULL, DOMAIN, LENGTH, CHECK, TYPE = "llave", "no_nulo", "dominio", "largo", "condicion", "tipo"


@dataclass(frozen=True)
class Constraint:
    """``kind`` and ``column``; ``rule`` is a list of values, a length, a SQL condition or a type, by kind.

    As in SQL a null breaks only NOT NULL: it is no duplicate key, and every other condition lets it pass.
    """

    kind: str
    column: str
    rule: object = None

    def broken(self) -> Column:
        """Does a row break it? Not for keys, which need other rows."""
        c = F.col(self.column)
        if self.kind == NOT_NULL:
            return c.isNull()
        if self.kind == DOMAIN:
            bad = ~c.isin(list(self.rule))
        elif self.kind == LENGTH:
            bad = F.length(c.cast("string")) > self.rule
        elif self.kind == CHECK:
            bad = ~F.expr(self.rule)
        elif self.kind == TYPE:
            bad = c.isNotNull() & lenient(c, T._parse_datatype_string(self.rule)).isNull()
        else:
            raise ValueError(f"unknown kind {self.kind!r}")
        return F.coalesce(bad, F.lit(False))


def violations(df: DataFrame, table: str, constraints: Sequence[Constraint]) -> DataFrame:
    """One row a constraint: tabla, restriccion, columna, regla, filas, violaciones.

    Of the rows that share a key all but one are violations. A table has at most one key, of one
    column; a column that the frame lacks is null in every row.
    """
    keys = [c.column for c in constraints if c.kind == KEY]
    if len(keys) > 1:
        raise ValueError(f"{table} has several keys: {keys}")
    lacking = {c.column: F.lit(None).cast("string") for c in constraints if c.column not in df.columns}
    rows = df.withColumns(lacking) if lacking else df
    others = [c for c in constraints if c.kind != KEY]
    flags = [F.count_if(c.broken()).alias(f"_c{i}") for i, c in enumerate(others)]
    grouped = rows.groupBy(*keys) if keys else rows.groupBy()
    per_key = grouped.agg(F.count(F.lit(1)).alias("_n"), *flags)
    twice = F.sum(F.when(F.col(keys[0]).isNotNull(), F.col("_n") - 1)) if keys else F.lit(0)
    totals = per_key.agg(F.sum("_n").alias("_n"), twice.alias("_twice"), *[F.sum(f"_c{i}").alias(f"_c{i}") for i in range(len(others))])
    found = {id(c): F.col(f"_c{i}") for i, c in enumerate(others)}
    lines = [
        F.struct(
            F.lit(c.kind).alias("restriccion"),
            F.lit(c.column).alias("columna"),
            F.lit(None if c.rule is None else ",".join(c.rule) if c.kind == DOMAIN else str(c.rule)).cast("string").alias("regla"),
            F.coalesce(found.get(id(c), F.col("_twice")), F.lit(0)).cast("long").alias("violaciones"),
        )
        for c in constraints
    ]
    out = totals.select(F.lit(table).alias("tabla"), F.coalesce("_n", F.lit(0)).cast("long").alias("filas"), F.explode(F.array(*lines)).alias("r"))
    return out.select("tabla", "r.restriccion", "r.columna", "r.regla", "filas", "r.violaciones")
