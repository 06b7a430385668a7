"""Planted violations of every kind, and sessions of ordered events."""

import datetime as dt
import random

import pytest

from almacen.operators.constraints import CHECK, DOMAIN, KEY, LENGTH, NOT_NULL, TYPE, Constraint, violations
from almacen.plans import kpis

ALL = (
    Constraint(KEY, "id"), Constraint(NOT_NULL, "id"), Constraint(DOMAIN, "code", ("a", "b")), Constraint(LENGTH, "name", 3),
    Constraint(CHECK, "qty", "qty > 0 AND qty < limit"), Constraint(TYPE, "text", "date"), Constraint(NOT_NULL, "absent"),
)


def test_planted_violations_of_each_kind_are_counted(spark):
    rows = [(1, "a", "abc", 1, 5, "2024-01-01")] * 3 + [(None, "a", "abcd", 1, 5, None)] * 2
    rows += [(2, "x", "ñandú", 0, 5, "2024-02-31"), (3, None, None, None, 5, "x"), (4, "b", "", 7, None, "2024-01-02")]
    df = spark.createDataFrame(rows, "id int, code string, name string, qty int, limit int, text string").repartition(4)
    got = {(r.restriccion, r.columna): (r.filas, r.violaciones) for r in violations(df, "t", ALL).collect()}
    assert got == {
        (KEY, "id"): (8, 2), (NOT_NULL, "id"): (8, 2), (DOMAIN, "code"): (8, 1), (LENGTH, "name"): (8, 3),
        (CHECK, "qty"): (8, 1), (TYPE, "text"): (8, 2), (NOT_NULL, "absent"): (8, 8),
    }
    assert all((r.filas, r.violaciones) == (0, 0) for r in violations(df.where("false"), "t", ALL).collect())


def test_all_constraints_of_a_table_cost_one_shuffle_by_its_key(spark):
    df = spark.range(100).selectExpr("id", "'a' AS code", "'b' AS name", "1 AS qty", "2 AS limit", "'c' AS text")
    plan = violations(df.repartition(3), "t", ALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and plan.count("SinglePartition") == 1 and "partial_" in plan


def test_two_keys_are_refused(spark):
    with pytest.raises(ValueError, match="several keys"):
        violations(spark.range(1), "t", (Constraint(KEY, "id"), Constraint(KEY, "x")))


def plain_sessions(events, gap):
    """(user, start, end, first view, last purchase) one event at a time."""
    out = []
    for user in {u for u, _, t in events if u is not None and t is not None}:
        mine = sorted((t, e) for u, e, t in events if u == user and t is not None)
        groups = [[mine[0]]]
        for at, kind in mine[1:]:
            if at - groups[-1][-1][0] >= gap:
                groups.append([])
            groups[-1].append((at, kind))
        for g in groups:
            view = min((t for t, e in g if e == "view"), default=None)
            buy = max((t for t, e in g if e == "purchase"), default=None)
            out.append((user, g[0][0], g[-1][0], view, buy))
    return out


def test_sessions_and_order(spark):
    rng, start = random.Random(2), dt.datetime(2024, 1, 1, 23, 0)
    events = [(rng.randint(1, 6), rng.choice(["view", "purchase", "other", None]), start + dt.timedelta(seconds=rng.randint(0, 90_000))) for _ in range(400)]
    hot = [(99, "view", start + dt.timedelta(minutes=i)) for i in range(1500)] + [(99, "purchase", start + dt.timedelta(minutes=1600))]
    edge = [(50, "view", start), (50, "purchase", start + dt.timedelta(minutes=30)), (51, "view", start), (51, "purchase", start + dt.timedelta(minutes=29, seconds=59))]
    edge += [(52, "purchase", start), (52, "view", start + dt.timedelta(minutes=1)), (53, "view", start), (53, "purchase", start)]
    odd = [(None, "view", start), (60, "view", None)]
    every = events + hot + edge + odd
    df = spark.createDataFrame(every, "user_id int, event_type string, ts timestamp").repartition(5)
    want = plain_sessions(every, dt.timedelta(minutes=30))
    days = {}
    for _, begin, _, view, buy in want:
        d = days.setdefault(begin.date(), [0, 0, 0, 0])
        d[0] += 1
        d[1] += view is not None
        d[2] += buy is not None
        d[3] += view is not None and buy is not None and buy > view
    got = {r.fecha: [r.sesiones, r.sesiones_vista, r.sesiones_compra, r.sesiones_convertidas] for r in kpis.ordered_conversion(df).collect()}
    assert got == days
    assert kpis.ordered_conversion(df.where("false")).count() == 0
