"""The rolling RFM base against counting the window anew after every batch."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from almacen.plans import rfm, rolling

SALES = "id_trans long, id_miembro int, fec_trans date, vr_total_trans decimal(12,2)"
D = dt.date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(i, m, D + dt.timedelta(days=d), Decimal(v)) for i, m, d, v in rows], SALES)


def anew(spark, rows, days):
    sales = frame(spark, rows)
    ref = max(D + dt.timedelta(days=d) for _, _, d, _ in rows)
    return rfm.rfm_base(sales, F.lit(ref), days, with_ref=True)


def same(a, b):
    cols = ["id_miembro", "recency_dias", "frequency_trans", F.col("monetary_val").cast("double").alias("m"), "fec_calculo_rfm"]
    a, b = sorted(map(str, a.select(cols).collect())), sorted(map(str, b.select(cols).collect()))
    assert a == b


def test_every_batch_equals_counting_anew(spark, tmp_path):
    rng, path, held, n = random.Random(5), str(tmp_path), [], 0
    for batch in range(6):
        rows = []
        for _ in range(30):
            n += 1
            day = batch * 4 + rng.randint(0, 3) if rng.random() < 0.8 else rng.randint(0, batch * 4)  # one in five is late
            rows.append((n, rng.choice([None, *range(1, 15)]), day, rng.randint(1, 900)))
        if batch == 3:
            rows = [(i, m, min(d, 9), v) for i, m, d, v in rows]  # nothing newer: the reference date stays
        held += rows
        rolling.advance(spark, path, frame(spark, rows), f"{batch:02d}", 7)
        same(rolling.rolled_base(spark, path, with_ref=True), anew(spark, held, 7))
    rolling.advance(spark, path, frame(spark, rows), "05", 7)  # the last batch once more
    same(rolling.rolled_base(spark, path, with_ref=True), anew(spark, held, 7))


def test_a_replaced_sale_is_taken_off_and_its_member_counted_anew(spark, tmp_path):
    path = str(tmp_path)
    first = [(1, 7, 0, 10), (2, 7, 5, 20), (3, 8, 5, 30), (4, None, 4, 5)]
    rolling.advance(spark, path, frame(spark, first), "a", 30)
    # sale 2 was the last of member 7 and belongs to member 9; sale 4 had another amount
    rolling.advance(spark, path, frame(spark, [(2, 9, 5, 20), (4, None, 4, 6), (5, 8, 6, 1)]), "b", 30,
                    retracted=frame(spark, [first[1], first[3]]))
    now = [(1, 7, 0, 10), (2, 9, 5, 20), (3, 8, 5, 30), (4, None, 4, 6), (5, 8, 6, 1)]
    same(rolling.rolled_base(spark, path, with_ref=True), anew(spark, now, 30))


def test_a_batch_reads_its_sales_and_the_days_that_expire(spark, tmp_path):
    path = str(tmp_path)
    rolling.advance(spark, path, frame(spark, [(i, i % 9, i % 50, 1) for i in range(500)]), "a", 20)
    rolling.advance(spark, path, frame(spark, [(1000, 1, 51, 1)]), "b", 20)  # days 29 and 30 leave
    gone = rolling.between(rolling.stored_days(spark, path), "b", D + dt.timedelta(days=29), D + dt.timedelta(days=31))
    gone.collect()
    scan = gone._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().get("numPartitions").get().value() == 2
    assert {r["fec_ref"] for r in rolling.version(spark, path, "b").collect()} == {D + dt.timedelta(days=51)}


def test_a_given_reference_date_lets_later_days_in_when_it_reaches_them(spark, tmp_path):
    path, rows = str(tmp_path), [(i, i % 4, i, 10) for i in range(12)]
    rolling.advance(spark, path, frame(spark, rows), "a", 5, as_of=D + dt.timedelta(days=6))
    for batch, day in (("b", 8), ("c", 11)):
        rolling.advance(spark, path, frame(spark, []), batch, 5, as_of=D + dt.timedelta(days=day))
        same(rolling.rolled_base(spark, path, with_ref=True), anew(spark, [r for r in rows if r[2] <= day], 5))
    with pytest.raises(ValueError, match="before that of the last batch"):
        rolling.advance(spark, path, frame(spark, []), "d", 5, as_of=D)


def test_no_sales(spark, tmp_path):
    path = str(tmp_path)
    assert rolling.advance(spark, path, frame(spark, []), "a") is None
    assert rolling.rolled_base(spark, path).count() == 0
    rolling.advance(spark, path, frame(spark, [(1, 1, 3, 2)]), "b")
    rolling.advance(spark, path, frame(spark, []), "c")
    assert rolling.rolled_base(spark, path).count() == 1
