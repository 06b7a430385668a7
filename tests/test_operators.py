import datetime as dt
import hashlib
from decimal import Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from almacen import schemas as S
from almacen.functions.columns import contains_map, date_key, hash_pii, map_values, positive_flag, rounded_ratio
from almacen.operators.contract import apply_contract, cast_failures
from almacen.operators.dedupe import dedupe_latest
from almacen.operators.impute import impute_from_group
from almacen.operators.integrity import Reference, check_references
from almacen.operators.joins import salted_left_join, split_left_join
from almacen.operators.quality import quality_metrics
from almacen.plans import silver


def _key(r):
    return tuple((True, 0) if v is None else (False, v) for v in r)


def rows(df, *cols):
    got = df.select(*cols).collect() if cols else df.collect()
    return sorted((tuple(r) for r in got), key=_key)


def test_dedupe_newest_wins_nulls_last_and_null_key_is_one_group(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), "old"), (1, dt.date(2024, 1, 2), "new"), (1, None, "nodate"),
         (None, dt.date(2024, 1, 1), "a"), (None, dt.date(2024, 1, 3), "b"), (2, None, "only")],
        "k int, ts date, v string",
    )
    out = dedupe_latest(df, ["k"], ["ts"], count_as="n")
    assert out.columns == ["k", "ts", "v", "n"]
    assert rows(out) == sorted([(1, dt.date(2024, 1, 2), "new", 3), (None, dt.date(2024, 1, 3), "b", 2),
                                (2, None, "only", 1)], key=_key)


def test_dedupe_ties_broken_by_remaining_columns_and_empty(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "c"), (1, 5, None)], "k int, o int, v string")
    assert rows(dedupe_latest(df, ["k"], ["o"])) == [(1, 5, "c")]
    assert dedupe_latest(df.limit(0), ["k"], ["o"]).count() == 0


def test_contract_lenient_cast(spark):
    df = spark.createDataFrame(
        [("1", "2024-02-30", "x", "12.5"), ("2", "2024-02-01", "7", None)],
        "id_miembro string, fec_registro string, activo string, extra string",
    )
    out = apply_contract(df, S.MEMBERS)
    assert out.columns[:8] == [f.name for f in S.MEMBERS.fields] and "extra" in out.columns
    got = rows(out, "id_miembro", "fec_registro", "activo", "genero")
    assert got == [(1, None, None, None), (2, dt.date(2024, 2, 1), 7, None)]
    fails = cast_failures(df, S.MEMBERS).collect()[0].asDict()
    assert fails == {"id_miembro": 0, "fec_registro": 1, "activo": 1}


def test_column_rules(spark):
    df = spark.createDataFrame([(1, "Lima Centro", 3, 7), (5, None, 0, 2), (2, "x", -3, 4)], "c int, city string, n int, d int")
    out = df.select(
        map_values("c", [((1, "CAT_1"), "one")], "other").alias("m"),
        contains_map("city", [("LIMA", "Peru")], F.lit("Colombia")).alias("p"),
        rounded_ratio(F.col("n"), F.col("d")).alias("r"),
        positive_flag(F.col("n")).alias("f"),
    ).collect()
    assert [tuple(r) for r in out] == [("one", "Peru", 0.43, True), ("other", "Colombia", 0.0, False),
                                       ("other", "Colombia", -0.75, False)]
    half = spark.createDataFrame([(1, 8), (5, 400), (-5, 400)], "n long, d long")  # .125 and .0125 ties
    assert [r[0] for r in half.select(rounded_ratio(F.col("n"), F.col("d"))).collect()] == [0.13, 0.01, -0.01]
    one = spark.createDataFrame([(1, dt.date(2001, 8, 1))], "i int, d date")
    h, k = one.select(hash_pii("i"), date_key("d")).collect()[0]
    assert h == hashlib.sha256(b"1").hexdigest() and k == 20010801


def test_impute_from_group(spark):
    df = spark.createDataFrame(
        [(1, "App", None), (2, "App", "26-35"), (3, "App", "18-25"), (4, "Web", None), (5, None, None), (6, None, "51+")],
        "id int, canal string, rango string",
    )
    out = impute_from_group(df, "rango", "canal", "id", "30-45")
    assert rows(out) == sorted([(1, "App", "26-35"), (2, "App", "26-35"), (3, "App", "18-25"), (4, "Web", "30-45"),
                                (5, None, "51+"), (6, None, "51+")], key=_key)


def test_check_references_one_outcome_per_row(spark):
    sales = spark.createDataFrame(
        [(1, 10, 100), (2, 99, 100), (3, 10, 999), (4, 99, 999), (5, 10, None), (None, 10, 100)],
        "id long, art int, store int",
    )
    arts = spark.createDataFrame([(10,), (11,)], "art_id int")
    stores = spark.createDataFrame([(100,), (None,)], "id_tienda int")
    refs = [Reference("art", arts, "art_id", "art"), Reference("store", stores, "id_tienda", "tienda")]
    acc, rej = check_references(sales, "id", refs, "RI", "NULL_KEY", "run", dt.datetime(2024, 1, 1), detail=True)
    assert rows(acc, "id") == [(1,)]
    got = {r.id: r.motivo_rechazo for r in rej.collect()}
    assert got == {2: "RI:art", 3: "RI:tienda", 4: "RI:art,tienda", 5: "RI:tienda", None: "NULL_KEY"}
    assert acc.count() + rej.count() == sales.count()


def test_joins_of_hot_keys_match_the_plain_join(spark):
    left = spark.createDataFrame([(i, None if i % 3 == 0 else -1 if i % 7 == 0 else i % 5) for i in range(90)], "id long, k int")
    for keys in (range(4), range(-1, 4), ()):  # the sentinel unknown, known, no keys at all
        right = spark.createDataFrame([(k, f"v{k}") for k in keys], "rk int, v string")
        expect = rows(left.join(right, left.k == right.rk, "left"), "id", "k", "rk", "v")
        for got in (
            salted_left_join(left, right, "k", "rk", ["id"], salts=4),
            salted_left_join(left, right, "k", "rk", ["id"], salts=4, hot=(-1,)),
            split_left_join(left, right, "k", "rk", (-1,)),
        ):
            assert got.columns == ["id", "k", "rk", "v"]
            assert rows(got) == expect


def test_quality_metrics_single_pass(spark):
    raw = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "c")], "k int, v string")
    counted = dedupe_latest(raw, ["k"], [], count_as="_rows")
    q = quality_metrics("T", counted, "_rows", F.col("k") != 3, ["v"], "run", dt.datetime(2024, 1, 1)).collect()[0]
    assert (q.total_records, q.duplicate_records, q.accepted_records, q.rejected_records) == (4, 1, 2, 1)
    assert q.pct_conformed == 50.0 and q.null_analysis == '{"v":1}' and q.conversion_failures == 0
    empty = quality_metrics("E", counted.limit(0), "_rows").collect()[0]
    assert (empty.total_records, empty.pct_conformed) == (0, 0.0)


def test_null_and_sentinel_keys_spread_over_reducers(spark):
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 10 == 0, F.col("id") % 7).when(F.col("id") % 2 == 0, F.lit(-1)).cast("int").alias("k")
    )
    right = spark.createDataFrame([(k, f"v{k}") for k in range(-1, 7)], "rk int, v string")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(old, ("false", "-1"), strict=True):  # keep every reducer partition visible, and the shuffle join
        spark.conf.set(k, v)
    try:
        joined = salted_left_join(left, right, "k", "rk", ["id"], hot=(-1,))
        used = [joined.where(w).select(F.spark_partition_id()).distinct().count() for w in ("k IS NULL", "k = -1")]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert joined.count() == 3000 and joined.where("v = 'v-1'").count() == 1200
    assert min(used) >= 6  # over the 8 shuffle partitions, not in one


def test_newest_ingest_wins_without_an_order(spark):
    days = spark.createDataFrame(
        [(1, "a", 500, dt.datetime(2024, 1, 1)), (1, "a", 400, dt.datetime(2024, 1, 2)), (2, "b", 9, None)],
        "id_tienda int, nom_tienda string, metros_cuadrados int, FechaIngesta timestamp",
    )
    out = silver.typed_unique(days, "MSTR_TIENDAS")
    assert rows(out, "id_tienda", "metros_cuadrados") == [(1, 400), (2, 9)]
    assert rows(silver.typed_unique(days, "MSTR_TIENDAS", ["metros_cuadrados"]), "metros_cuadrados") == [(9,), (400,)]


def test_audit_counts_values_that_do_not_convert(spark):
    raw = spark.createDataFrame([("1", "x", "5"), ("1", "y", "6"), ("2", None, "n/a"), ("3", "7", None)],
                                "id_tienda string, activo string, metros_cuadrados string")
    q = quality_metrics("T", silver.counted_unique(raw, "MSTR_TIENDAS"), silver.ROWS, failures_col=silver.FAILURES)
    got = q.collect()[0]
    assert (got.total_records, got.duplicate_records, got.conversion_failures) == (4, 1, 3)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(-4 * 10**16, 4 * 10**16), st.integers(1, 4 * 10**12)), min_size=1, max_size=200))
def test_rounded_ratio_is_exact(spark, pairs):
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(pairs)], "i int, n long, d long")
    got = {r.i: r.q for r in df.select("i", rounded_ratio(F.col("n"), F.col("d")).alias("q")).collect()}
    for i, (n, d) in enumerate(pairs):
        half = Fraction(abs(n) * 100, d) - abs(n) * 100 // d
        want = Decimal(abs(n) * 100 // d + (half >= Fraction(1, 2))) / 100
        assert got[i] == float(want if n >= 0 else -want), (n, d)
