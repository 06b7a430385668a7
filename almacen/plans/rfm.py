"""RFM customer segmentation (GD:223-272, DM:88-95)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almacen.config import CHURN_SEGMENTS, DEFAULT_GOLD, GoldConfig
from almacen.operators.ntile import ntiles_exact


def reference_date(sales: DataFrame, as_of: dt.date | None = None, date_col: str = "fec_trans") -> Column:
    """Reference date: ``as_of`` when given (a literal, so date filters reach the
    scan), else the last sale date as a scalar subquery (no driver collect)."""
    if as_of is not None:
        return F.lit(as_of).cast("date")
    return sales.select(F.max(date_col)).scalar()


def member_days(sales: DataFrame, ids_unique: bool = True) -> DataFrame:
    """Transactions and net amount per member and day: what the RFM base and its reference date both need.

    ``ids_unique``: sales come deduplicated by ``id_trans`` (silver), so a plain
    count equals the distinct count and saves a shuffle; pass False for raw input.
    """
    count = F.count("id_trans") if ids_unique else F.count_distinct("id_trans")
    return sales.groupBy("id_miembro", "fec_trans").agg(count.alias("trans"), F.sum("vr_total_trans").alias("total"))


def base_of_days(
    daily: DataFrame, ref: Column, days: int = 90, include_anonymous: bool = True, with_ref: bool = False
) -> DataFrame:
    """:func:`rfm_base` from :func:`member_days`."""
    recent = daily.filter(F.col("fec_trans") >= F.date_sub(ref, days))
    if not include_anonymous:
        recent = recent.filter(F.col("id_miembro").isNotNull())
    aggs = [
        F.datediff(ref, F.max("fec_trans")).alias("recency_dias"),
        F.sum("trans").alias("frequency_trans"),
        F.sum("total").alias("monetary_val"),
    ]
    if with_ref:
        aggs.append(F.max(ref).alias("fec_calculo_rfm"))
    return recent.groupBy("id_miembro").agg(*aggs)


def rfm_base(
    sales: DataFrame,
    ref: Column,
    days: int = 90,
    include_anonymous: bool = True,
    ids_unique: bool = True,
    with_ref: bool = False,
) -> DataFrame:
    """Per member over sales in ``[ref - days, ref]``: recency days, frequency, monetary (decimal).

    ``ids_unique``: sales come deduplicated by ``id_trans`` (silver), so a plain
    count equals the distinct count and saves one shuffle; pass False for raw
    input. ``include_anonymous=False`` drops the null member before scoring.
    ``with_ref`` keeps the reference date as column ``fec_calculo_rfm``.
    """
    recent = sales.filter(F.col("fec_trans") >= F.date_sub(ref, days))
    if not include_anonymous:
        recent = recent.filter(F.col("id_miembro").isNotNull())
    freq = F.count("id_trans") if ids_unique else F.count_distinct("id_trans")
    aggs = [
        F.datediff(ref, F.max("fec_trans")).alias("recency_dias"),
        freq.alias("frequency_trans"),
        F.sum("vr_total_trans").alias("monetary_val"),
    ]
    if with_ref:
        aggs.append(F.max(ref).alias("fec_calculo_rfm"))
    return recent.groupBy("id_miembro").agg(*aggs)


def rfm_scores(base: DataFrame, tiles: int = 5, tie_key: str = "id_miembro", materialize=None) -> DataFrame:
    """r (recency desc), f (frequency asc), m (monetary asc) tiles; ties by member id asc, null first.

    Each tile is a sorted range exchange of the base (one row a member) numbered by
    partition offsets; ``materialize`` (default: ``reliable_checkpoint``, written to the shared
    ``spark.checkpoint.dir``) fixes the base and the sorted forms.
    """
    specs = [("recency_dias", False, "r_score"), ("frequency_trans", True, "f_score"), ("monetary_val", True, "m_score")]
    return ntiles_exact(base, tiles, specs, tie_key, materialize=materialize)


def segment_name(rules, default: str) -> Column:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    expr = None
    for name, r_lo, r_hi, f_lo, f_hi, m_lo in rules:
        cond = r.between(r_lo, r_hi) & f.between(f_lo, f_hi) & (m >= m_lo)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def rfm_segments(
    scores: DataFrame, members: DataFrame, ref: Column | None = None, cfg: GoldConfig = DEFAULT_GOLD
) -> DataFrame:
    """Segment code and name; inner join to the member hash drops groups without a member.

    The calculation date is ``ref``, or the scores' ``fec_calculo_rfm`` column when ``ref`` is None.
    """
    code = F.concat(
        F.lit("R"), F.col("r_score").cast("string"), F.lit("-F"), F.col("f_score").cast("string"),
        F.lit("-M"), F.col("m_score").cast("string"),
    )
    named = scores.withColumn("segmento_rfm", code).withColumn(
        "nombre_segmento", segment_name(cfg.segment_rules, cfg.segment_default)
    )
    m = members.select(F.col("id_miembro").alias("_m_id"), F.col("id_miembro_hash").alias("_m_hash"))
    joined = named.join(m, named["id_miembro"] == m["_m_id"], "inner")
    return joined.select(
        F.col("_m_hash").alias("sk_cliente"),
        "recency_dias",
        "frequency_trans",
        "monetary_val",
        "r_score",
        "f_score",
        "m_score",
        "segmento_rfm",
        "nombre_segmento",
        (F.col("fec_calculo_rfm") if ref is None else ref).alias("fec_calculo_rfm"),
    )


def churn_flag(segments: DataFrame, churn_segments=CHURN_SEGMENTS) -> DataFrame:
    """``alerta_churn``: the customer's segment is one of ``churn_segments``."""
    return segments.withColumn("alerta_churn", F.col("nombre_segmento").isin(list(churn_segments)))


def rfm(sales: DataFrame, members: DataFrame, cfg: GoldConfig = DEFAULT_GOLD, materialize=None) -> DataFrame:
    """Base, exact distributed tiles and segments in one plan (GD:223-272)."""
    daily = member_days(sales)
    if materialize is not None:
        daily = materialize(daily)
    ref = reference_date(daily, cfg.as_of)
    base = base_of_days(daily, ref, cfg.rfm_days, cfg.rfm_include_anonymous, with_ref=True)
    return rfm_segments(rfm_scores(base, cfg.rfm_tiles, materialize=materialize), members, None, cfg)
