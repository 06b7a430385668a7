"""Toxicity by cumulative-link ordinal regression over sparse text features.

P(grade <= k) = sigmoid(threshold_k - w x): one weight vector serves all ordered
thresholds. x marks which hashed features a text has (once, twice, four times): its words and their first
four to seven bytes. Feature statistics come from Spark aggregates over the
training rows; the model is fitted on the driver on a bounded sample, with an L1
penalty that leaves few weights. Scoring is one pass over all texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.llm.common import prepare
from almacen.llm.textkit import PLAIN, blocks, word_hashes

PREFIXES = (4, 5, 6, 7)  # bytes
MAX_ROWS = 12_000  # labelled rows that a model is fitted on: those with the least hash of doc_id
MAX_FEATURES = 1_500  # of the model: those that tell most about the grade
MIN_ROWS = 4  # of the training sample that have a feature
PENALTY, PLAIN_GAIN, STEPS = 3e-4, 5.0, 300  # a feature's L1 penalty shrinks with its likelihood gain beyond PLAIN_GAIN
# a feature that a text has so many times makes another one, its hash with these bits turned
_AGAIN = {2: np.uint64(0x5851F42D4C957F2D), 4: np.uint64(0x14057B7EF767814F)}
_CHUNK = 1 << 19  # bytes hashed at a time


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades

    def probabilities(self, score: np.ndarray) -> np.ndarray:
        """P(grade = k) for each linear score, a row per score."""
        below = _sigmoid(self.thresholds[None, :] - score[:, None])
        edges = np.concatenate([np.zeros((len(score), 1)), below, np.ones((len(score), 1))], axis=1)
        return np.diff(edges, axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def feature_sets(texts: list[str | None], only: np.ndarray | None = None):
    """For blocks of texts: (first text, end, text index, feature hash) of the distinct features; ``only`` those given (sorted)."""
    plain = [(t or "").lower().encode().translate(PLAIN) for t in texts]
    wanted = None if only is None else np.unique(np.concatenate([only, *(only ^ c for c in _AGAIN.values())]))
    for lo, hi in blocks(plain, _CHUNK):
        words, first, _, _, *more = word_hashes(plain[lo:hi], prefixes=PREFIXES)
        doc = np.repeat(np.arange(hi - lo), np.diff(first))
        docs, found = [], []
        for h in (words, *more):
            if wanted is None:
                keep = h != 0
            elif len(wanted):
                keep = wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h
            else:
                keep = np.zeros(len(h), dtype=bool)
            docs.append(doc[keep])
            found.append(h[keep])
        doc, h = np.concatenate(docs), np.concatenate(found)
        order = np.lexsort((h, doc))
        doc, h = doc[order], h[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(h)))
        doc, h = doc[at], h[at]
        out_d, out_h = [doc], [h]
        for least, c in _AGAIN.items():
            out_d.append(doc[times >= least])
            out_h.append(h[times >= least] ^ c)
        doc, h = np.concatenate(out_d), np.concatenate(out_h)
        if only is not None and len(h):
            keep = only[np.minimum(np.searchsorted(only, h), len(only) - 1)] == h if len(only) else np.zeros(len(h), dtype=bool)
            doc, h = doc[keep], h[keep]
        yield lo, hi, doc, h


def _feature_rows(only: np.ndarray | None):
    def run(batches):
        for batch in batches:
            grade = batch.column("grade").to_numpy()
            row = batch.column("row").to_numpy()
            for lo, _, doc, h in feature_sets(batch.column("text").to_pylist(), only):
                yield pa.record_batch(
                    {"row": pa.array(row[lo + doc]), "grade": pa.array(grade[lo + doc]), "feature": pa.array(h.view(np.int64))}
                )

    return run


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """(row, grade, text) of at most ``max_rows`` labelled documents, those with the least hash of doc_id.

    Rows without id, label or document are left out.
    """
    lab = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("grade"))
    lab = lab.where("doc_id IS NOT NULL")
    chosen = lab.select("doc_id", "grade").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    return texts.groupBy("doc_id").agg(F.max("grade").alias("grade"), F.min("text").alias("text")).withColumnRenamed("doc_id", "row")


def select_features(rows: DataFrame, totals: dict[int, int], max_features: int = MAX_FEATURES) -> list[tuple[int, float]]:
    """(feature, signed information about grade > 0) of the most telling features, by a likelihood-ratio test."""
    n, pos = sum(totals.values()), sum(v for k, v in totals.items() if k > 0)
    made = rows.mapInArrow(_feature_rows(None), "row long, grade int, feature long")
    counts = made.groupBy("feature").agg(F.count(F.lit(1)).alias("df"), F.sum((F.col("grade") > 0).cast("long")).alias("hit"))
    df, hit = F.col("df").cast("double"), F.col("hit").cast("double")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    share = pos / max(n, 1)
    gain = (
        part(hit, df * share) + part(df - hit, df * (1 - share)) + part(F.lit(pos) - hit, (n - df) * share)
        + part((n - df) - (F.lit(pos) - hit), (n - df) * (1 - share))
    )
    telling = counts.where(f"df >= {MIN_ROWS} AND df < {n}").withColumn("gain", gain)
    top = telling.orderBy(F.desc("gain"), "feature").limit(max_features)
    return [(r["feature"] & (1 << 64) - 1, r["gain"] if r["hit"] / r["df"] > share else -r["gain"]) for r in top.collect()]


def descend(doc: np.ndarray, feature: np.ndarray, grade: np.ndarray, penalty: np.ndarray, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by accelerated proximal gradient steps on the mean log likelihood with an L1 penalty per feature."""
    n_features = len(penalty)
    n, w, at = len(grade), np.zeros(n_features), np.zeros(n_features)
    cum = np.cumsum(np.bincount(grade, minlength=grades)[:-1]) / n
    theta = np.log(np.clip(cum, 1e-4, 1 - 1e-4) / (1 - np.clip(cum, 1e-4, 1 - 1e-4)))
    size = np.bincount(doc, minlength=n)
    rate, momentum = 4.0 / max(1.0, float(np.percentile(size, 95)) / 8), 1.0
    for _ in range(STEPS):
        score = np.bincount(doc, at[feature], n)
        upper = np.where(grade < grades - 1, _sigmoid(np.append(theta, np.inf)[grade] - score), 1.0)
        lower = np.where(grade > 0, _sigmoid(np.insert(theta, 0, -np.inf)[grade] - score), 0.0)
        prob = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / prob, lower * (1 - lower) / prob  # slopes of log prob at both thresholds
        back = (dl - du) / n  # d mean log prob / d score
        grad_w = np.bincount(feature, back[doc], n_features)
        grad_t = np.array([du[grade == k].sum() - dl[grade == k + 1].sum() for k in range(grades - 1)]) / n
        step = at + rate * grad_w
        new = np.sign(step) * np.maximum(np.abs(step) - rate * penalty, 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        at, w, momentum = new + (momentum - 1) / following * (new - w), new, following
        theta = np.maximum.accumulate(theta + rate * grad_t)
        theta += np.arange(len(theta)) * 1e-3 * (np.diff(theta, prepend=-np.inf) <= 0)
    return w, theta


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """A model of grades 0 (clean), 1 (toxic), 2 (severe), learnt from ``labels`` (doc_id, ``label`` 0 or 1).

    The labels have no severity. A toxic row counts as severe when it has at
    least as many of the features that speak for toxicity as the median toxic row.
    Without rows of both kinds the model has no features and finds nothing toxic.
    """
    prepare(docs.sparkSession)
    rows = sample(docs, labels, label, max_rows).repartition(docs.sparkSession.sparkContext.defaultParallelism, "row")
    totals = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}
    if not any(k > 0 for k in totals) or not any(k <= 0 for k in totals):
        return Model(np.empty(0, np.uint64), np.empty(0), np.array([10.0, 11.0]))
    chosen = sorted(select_features(rows, totals))
    features = np.array([f for f, _ in chosen], dtype=np.uint64)
    speaks = np.array([g for _, g in chosen])
    ids, grade, doc, feature = [], [], [], []
    for r in rows.mapInArrow(_grouped(features), "grade int, features array<int>").toLocalIterator():
        doc += [len(grade)] * len(r["features"])
        feature += r["features"]
        grade.append(int(r["grade"] > 0))
    doc, feature, grade = np.array(doc, dtype=np.int64), np.array(feature, dtype=np.int64), np.array(grade)
    strong = speaks > np.percentile(speaks[speaks > 0], 75) if (speaks > 0).any() else speaks > 0
    evidence = np.bincount(doc, strong[feature], len(grade)) if len(doc) else np.zeros(len(grade))
    median = max(1.0, float(np.median(evidence[grade > 0])))
    grade = np.where((grade > 0) & (evidence >= median), 2, grade)
    w, theta = descend(doc, feature, grade, PENALTY * np.clip(PLAIN_GAIN / np.abs(speaks), 0, 1), 3)
    used = w != 0
    return Model(features[used], w[used], theta)


def _grouped(features: np.ndarray):
    def run(batches):
        for batch in batches:
            grade = batch.column("grade").to_numpy()
            out = [[] for _ in range(len(grade))]
            for lo, _, doc, h in feature_sets(batch.column("text").to_pylist(), features):
                for d, k in zip(doc.tolist(), np.searchsorted(features, h).tolist(), strict=True):
                    out[lo + d].append(k)
            yield pa.record_batch({"grade": pa.array(grade), "features": pa.array(out, pa.list_(pa.int32()))})

    return run


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, severity (expected grade, 0 to 2), grade (likeliest), toxic (P(grade > 0) >= 0.5).

    Null and empty texts have no features and the base rate's severity. Repeated
    rows give repeated rows; other columns are not read. No rows, no rows.
    """
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for lo, hi, doc, h in feature_sets(batch.column("text").to_pylist(), model.features):
                if len(h):
                    score[lo:hi] = np.bincount(doc, model.weights[np.searchsorted(model.features, h)], hi - lo)
            p = model.probabilities(score)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "severity": pa.array(p @ np.arange(p.shape[1])),
                    "grade": pa.array(p.argmax(axis=1).astype(np.int32)),
                    "toxic": pa.array(1 - p[:, 0] >= 0.5),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, severity double, grade int, toxic boolean")
