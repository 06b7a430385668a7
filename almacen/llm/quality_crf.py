"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad; its score comes from features of the line and of its
neighbours, and a transition weight ties the labels of adjacent lines. Lines
learn the label of their document. A document's quality is the mean of its
lines' forward-backward marginals, weighted by their length and calibrated on
the training documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.llm.common import prepare
from almacen.llm.textkit import blocks, mix, word_hashes

MAX_ROWS = 4_000  # labelled documents that a model is fitted on: those with the least hash of doc_id
STEPS, RATE, DECAY = 150, 0.15, 1e-3
_CHUNK = 1 << 19  # bytes looked at together


def _bytes(test) -> np.ndarray:
    return np.array([test(c) for c in range(256)], dtype=bool)


_KINDS = [
    _bytes(lambda c: 65 <= c <= 90),  # capitals
    _bytes(lambda c: 48 <= c <= 57),  # digits
    _bytes(lambda c: chr(c) in "!?"),
    _bytes(lambda c: chr(c) in "|<>{}[]()=/\\_~^`+"),
    _bytes(lambda c: chr(c) in "*%&$#@"),
    _bytes(lambda c: chr(c) in ".,;:'\"-"),
    _bytes(lambda c: c > 127),
]
N_OWN = 2 * len(_KINDS) + 8
N_FEATURES = 3 * N_OWN + 2  # of the line, the one before, the one after; first, last


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line with words, first line of each text plus the total, words of each line)."""
    parts = [t.split(b"\n") for t in texts]
    lines = [x.replace(b"\r", b" ") for p in parts for x in p]
    doc = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    if not lines:
        return np.empty((0, N_FEATURES), np.float32), np.zeros(len(texts) + 1, np.int64), np.empty(0, np.int64)
    words, first, start, end = word_hashes(lines)
    n_words = np.diff(first)
    own = np.flatnonzero(n_words)  # lines without words are left out
    doc, n, size = doc[own], n_words[own].astype(np.float64), np.array([len(x) for x in lines], dtype=np.float64)[own]
    if not len(own):
        return np.empty((0, N_FEATURES), np.float32), np.zeros(len(texts) + 1, np.int64), np.empty(0, np.int64)
    buf = np.frombuffer(b"\n".join(lines) + b"\n", dtype=np.uint8)
    at = np.concatenate([[0], np.cumsum([len(x) + 1 for x in lines])])
    cols = []
    for kind in _KINDS:
        run = np.concatenate([[0], np.cumsum(kind[buf])])
        share = ((run[at[1:]] - run[at[:-1]])[own]) / size
        cols += [np.minimum(1, 4 * share), share > 0.12]
    line = np.repeat(np.arange(len(lines)), n_words)
    same = np.zeros(len(words) + 1)
    if len(words) > 1:
        same[1:-1] = np.cumsum((words[1:] == words[:-1]) & (line[1:] == line[:-1]))
        same[-1] = same[-2]
    last = np.maximum(first[1:][own] - 1, 0)
    again = (same[np.maximum(last, 0)] - same[first[:-1][own]]) / n
    pairs = _distinct((line.astype(np.uint64) << np.uint64(40)) | (words >> np.uint64(24)))  # fewer than 2**24 lines
    distinct = np.bincount((pairs >> np.uint64(40)).astype(np.int64), minlength=len(lines))[own] / n
    whole = _line_hash(words, first)[own]
    _, back, count = np.unique(whole ^ mix(doc.astype(np.uint64)), return_inverse=True, return_counts=True)
    cols += [
        again, again > 0.3, np.where(n >= 5, 1 - distinct, 0), count[back] > 1,
        np.minimum(1, np.log1p(n) / 6), n < 3, np.minimum(1, size / n / 20), np.ones(len(own)),
    ]
    x = np.stack(cols, axis=1).astype(np.float32)
    begin, stop = np.ones(len(own), dtype=bool), np.ones(len(own), dtype=bool)
    begin[1:] = doc[1:] != doc[:-1]
    stop[:-1] = begin[1:]
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[begin], after[stop] = 0, 0
    full = np.concatenate([x, before, after, np.stack([begin, stop], axis=1)], axis=1).astype(np.float32)
    return full, np.searchsorted(doc, np.arange(len(texts) + 1)), n.astype(np.int64)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def _line_hash(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of the word sequence of each line."""
    with np.errstate(over="ignore"):
        place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
        run = np.concatenate([[np.uint64(0)], np.cumsum(words * (2 * place.astype(np.uint64) + np.uint64(1)))])
        return run[first[1:]] - run[first[:-1]]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of a line's features, for good against bad
    transitions: np.ndarray  # [label of a line, label of the next], 0 bad, 1 good
    slope: float
    offset: float
    base: float  # share of good documents

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """P(good) of each text, between 0 and 1; texts without words have the base share."""
        out = np.empty(len(texts))
        for lo, hi in blocks(texts, _CHUNK):
            x, first, n = line_features(texts[lo:hi])
            mean, has = document_means(x, first, n, self.weights, self.transitions)
            out[lo:hi] = np.where(has, _sigmoid(self.offset + self.slope * _logit(mean)), self.base)
        return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def forward_backward(node: np.ndarray, first: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(P(good) of every line, expected transitions, log of the partition function) of all chains at once.

    ``node`` is the score of good against bad; chain k has the lines first[k] to first[k + 1].
    One numpy step per line number, over the chains that are that long.
    """
    total = len(node)
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    start, length = first[:-1][order], length[order]
    longest = int(length[0]) if len(length) else 0
    active = [int(k) for k in np.searchsorted(-length, -np.arange(1, longest + 1), side="right")]
    psi = np.exp(trans)
    emit = np.stack([1 - (good := _sigmoid(node)), good], axis=1)  # normalised per line
    alpha, beta, scale = np.zeros((total, 2)), np.ones((total, 2)), np.ones(total)
    for t in range(longest):
        at = start[: active[t]] + t
        a = emit[at] * (0.5 if t == 0 else 1.0)
        if t:
            a = emit[at] * (alpha[at - 1] @ psi)
        scale[at] = a.sum(axis=1)
        alpha[at] = a / scale[at][:, None]
    for t in range(longest - 2, -1, -1):
        at = start[: active[t + 1]] + t
        beta[at] = ((emit[at + 1] * beta[at + 1]) @ psi.T) / scale[at + 1][:, None]
    p = alpha * beta
    p /= p.sum(axis=1, keepdims=True)
    inner = np.ones(total, dtype=bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(inner)
    pair = alpha[at - 1][:, :, None] * psi[None] * (emit[at] * beta[at])[:, None, :] / scale[at][:, None, None]
    log_z = float(np.log(scale).sum() + np.log1p(np.exp(-np.abs(node))).sum() + np.maximum(node, 0).sum())
    return p[:, 1], pair.sum(axis=0), log_z


def document_means(x, first, n, weights, trans) -> tuple[np.ndarray, np.ndarray]:
    """(mean marginal of the lines weighted by their words, whether the document has lines)."""
    has = np.diff(first) > 0
    if not len(x):
        return np.full(len(has), 0.5), has
    p, _, _ = forward_backward(x @ weights, first, trans)
    doc = np.repeat(np.arange(len(has)), np.diff(first))
    weight = np.bincount(doc, n, len(has))
    return np.bincount(doc, p * n, len(has)) / np.maximum(weight, 1), has


def learn(x: np.ndarray, first: np.ndarray, n: np.ndarray, label: np.ndarray) -> Model:
    """Maximum likelihood (Adam steps on the mean per line, with weight decay) with every line labelled as its document."""
    good = np.repeat(label, np.diff(first)).astype(float)
    weights, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    inner = np.ones(len(x), dtype=bool)
    inner[first[:-1][np.diff(first) > 0]] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (good[at - 1].astype(int), good[at].astype(int)), 1)
    # lines weigh as much as their share of a document, so that long documents don't outweigh the rest
    share = 1 / np.repeat(np.maximum(np.diff(first), 1), np.diff(first)) * len(x) / max(1, (np.diff(first) > 0).sum())
    theta = np.concatenate([weights, trans.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        p, pair, _ = forward_backward(x @ theta[:-4], first, theta[-4:].reshape(2, 2))
        grad = np.concatenate([x.T @ ((good - p) * share), (seen - pair).ravel()]) / len(x) - DECAY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        theta[-4:] = np.clip(theta[-4:], -1.5, 1.5)  # a bounded tie: every line of a document has its label
    weights, trans = theta[:-4], theta[-4:].reshape(2, 2)
    mean, has = document_means(x, first, n, weights, trans)
    slope, offset = calibrate(_logit(mean[has]), label[has])
    return Model(weights, trans, slope, offset, float(label.mean()))


def calibrate(z: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of a logistic fit of ``label`` on ``z`` (Newton steps, a weak ridge)."""
    a = np.stack([z, np.ones_like(z)], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(25):
        p = _sigmoid(a @ b)
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-3 * np.eye(2)
        b = b + np.clip(np.linalg.solve(h, a.T @ (label - p) - 1e-3 * b), -2, 2)
    return float(max(b[0], 1e-3)), float(b[1])


def training_labels(labels: DataFrame) -> DataFrame:
    """The rows that may be learnt from: crc32 of doc_id as text, modulo 3, is not 1."""
    return labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Model:
    """A model from ``labels`` (doc_id, ``label`` 0 or 1) of at most ``max_rows`` documents, by least hash of doc_id.

    Rows without id, label or document are left out. Without any row every
    document scores 0.5; with one kind only the features still tell.
    """
    prepare(docs.sparkSession)
    lab = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("good"))
    chosen = lab.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")

    def features(batches):
        for batch in batches:
            texts, good = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("good").to_pylist()
            for lo, hi in blocks(texts, _CHUNK):
                x, first, n = line_features(texts[lo:hi])
                cut = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
                yield pa.record_batch(
                    {
                        "good": pa.array(good[lo:hi], pa.int32()),
                        "x": pa.array([x[a:b].astype(np.float16).tobytes() for a, b in cut], pa.binary()),
                        "n": pa.array([n[a:b].tobytes() for a, b in cut], pa.binary()),
                    }
                )

    got = rows.select("good", "text").mapInArrow(features, "good int, x binary, n binary")
    label_of, x, n = [], [], []
    for r in got.toLocalIterator():
        label_of.append(1.0 if r["good"] else 0.0)
        x.append(np.frombuffer(r["x"], np.float16).reshape(-1, N_FEATURES).astype(np.float32))
        n.append(np.frombuffer(r["n"], np.int64))
    if not label_of or not sum(map(len, x)):
        return Model(np.zeros(N_FEATURES), np.zeros((2, 2)), 1.0, 0.0, 0.5)
    first = np.concatenate([[0], np.cumsum([len(a) for a in x])])
    return learn(np.concatenate(x), first, np.concatenate(n), np.array(label_of))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs``: P(good) between 0 and 1.

    Null and empty texts and texts without words score the share of good training documents.
    Repeated rows give repeated rows; null ids are allowed; other columns are not read. No rows, no rows.
    """
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(model.scores(texts))})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score below ``least``. All columns stay, whatever their names."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array(model.scores([t or b"" for t in texts]) >= least))

    return docs.mapInArrow(run, docs.schema)
