import itertools
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from almacen.llm import quality_crf, toxicity
from almacen.llm.queries import op4_quality_crf, op10_toxicity, table

SF = "/root/testdata/sf0.1"


def held_out(df):
    return df.where(F.crc32(F.col("doc_id").cast("string")) % 3 == 1)


def test_quality_on_held_out_rows(spark):
    got = op4_quality_crf(spark, SF)
    rows = got.join(table(spark, SF, "labels"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    rows = [r for r in rows if r["held_out"]]
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_toxicity_on_held_out_rows(spark):
    got = op10_toxicity(spark, SF)
    lab = held_out(table(spark, SF, "labels")).withColumnRenamed("toxic", "is_toxic")
    rows = got.join(lab, "doc_id").collect()
    assert np.mean([r["toxic"] for r in rows if r["is_toxic"]]) > 0.85
    assert np.mean([r["toxic"] for r in rows if not r["is_toxic"]]) < 0.01
    by = {k: np.mean([r["severity"] for r in rows if r["is_toxic"] == k]) for k in (0, 1)}
    assert by[0] < 0.1 < 1 < by[1]


def test_forward_backward_equals_enumeration():
    rnd = np.random.Generator(np.random.PCG64(1))
    first = np.array([0, 4, 4, 5, 11])
    node, trans = rnd.normal(size=11) * 2, rnd.normal(size=(2, 2))
    p, pair, log_z = quality_crf.forward_backward(node, first, trans)
    want_p, want_pair, total = np.zeros(11), np.zeros((2, 2)), 0.0
    for a, b in itertools.pairwise(first):
        paths = list(itertools.product((0, 1), repeat=b - a)) if b > a else []
        w = [np.exp(sum(node[a + k] for k, y in enumerate(s) if y) + sum(trans[x, y] for x, y in itertools.pairwise(s))) for s in paths]
        if paths:
            z = sum(w)
            for s, x in zip(paths, w, strict=True):
                want_p[a:b] += np.array(s) * x / z
                for u, v in itertools.pairwise(s):
                    want_pair[u, v] += x / z
    assert np.allclose(p, want_p) and np.allclose(pair, want_pair)


def test_line_features_do_not_depend_on_the_batch():
    rnd = random.Random(5)
    texts = ["\n".join("".join(rnd.choice("aB1|!* é.") for _ in range(rnd.randrange(30))) for _ in range(rnd.randrange(6))) for _ in range(50)]
    raw = [t.encode() for t in [*texts, "", "\n\n", "x"]]
    x, first, n = quality_crf.line_features(raw)
    for k, t in enumerate(raw):
        y, _, m = quality_crf.line_features([t])
        assert np.allclose(x[first[k] : first[k + 1]], y) and n[first[k] : first[k + 1]].tolist() == m.tolist()


ROWS = [(1, None), (2, ""), (3, " \n "), (None, "a b"), (4, "x"), (4, "x"), (5, "long " * 60_000), (6, "l\n" * 5_000)]


def test_models_on_odd_rows(spark, make_docs):
    docs = make_docs(ROWS, extra=True)
    labels = spark.createDataFrame([(4, 1, 1), (5, 0, 0), (5, 0, 0), (None, 1, 1), (99, 1, 0), (6, None, None)], "doc_id long, quality int, toxic int")
    model = quality_crf.fit(docs, labels)
    got = quality_crf.score(docs, model).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    left = quality_crf.keep_good(docs, model, 0.0)
    assert left.columns == docs.columns and left.count() == len(ROWS)
    graded = toxicity.grade(docs, toxicity.fit(docs, labels)).collect()
    assert len(graded) == len(ROWS) and all(0 <= r["severity"] <= 2 for r in graded)
    none = labels.limit(0)
    assert all(r["score"] == 0.5 for r in quality_crf.score(docs, quality_crf.fit(docs, none)).collect())
    assert not any(r["toxic"] for r in toxicity.grade(docs, toxicity.fit(docs, none)).collect())
    empty = make_docs([])
    assert quality_crf.score(empty, model).count() == 0 and toxicity.grade(empty, toxicity.fit(empty, labels)).count() == 0


def test_ordinal_regression_recovers_grades():
    rnd = np.random.Generator(np.random.PCG64(3))
    n, k = 3000, 30
    x = rnd.random((n, k)) < 0.2
    true = np.zeros(k)
    true[:4] = [3, 2.5, -2, 1.5]
    score = x @ true + rnd.logistic(size=n)
    grade = np.digitize(score, [1.0, 3.5])
    doc, feature = np.nonzero(x)
    w, theta = toxicity.descend(doc, feature, grade, np.full(k, 1e-3), 3)
    assert theta[0] < theta[1] and np.abs(w[4:]).max() < 0.3
    assert np.corrcoef(w, true)[0, 1] > 0.95
    model = toxicity.Model(np.arange(k, dtype=np.uint64), w, theta)
    p = model.probabilities(x @ w)
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()
    best = toxicity.Model(np.arange(k, dtype=np.uint64), true, np.array([1.0, 3.5])).probabilities(x @ true)
    assert (p.argmax(axis=1) == grade).mean() > (best.argmax(axis=1) == grade).mean() - 0.02
