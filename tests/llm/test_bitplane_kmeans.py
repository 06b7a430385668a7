"""Bit-plane k-means against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from almacen.llm import bitplane_kmeans as km

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, planes int"


def plain(rows, k, rounds, dims, scale=1024, seed=3):
    """(vec_id, cluster, distance) of each kept row and the centroids, one number at a time."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cents = [list(v) for _, v in named[:k]]

    def assign():
        out = []
        for i, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in cents]
            out.append((i, d.index(min(d)), min(d), v))
        return out

    for _ in range(rounds):
        groups = {}
        for _, c, _, v in assign():
            groups.setdefault(c, []).append(v)
        for c, vs in groups.items():
            cents[c] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    return sorted((i is not None, i or 0, c, d) for i, c, d, _ in assign()), cents


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, "x", 1) for i, v in rows], SCHEMA).repartition(3)


def result(assigned):
    return sorted((r["id"] is not None, r["id"] or 0, r["cluster"], r["distance"]) for r in assigned.collect())


@pytest.mark.parametrize("dims", [64, 70, 3])
def test_against_plain_integers(spark, dims):
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(i % 5, 1) / 3 for _ in range(dims)]) for i in range(60)]
    rows += [(200 + i, rows[7][1]) for i in range(20)]  # one vector many times
    rows += [(7, rows[8][1]), (7, rows[7][1]), (None, rows[3][1]), (None, rows[4][1])]
    rows += [(300, None), (301, []), (302, [1.0] * (dims - 1)), (303, [1.0] * (dims + 1)), (304, [None] * dims)]
    rows += [(305, [float("nan")] * dims), (306, [float("-inf")] + [0.0] * (dims - 1)), (307, [0.0] * dims), (308, [-20.0] * dims)]
    rows = [r for r in rows if r[0] != 7 or r[1] is not rows[7][1]] + [(7, rows[7][1])]
    assigned, cents = km.clusters(frame(spark, rows), dims=dims, k=4, rounds=5)
    want, want_cents = plain(rows, 4, 5, dims)
    assert cents == want_cents
    assert result(assigned) == want


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    same = [0.5] * 64
    rows = [(i, same) for i in range(12)]
    assigned, cents = km.clusters(frame(spark, rows))
    assert {(r["cluster"], r["distance"]) for r in assigned.collect()} == {(0, 0)}
    assert cents == [[512] * 64] * 8


def test_few_vectors_empty_tables_and_digest(spark):
    rows = [(1, [0.1] * 64), (2, [-0.3] * 64)]
    assigned, cents = km.clusters(frame(spark, rows))
    out = {r["vec_id"]: r for r in km.digest(assigned, cents).collect()}
    assert len(cents) == 2 and {r["distance"] for r in out.values()} == {0}
    own = cents[out[1]["cluster"]]
    assert out[1]["centroid_sha256"] == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
    assigned, cents = km.clusters(frame(spark, rows).where("false"))
    empty = km.digest(assigned, cents)
    assert cents == [] and empty.count() == 0 and len(empty.columns) == 6


def test_large_components_are_exact_or_an_error(spark):
    rows = [(i, [float(((-1) ** i) * (100_000 + i * 64))] * 64) for i in range(6)]
    assigned, _ = km.clusters(frame(spark, rows), k=2, rounds=2)
    assert result(assigned) == plain(rows, 2, 2, 64)[0]
    with pytest.raises(Exception, match="component too large"):
        km.clusters(frame(spark, [(1, [1e30] * 64)]))


def test_planes():
    rng = np.random.default_rng(1)
    v = rng.integers(-1024, 1024, (50, 64))
    planes = km.pack(v, 11)
    assert (km.norms(planes) == (v * v).sum(axis=1)).all()
    assert (km.dots(planes, km.pack(v[:1], 11)[0]) == v @ v[0]).all()
    assert (km.bit_sums(planes, 64) == v.sum(axis=0)).all()
