"""Exact integer k-means over bit planes.

A component is an integer of ``bits`` bits in two's complement. A vector's planes
are ``bits`` words a block of 64 components: word p holds bit p of each of the 64. The dot
product of two vectors is the sum over plane pairs (p, q) of w_p * w_q * popcount(x_p AND c_q)
with w_p = 2**p, and -2**p for the sign's plane; norms are dot products with
oneself, and squared distances follow without any rounding.

The planes are written once. Each round reads them, keeps sums of bits per cluster and
component in each task, and adds these up (k * dims numbers a task); only the k new
centroids come to the driver and go out with the next round.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almacen.llm.common import materialize, prepare

BLOCK = 64  # components of one word
LIMIT = 1 << 27  # components are below this in absolute value: 64 squared differences fit a long


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Planes (rows, bits, words) of integer components (rows, dims); dims are filled up to whole words with zeros."""
    rows, dims = values.shape
    words = -(-dims // BLOCK)
    full = np.zeros((rows, words * BLOCK), dtype=np.int64)
    full[:, :dims] = values
    out = np.empty((rows, bits, words), dtype=np.uint64)
    for p in range(bits):
        plane = ((full >> p) & 1).astype(np.uint8)
        out[:, p] = np.packbits(plane, axis=1, bitorder="little").view("<u8")
    return out


def weights(bits: int) -> np.ndarray:
    """Value of each plane: powers of two, the highest one negative."""
    w = np.int64(1) << np.arange(bits, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def dots(planes: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact dot product of each row of ``planes`` with the one vector ``other`` (bits, words)."""
    w = weights(planes.shape[1])
    out = np.zeros(len(planes), dtype=np.int64)
    for q in range(len(other)):
        if other[q].any():
            met = np.bitwise_count(planes & other[q]).sum(axis=2, dtype=np.int64)
            out += w[q] * (met @ w)
    return out


def norms(planes: np.ndarray) -> np.ndarray:
    """Exact squared length of each row."""
    w = weights(planes.shape[1])
    out = np.zeros(len(planes), dtype=np.int64)
    for q in range(planes.shape[1]):
        met = np.bitwise_count(planes & planes[:, q : q + 1]).sum(axis=2, dtype=np.int64)
        out += w[q] * (met @ w)
    return out


def nearest(planes: np.ndarray, norm: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row; the smaller number wins ties."""
    bits = planes.shape[1]
    packed = pack(centroids, bits)
    own = (centroids * centroids).sum(axis=1)
    d = np.stack([norm - 2 * dots(planes, c) + n for c, n in zip(packed, own, strict=True)], axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(d)), best]


def bit_sums(planes: np.ndarray, dims: int) -> np.ndarray:
    """Componentwise sum of the rows, from the number of set bits in each place of each plane."""
    rows, bits, words = planes.shape
    if not rows:
        return np.zeros(dims, dtype=np.int64)
    each = np.unpackbits(planes.view(np.uint8).reshape(rows, -1), axis=1, bitorder="little")
    counts = each.sum(axis=0, dtype=np.int64).reshape(bits, words * BLOCK)
    return (weights(bits) @ counts)[:dims]


def _rows(batch, bits: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(b"".join(batch.column("planes").to_pylist()), dtype="<u8")
    return flat.reshape(-1, bits, words), batch.column("norm").to_numpy()


def _pack(bits: int):
    def run(batches):
        for batch in batches:
            flat = batch.column("v")
            if not len(flat):
                continue
            planes = pack(flat.flatten().to_numpy().reshape(len(flat), -1), bits)
            norm = pa.array(norms(planes))
            yield pa.record_batch(
                [batch.column("id"), batch.column("rank"), pa.array([x.tobytes() for x in planes], pa.binary()), norm],
                names=["id", "rank", "planes", "norm"],
            )

    return run


def _partial_sums(centroids: np.ndarray, bits: int, words: int):
    k, dims = centroids.shape

    def run(batches):
        total, count = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            planes, norm = _rows(batch, bits, words)
            if not len(planes):
                continue
            cluster, _ = nearest(planes, norm, centroids)
            for c in np.unique(cluster):
                mine = planes[cluster == c]
                total[c] += bit_sums(mine, dims)
                count[c] += len(mine)
        at = np.flatnonzero(count)
        yield pa.record_batch(
            [pa.array(at.astype(np.int32)), pa.array(count[at]), pa.array(list(total[at]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    return run


def _assign(centroids: np.ndarray, bits: int, words: int):
    def run(batches):
        for batch in batches:
            planes, norm = _rows(batch, bits, words)
            if not len(planes):
                continue
            cluster, d = nearest(planes, norm, centroids)
            yield pa.record_batch(
                [batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(d)], names=["id", "cluster", "distance"]
            )

    return run


def _planes(centroids: list[list[int]]) -> int:
    """Bits that hold every component of ``centroids`` in two's complement."""
    return max([int(x if x >= 0 else ~x).bit_length() for row in centroids for x in row], default=0) + 1


def clusters(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    k: int = 8,
    rounds: int = 10,
    scale: int = 1024,
    seed: int = 3,
) -> tuple[DataFrame, list[list[int]]]:
    """k-means of integer vectors: (rows id, cluster, distance; the final centroids).

    A vector is kept when it has exactly ``dims`` components, none null, NaN or
    infinite; each component x becomes floor(scale * x) in doubles. The first centroids are the
    ``k`` kept vectors with the least sha256 of "<seed>:<id>" (equal hashes: by components;
    null ids last); fewer kept vectors make fewer centroids. Each of ``rounds``
    rounds assigns every vector to the nearest centroid (squared distance, ties to the smaller
    number) and replaces every centroid that has vectors by floor(sum / count) of its
    components. Rows that repeat an id are vectors of their own; null ids are clustered like
    others. No kept vector, no rows and no centroids. Components of 2**27 or
    more in absolute value, whose squared distances may not fit a long, end the job with an error.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    prepare(spark)
    v = F.col(vector_col)
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    small = F.forall(v, lambda x: F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(float(LIMIT)))
    ident = F.col(id_col).cast("long").alias("id")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    kept = vectors.where((F.size(v) == dims) & fine).select(
        ident, rank.alias("rank"), F.when(small, whole).otherwise(F.raise_error(F.lit("component too large"))).alias("v")
    )
    size = kept.agg(F.max(F.array_max("v")).alias("hi"), F.min(F.array_min("v")).alias("lo")).first()
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )
    if size["hi"] is None:
        return spark.createDataFrame([], schema), []
    bits, words = _planes([[size["hi"], size["lo"]]]), -(-dims // BLOCK)
    packed = materialize(kept.mapInArrow(_pack(bits), "id long, rank string, planes binary, norm long"), "planes")

    first = packed.orderBy(F.col("rank").asc_nulls_last(), "planes").select("planes").limit(k).collect()
    start = np.frombuffer(b"".join(r["planes"] for r in first), dtype="<u8").reshape(-1, bits, words)
    centroids = np.stack([bit_sums(x[None], dims) for x in start])
    for _ in range(rounds):
        parts = packed.select("planes", "norm").mapInArrow(
            _partial_sums(centroids, bits, words), "cluster int, n long, sums array<long>"
        )
        # exact: decimals hold the sum of any number of tasks; k rows come back
        cols = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
        for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *cols).collect():
            centroids[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dims)]
    assigned = packed.select("id", "planes", "norm").mapInArrow(_assign(centroids, bits, words), schema)
    return assigned, centroids.tolist()


def digest(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each row of :func:`clusters`.

    The sums are of at most k rows, which go back to the rows as a broadcast table of at most k rows.
    """
    spark = assigned.sparkSession
    assigned = materialize(assigned, "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in sums)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    rows = [(r["cluster"], int(r["s"]), total, sha[r["cluster"]]) for r in sums]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = assigned.join(F.broadcast(about), "cluster")
    return out.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
