"""Exact dedup by content-defined chunk recipes.

A text is cut where a rolling hash of its last 32 bytes hits a pattern, so equal
stretches give equal chunks wherever they stand. Chunks are deduplicated to
identifiers, and the identifiers are verified: the bytes of each distinct chunk
move once, and an identifier that stands for two different byte strings is
found. Documents are then compared by their ordered identifier lists, a
hundredth of their size; long texts are never moved.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.llm.common import id_text, materialize, prepare

MIN_CHUNK, CHUNK_BITS, MAX_CHUNK = 256, 10, 8192  # bytes; a cut about every 2**CHUNK_BITS bytes beyond the least size
ID_BYTES = 16
_GEAR = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of ``data`` (the last is its length; none for no bytes)."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, dtype=np.uint8)]
    for k in (1, 2, 4, 8, 16):  # after the loop h[i] weighs byte i - j by 2**j, j < 32
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    ends, last = [], 0
    for p in (np.flatnonzero(h >> np.uint32(32 - CHUNK_BITS) == 0) + 1).tolist():
        while p - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if p - last >= MIN_CHUNK:
            ends.append(p)
            last = p
    while n - last > MAX_CHUNK:
        last += MAX_CHUNK
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def chunks(data: bytes) -> list[bytes]:
    ends = cut_points(data)
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def chunk_id(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=ID_BYTES).digest()


def _recipes(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "recipe": pa.array([b"".join(map(chunk_id, chunks(t))) for t in texts], pa.binary()),
                "text_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            }
        )


def _chunks(batches):
    for batch in batches:
        own = {c for t in batch.column("text").cast(pa.binary()).to_pylist() for c in chunks(t)}
        yield pa.record_batch(
            {"chunk_id": pa.array(map(chunk_id, own), pa.binary()), "chunk": pa.array(list(own), pa.binary())}
        )


def recipes(docs: DataFrame) -> DataFrame:
    """(doc_id, recipe, text_sha256) of every row; recipe: the chunk identifiers in order, 16 bytes each."""
    prepare(docs.sparkSession)
    return id_text(docs).mapInArrow(_recipes, "doc_id long, recipe binary, text_sha256 string")


def ambiguous_ids(docs: DataFrame) -> DataFrame:
    """Chunk identifiers that stand for more than one byte string (none is expected)."""
    prepare(docs.sparkSession)
    distinct = id_text(docs).mapInArrow(_chunks, "chunk_id binary, chunk binary").distinct()
    return distinct.groupBy("chunk_id").count().where("count > 1").select("chunk_id")


def _with_ties(made: DataFrame, docs: DataFrame, bad: DataFrame) -> DataFrame:
    """``tie``: the whole text where the recipe holds an ambiguous identifier, else null."""
    lists = made.select("recipe").distinct()
    ids = lists.where("length(recipe) > 0").select(
        "recipe",
        F.explode(
            F.expr(f"transform(sequence(0, length(recipe) div {ID_BYTES} - 1), i -> substring(recipe, i * {ID_BYTES} + 1, {ID_BYTES}))")
        ).alias("chunk_id"),
    )
    suspect = ids.join(bad, "chunk_id", "left_semi").select("recipe").distinct()
    own = id_text(docs).select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.col("text").alias("tie")).distinct()
    sure = made.join(suspect, "recipe", "left_anti").withColumn("tie", F.lit(None).cast("string"))
    unsure = made.join(suspect, "recipe", "left_semi").alias("m").join(
        own.alias("o"), F.expr("m.doc_id <=> o.doc_id AND m.text_sha256 = o.text_sha256")
    )
    return sure.unionByName(unsure.select("m.*", "o.tie"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows with byte-equal texts form a group; its row with the largest doc_id
    stays. Null texts count as empty texts and empty texts equal one another.
    A null doc_id is smaller than any other (a group of nulls only has a null
    keep_id, and its rows are kept). Rows that repeat the kept doc_id are all
    marked kept. Other columns of ``docs`` are not read. No rows, no rows.
    """
    made = recipes(docs)
    bad = materialize(ambiguous_ids(docs), "ambiguous")
    if bad.isEmpty():  # identifiers are proven one to one: equal lists are equal texts
        made = made.withColumn("tie", F.lit(None).cast("string"))
    else:
        made = _with_ties(made, docs, bad)
    made = made.withColumn("n_bytes", F.length("recipe"))
    groups = made.groupBy("recipe", "tie").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.max("n_bytes").alias("n_bytes")
    )
    # n_bytes follows from the recipe; as a further join key it gives both sides an
    # exchange of their own, so that AQE can split the rows of a hot group
    out = made.alias("d").join(
        groups.where("group_size > 1").alias("g"),
        F.expr("d.recipe = g.recipe AND d.n_bytes = g.n_bytes AND d.tie <=> g.tie"),
        "left",
    )
    return out.select(
        F.col("d.doc_id").alias("doc_id"),
        F.when(F.col("g.group_size").isNull(), F.col("d.doc_id")).otherwise(F.col("g.keep_id")).alias("keep_id"),
        F.coalesce("g.group_size", F.lit(1)).cast("long").alias("group_size"),
        F.expr("g.group_size IS NULL OR d.doc_id <=> g.keep_id").alias("kept"),
        F.col("d.text_sha256").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts: the one with the largest doc_id.

    Rows that repeat both doc_id and text leave one row. All columns stay.
    """
    kept = exact_groups(docs).where("kept").select("doc_id", "text_sha256").distinct()
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = docs.withColumn("_sha", sha).alias("x")
    out = rows.join(kept.alias("k"), F.expr("x.doc_id <=> k.doc_id AND x._sha = k.text_sha256"), "left_semi")
    return out.dropDuplicates(["doc_id", "_sha"]).drop("_sha")
