"""Training-data pipeline over ``documents``: quality, exact and near copies, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.llm import byte_bpe, decontaminate, exact_dedup, near_dedup, quality_crf
from almacen.llm.common import materialize
from almacen.llm.queries import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the line model rejects go."""
    labels = quality_crf.training_labels(table(spark, sf_dir, "labels"))
    return quality_crf.keep_good(docs, quality_crf.fit(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8 or more) the one with the least doc_id stays."""
    return near_dedup.keep_one(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item, or an edited copy of one, go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left: doc_id, n_tokens, ids, and whether they decode to the text again."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = byte_bpe.decode(byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select(
        "doc_id", F.expr("length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("text_sha256"), "ids"
    )


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]

ORACLE_SQL = None  # a fitted model and token ids: tested against brute force instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; one row per document that is left."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
