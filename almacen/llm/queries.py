"""Registered queries of the corpus operators: op<N>_<name> over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.llm import (
    bitplane_kmeans,
    byte_bpe,
    decontaminate,
    exact_dedup,
    filter_audit,
    html_text,
    near_dedup,
    ngram_lm,
    pii,
    quality_crf,
    substring_dedup,
    token_files,
    toxicity,
)
from almacen.llm.common import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode ``documents``, write the shards, read them back."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.read_documents(token_files.write_shards(table(spark, sf_dir, "documents"), path))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the digest of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, ranks).select(
        "doc_id",
        F.expr("length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.factor(table(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op4_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_crf.fit(docs, quality_crf.training_labels(table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    scored = quality_crf.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document; the model learns from the same rows as the quality model does."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.grade(docs, toxicity.fit(docs, quality_crf.training_labels(table(spark, sf_dir, "labels"))))


def op11_bitplane_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane_kmeans.digest(*bitplane_kmeans.clusters(table(spark, sf_dir, "embeddings")))


def op12_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text under the model of the texts that are not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    corpus = ngram_lm.read_corpus(table(spark, sf_dir, "documents"), ~held_out)
    scored = ngram_lm.score(corpus, ngram_lm.fit(corpus))
    return scored.select("doc_id", held_out.alias("held_out"), *[c for c in scored.columns if c != "doc_id"])


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = filter_audit.document_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(materialize(masks, "masks"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in sorted(globals().items()) if name.startswith("op") and callable(fn)
}

def _kmeans_sql(k: int = 8, rounds: int = 10) -> str:
    """The rounds of op11 one after another, each a pair of tables."""
    near = """SELECT rid, c, d FROM (
            SELECT v.rid, m.c, list_sum(list_transform(list_zip(v.x, m.y), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
            FROM vec v, cent{i} m
        ) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1"""
    parts = [
        """vec AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64
        )""",
        f"""cent0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, x AS y FROM vec
            ORDER BY sha256('3:' || vec_id) LIMIT {k}
        )""",
    ]
    for i in range(rounds):
        parts.append(f"near{i} AS MATERIALIZED ({near.format(i=i)})")
        parts.append(f"""sums{i} AS MATERIALIZED (
            SELECT c, list(floor_mean ORDER BY pos) AS y FROM (
                SELECT c, pos, (s - ((s % n) + n) % n) // n AS floor_mean FROM (
                    SELECT n.c, u.pos, sum(u.val)::BIGINT AS s, count(*)::BIGINT AS n
                    FROM near{i} n JOIN (
                        SELECT rid, unnest(x) AS val, generate_subscripts(x, 1) AS pos FROM vec
                    ) u USING (rid) GROUP BY n.c, u.pos
                )
            ) GROUP BY c
        )""")
        parts.append(f"""cent{i + 1} AS MATERIALIZED (
            SELECT o.c, coalesce(s.y, o.y) AS y FROM cent{i} o LEFT JOIN sums{i} s USING (c)
        )""")
    parts.append(f"ended AS MATERIALIZED ({near.format(i=rounds)})")
    return f"""
        WITH {", ".join(parts)}
        SELECT v.vec_id, l.c::INTEGER AS cluster, l.d AS distance,
               (sum(l.d) OVER (PARTITION BY l.c))::BIGINT AS cluster_inertia, (sum(l.d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(m.y, ',')) AS centroid_sha256
        FROM ended l JOIN vec v USING (rid) JOIN cent{rounds} m USING (c)
    """


ORACLE_SQL: dict[str, str] = {
    "op11_bitplane_kmeans": _kmeans_sql(),
    "op13_filter_audit": r"""
        WITH words AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents
        ), told AS (
            SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic
            FROM labels GROUP BY doc_id
        ), failing AS (
            SELECT words.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END)
                || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
                || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END)
                || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
                || (CASE WHEN words.doc_id > min(words.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
            FROM words LEFT JOIN told USING (doc_id)
        ), counted AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails
        ), letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
        ), orders AS (
            SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letter a, letter b, letter c, letter d, letter e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), removal AS (
            SELECT part, filter_order, fails, n, good, toxic,
                   list_min(list_transform(string_split(fails, ''), lambda f: CASE WHEN f = '' THEN 6 ELSE strpos(filter_order, f) END)) AS gone
            FROM counted, orders
        ), grid AS (
            SELECT part, filter_order, s.step, substr(filter_order, s.step::INT, 1) AS f
            FROM (SELECT DISTINCT part FROM counted), orders, range(1, 6) s(step)
        ), each AS (
            SELECT g.part, g.filter_order, g.step, g.f,
                   sum(CASE WHEN r.gone > g.step THEN r.n ELSE 0 END) AS kept,
                   sum(CASE WHEN r.gone = g.step THEN r.n ELSE 0 END) AS removed,
                   sum(CASE WHEN r.gone < g.step AND contains(r.fails, g.f) THEN r.n ELSE 0 END) AS redundant,
                   sum(CASE WHEN r.fails = g.f THEN r.n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN r.gone = g.step THEN r.good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN r.gone = g.step THEN r.toxic ELSE 0 END) AS toxic_lost
            FROM grid g JOIN (SELECT * REPLACE (CASE WHEN fails = '' THEN 6 ELSE gone END AS gone) FROM removal) r
              USING (part, filter_order)
            GROUP BY ALL
        )
        SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
               redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
               toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
        FROM each
    """,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
}
