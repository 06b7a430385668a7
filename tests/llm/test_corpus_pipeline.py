"""The pipeline against a plain version of every stage on its own input."""

import hashlib

import numpy as np

import corpus_pipeline
from almacen.llm import decontaminate, quality_crf
from almacen.llm.queries import table
from almacen.llm.textkit import word_hashes
from tests.llm.test_near_dedup import brute as near_brute
from tests.llm.test_tokens import encoding

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def run_stages(spark, docs, sf_dir):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
        out.append((name, docs))
    return out


def plain(spark, docs, sf_dir):
    rows = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    model = quality_crf.fit(docs, quality_crf.training_labels(table(spark, sf_dir, "labels")))
    score = model.scores([t.encode() for t in rows.values()])
    rows = {i: t for (i, t), s in zip(rows.items(), score, strict=True) if s >= 0.5}
    yield set(rows)
    last = {}
    for i in sorted(rows):
        last[rows[i]] = i
    rows = {i: rows[i] for i in last.values()}
    yield set(rows)
    rows = {i: rows[i] for i, _, _, kept in near_brute(sorted(rows.items()), 5, 80) if kept}
    yield set(rows)
    items = [word_hashes([decontaminate.plain(r["text"])])[0] for r in table(spark, sf_dir, "benchmark").collect()]
    words = {i: word_hashes([decontaminate.plain(t)])[0] for i, t in rows.items()}
    bad = {i for i, w in words.items() if any(decontaminate.align(x, w) >= 0.5 * len(x) for x in items if len(x) >= 3)}
    rows = {i: t for i, t in rows.items() if i not in bad}
    yield set(rows)
    enc = encoding()
    yield {(i, tuple(enc.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows.items()}


def test_every_stage_equals_the_plain_version(spark):
    docs = table(spark, SF, "documents")
    n = docs.count()
    for (name, got), want in zip(run_stages(spark, docs, SF), plain(spark, docs, SF), strict=True):
        if name == "byte_bpe":
            assert {(r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), r["text_sha256"]) for r in got.collect()} == want
            assert got.where("n_tokens * 4 <> length(ids)").count() == 0
        else:
            assert got.columns == COLUMNS
            assert {r["doc_id"] for r in got.collect()} == want, name
    assert 0 < len(want) < n


def test_run_equals_the_stages_and_odd_rows(spark, make_docs, tmp_path):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "x y z"), (3, "x y z"), (4, "long words here " * 9000), (5, " \n\t")]
    docs = make_docs(rows)
    for t in ("labels", "benchmark"):
        table(spark, SF, t).write.parquet(f"{tmp_path}/{t}.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    stages = run_stages(spark, table(spark, str(tmp_path), "documents"), str(tmp_path))
    assert sorted(map(str, got)) == sorted(map(str, stages[-1][1].collect()))
    empty = run_stages(spark, docs.limit(0), str(tmp_path))
    assert all(df.count() == 0 for _, df in empty)
