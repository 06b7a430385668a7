"""Benchmark decontamination: rare n-gram seeds, a join, then Smith-Waterman alignment.

Words are runs without spaces; in scripts that are written without spaces each character
is one. Every word n-gram of an item is a possible seed. A copy that
reaches a share of the item's words keeps a number of them (:func:`needed`), so the most common
ones of an item, as many as that number less one, can go: a document without any of the others
has too few. What stays are the item's rarest seeds by the number of documents that hold each, without a limit on
that number, so a copy in very many documents is found like one in a single document.

The documents are read twice, however many items there are: once for the seeds they hold (a filter of
fixed size, built from all items, keeps other n-grams out of the shuffle) and once more, those
only that share a rare seed with an item, to align. Passage and item are aligned word
by word: +1 for equal words, -1 for different, left out or added ones. The score
is the best local alignment's share of the item's words. Many pairs are aligned at a time.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.llm.common import id_text, materialize, prepare
from almacen.llm.textkit import PLAIN, blocks, grams, word_hashes

SEED_WORDS = 3
SHARE = 0.5  # of the item's words, from which on a document counts as contaminated
FILTER_BITS = 20  # the filter has 2 ** 20 words of 64 bits (8 MB), whatever the benchmark's size
GROUPS = 64  # a document's items are aligned in up to so many groups
HELD_PAIRS, CELLS = 4_096, 1 << 17  # pairs a task holds before it aligns them, cells of a row of the alignments made at a time

# Thai to Burmese and Khmer, kana, Han: scripts without spaces between words
UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def plain(text: str | None) -> bytes:
    """Lower-case words without ASCII punctuation; a character of an unspaced script is a word."""
    text = (text or "").lower()
    return (text if text.isascii() else UNSPACED.sub(r" \1 ", text)).encode().translate(PLAIN)


def needed(n: int, share: float) -> int:
    """Seeds (places in the item) that a copy scoring ``share`` has, where words were replaced or left out.

    With e such words the score is at most n - 2e, so e is at most (1 - share) n / 2, and
    n - 3e - 2 seeds stay even if no seed is hit twice. An added word scores -1 and may hit
    two seeds: a copy near the threshold, its changes spread as badly as can be, can have
    fewer by one for every two words added.
    """
    return max(1, math.ceil((3 * share - 1) * n / 2 - 1e-9) - 2)


def align(item: np.ndarray, passage: np.ndarray) -> int:
    """Best local alignment score of two word sequences (match 1, mismatch and gap -1)."""
    if not len(item) or not len(passage):
        return 0
    best, row, place = 0, np.zeros(len(passage) + 1, dtype=np.int64), np.arange(len(passage) + 1)
    for w in item.tolist():
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(passage == np.uint64(w), 1, -1), row[1:] - 1)
        new[0] = 0
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + place) - place  # gaps along the passage
        best = max(best, int(row.max()))
    return best


def align_all(pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """:func:`align` of many (item, passage) pairs: those of like lengths together, the shorter ones filled up with words that match nothing."""
    best = np.zeros(len(pairs), dtype=np.int64)
    order = sorted(range(len(pairs)), key=lambda i: (len(pairs[i][1]), len(pairs[i][0])))
    while order:
        width = len(pairs[order[-1]][1])
        some = order[-max(1, CELLS // (width + 1)) :]
        del order[-len(some) :]
        depth = max(len(pairs[i][0]) for i in some)
        item, passage = np.zeros((len(some), depth), np.uint64), np.zeros((len(some), width), np.uint64)
        in_item, in_passage = np.zeros(item.shape, bool), np.zeros(passage.shape, bool)
        for r, i in enumerate(some):
            a, b = pairs[i]
            item[r, : len(a)], in_item[r, : len(a)] = a, True
            passage[r, : len(b)], in_passage[r, : len(b)] = b, True
        place = np.arange(width + 1, dtype=np.int32)
        row, top = np.zeros((len(some), width + 1), np.int32), np.zeros(len(some), np.int32)
        for k in range(depth):
            equal = (passage == item[:, k, None]) & in_passage & in_item[:, k, None]
            new = np.zeros_like(row)
            new[:, 1:] = np.maximum(row[:, :-1] + (equal * np.int32(2) - np.int32(1)), row[:, 1:] - 1)
            np.maximum(new, 0, out=new)
            row = np.maximum.accumulate(new + place, axis=1) - place  # gaps along the passage
            np.maximum(top, row.max(axis=1), out=top)
        best[some] = top
    return best


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, item_key, words): one row per distinct text, under the least id; words are hashes."""
    texts = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.groupBy("text").agg(F.min("item_id").alias("item_id")).withColumn("item_key", F.xxhash64("text"))

    def run(batches):
        for batch in batches:
            words = [word_hashes([plain(t)])[0].view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("item_id"), batch.column("item_key"), pa.array(words, pa.list_(pa.int64()))], names=["item_id", "item_key", "words"]
            )

    return texts.select("item_id", "item_key", "text").mapInArrow(run, "item_id long, item_key long, words array<long>")


def _seeds(items: DataFrame, share: float) -> DataFrame:
    """(item_key, gram, places, need): the distinct n-grams of each item."""

    def run(batches):
        for batch in batches:
            out = [[np.empty(0, np.int64)] for _ in range(4)]
            for key, words in zip(batch.column("item_key").to_pylist(), batch.column("words"), strict=True):
                own = words.values.to_numpy().view(np.uint64)
                g, places = np.unique(grams(own, SEED_WORDS), return_counts=True)
                for col, x in zip(out, (np.full(len(g), key), g.view(np.int64), places, np.full(len(g), needed(len(own), share))), strict=True):
                    col.append(x.astype(np.int64))
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in out], names=["item_key", "gram", "places", "need"])

    return items.select("item_key", "words").mapInArrow(run, "item_key long, gram long, places long, need long")


def _filter(seeds: DataFrame) -> np.ndarray:
    """Two bits of a 64-bit word for every seed: at most 2 ** FILTER_BITS rows come to the driver, whatever the benchmark's size."""
    bits = seeds.select(
        F.shiftrightunsigned("gram", 64 - FILTER_BITS).alias("slot"),
        F.expr("shiftleft(1L, int(gram & 63)) | shiftleft(1L, int(shiftright(gram, 6) & 63))").alias("bits"),
    )
    rows = bits.groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << FILTER_BITS, dtype=np.uint64)
    out[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _maybe(g: np.ndarray, bits: np.ndarray) -> np.ndarray:
    one, low = np.uint64(1), np.uint64(63)
    asked = (one << (g & low)) | (one << ((g >> np.uint64(6)) & low))
    return (bits[g >> np.uint64(64 - FILTER_BITS)] & asked) == asked


def _hits(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(doc_id, text_key, gram): distinct n-grams of each row that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            texts = [plain(t) for t in batch.column("text").to_pylist()]
            for lo, hi in blocks(texts):
                words, first = word_hashes(texts[lo:hi])[:2]
                g = grams(words, SEED_WORDS)
                place = np.flatnonzero(_maybe(g, shared.value))
                doc = np.searchsorted(first, place, side="right") - 1
                fits = place + SEED_WORDS <= first[1:][doc]
                pairs = np.unique(np.stack([doc[fits].astype(np.uint64), g[place[fits]]]), axis=1)
                at = pa.array(pairs[0].astype(np.int64) + lo)
                cols = [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(pairs[1].view(np.int64))]
                yield pa.record_batch(cols, names=["doc_id", "text_key", "gram"])

    return docs.mapInArrow(run, "doc_id long, text_key long, gram long")


def rare_seeds(seeds: DataFrame, hits: DataFrame) -> DataFrame:
    """(item_key, gram): each item's seeds but the most common, which together have fewer places than a copy needs."""
    held = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("docs"))
    common_first = Window.partitionBy("item_key").orderBy(F.desc("docs"), "gram").rowsBetween(Window.unboundedPreceding, 0)
    # a seed that no document holds joins nothing, but counts among the rarest
    known = seeds.join(held, "gram", "left").withColumn("docs", F.coalesce("docs", F.lit(0)))
    return known.withColumn("sum", F.sum("places").over(common_first)).where("sum >= need AND docs > 0").select("item_key", "gram")


def passages(places: list[tuple[int, int]], n: int, size: int) -> list[tuple[int, int]]:
    """Stretches of a document of ``size`` words where an item of ``n`` words may lie, from (document, item) places."""
    slack = n // 2 + SEED_WORDS
    spans = sorted((max(0, p - q - slack), min(size, p - q + n + slack)) for p, q in places)
    out = [spans[0]]
    for a, b in spans[1:]:
        if a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _aligned(pairs: DataFrame, share: float) -> DataFrame:
    """(doc_id, text_key, item_id, score) of the items of each row that have enough seeds in its text."""

    def run(batches):
        for batch in batches:
            ids, keys, out = batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), []
            held, best = [], defaultdict(int)  # (row, item id, item, passage) to align; best score of (row, item id, length)

            def settle(held=held, best=best):
                scores = align_all([(item, passage) for _, _, item, passage in held]).tolist()
                for (d, k, item, _), score in zip(held, scores, strict=True):
                    best[d, k, len(item)] = max(best[d, k, len(item)], score)
                held.clear()

            for d, (text, items) in enumerate(zip(batch.column("text").to_pylist(), batch.column("items").to_pylist(), strict=True)):
                words = word_hashes([plain(text)])[0]
                g = grams(words, SEED_WORDS)
                order = np.argsort(g, kind="stable")
                ranked = g[order]
                for it in items:
                    item = np.array(it["words"], np.int64).view(np.uint64)
                    own = grams(item, SEED_WORDS)
                    a, b = np.searchsorted(ranked, own), np.searchsorted(ranked, own, side="right")
                    if np.count_nonzero(b > a) < needed(len(item), share):
                        continue
                    places = [(int(p), q) for q in np.flatnonzero(b > a).tolist() for p in order[a[q] : b[q]]]
                    held += [(d, it["item_id"], item, words[x:y]) for x, y in passages(places, len(item), len(words))]
                    if len(held) >= HELD_PAIRS:
                        settle()
            settle()
            out = [(ids[d], keys[d], k, score / n) for (d, k, n), score in best.items()]
            cols = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "text_key", "item_id", "score"])

    return pairs.mapInArrow(run, "doc_id long, text_key long, item_id long, score double")


def leaks(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """(doc_id, text_key, item_id, score) of documents and items that share the seeds a score of ``share`` needs; text_key is a hash of the text.

    Null texts are empty. Items of equal texts count as one, under the least id. Items of
    fewer than three words have no n-gram and match nothing.
    """
    prepare(docs.sparkSession)
    src = id_text(docs).withColumn("text_key", F.xxhash64("text"))
    items = materialize(_items(benchmark, item_col, text_col), "items")
    seeds = materialize(_seeds(items, share), "seeds")
    hits = materialize(_hits(src, _filter(seeds)), "hits")
    pairs = hits.join(rare_seeds(seeds, hits), "gram").select("doc_id", "text_key", "item_key").distinct()
    # a row's items in groups of bounded size: as many rows at most as there are groups of items
    own = pairs.join(items, "item_key").groupBy("doc_id", "text_key", F.pmod("item_key", F.lit(GROUPS)).alias("part"))
    wanted = materialize(own.agg(F.collect_list(F.struct("item_id", "words")).alias("items")), "pairs")
    both = src.alias("d").join(wanted.alias("w"), F.expr("d.doc_id <=> w.doc_id AND d.text_key = w.text_key"))
    return materialize(_aligned(both.select("d.doc_id", "d.text_key", "d.text", "w.items"), share), "leaks")


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, item_id, score.

    score is the largest share of a benchmark item's words that the document
    aligns with (0 without an item that shares enough seeds), item_id that item (the least of
    equals; null without any), contaminated whether score >= ``share``. Rows that repeat a
    doc_id with the same text get the same result; null ids and texts are allowed.
    Other columns are not read. No documents, no rows; no items, nothing is contaminated.
    """
    best = leaks(docs, benchmark, share=share).groupBy("doc_id", "text_key").agg(
        F.max(F.struct("score", (-F.col("item_id")).alias("minus"))).alias("m")
    )
    rows = id_text(docs).select("doc_id", F.xxhash64("text").alias("text_key")).alias("d")
    out = rows.join(best.alias("b"), F.expr("d.doc_id <=> b.doc_id AND d.text_key = b.text_key"), "left")
    score = F.coalesce(F.col("b.m.score"), F.lit(0.0))
    return out.select(
        F.col("d.doc_id").alias("doc_id"), (score >= share).alias("contaminated"), (-F.col("b.m.minus")).alias("item_id"), score.alias("score")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``docs`` without the contaminated rows. All columns stay."""
    bad = leaks(docs, benchmark, share=share).where(F.col("score") >= share).select("doc_id", "text_key").distinct()
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.withColumn("_text_key", key).alias("d")
    return rows.join(bad.alias("b"), F.expr("d.doc_id <=> b.doc_id AND d._text_key = b.text_key"), "left_anti").drop("_text_key")
