"""The n-gram model against a plain one that keeps every n-gram in a dictionary."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from almacen.llm import ngram_lm as lm

GO, STOP = "\0s", "\0e"  # in no text
DOCS = "doc_id long, text string, lang string, row long, block int, train string, n_tokens int"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w] + [STOP]


class Plain:
    def __init__(self, texts, order):
        self.order, counts = order, Counter()
        self.c = Counter(w for t in texts for w in tokens(t))
        for t in texts:
            seq = [GO] * (order - 1) + tokens(t)
            counts.update(tuple(seq[i - order + 1 : i + 1]) for i in range(order - 1, len(seq)))
        self.k = {order: counts}
        for n in range(order - 1, 0, -1):
            low = Counter()
            for g, k in self.k[n + 1].items():
                low[g[1:]] += k if g[1] == GO else 1
            self.k[n] = low
        self.d = {}
        self.context = {}
        for n in range(1, order + 1):
            self.d[n] = lm.discounts(*(sum(k == i for k in self.k[n].values()) for i in (1, 2, 3, 4)))
            self.context[n] = defaultdict(list)
            for g, k in self.k[n].items():
                self.context[n][g[:-1]].append(k)

    def p(self, gram):
        if not gram:
            return 1 / (len(self.c) + 1)
        n, lower = len(gram), self.p(gram[1:])
        ks = self.context[n].get(gram[:-1])
        if not ks:
            return lower
        cut = [0, *self.d[n]]
        k = self.k[n].get(gram, 0)
        rest = sum(cut[min(x, 3)] for x in ks)
        return (max(k - cut[min(k, 3)], 0) + rest * lower) / sum(ks)

    def score(self, text):
        seq = [GO] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(seq[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(seq)))

    def base(self, text):
        n, v = sum(self.c.values()), len(self.c)
        return sum(math.log10((self.c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(text))


def corpus_of(spark, docs, order, limit=lm.BLOCK, train=None):
    df = spark.createDataFrame([(i, t, "en", 5, 6, "x", 7) for i, t in docs], DOCS).repartition(8)
    return lm.read_corpus(df, train, order, limit)


def prose(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    return [" ".join(rng.choice(words[: rng.choice((5, 20, 60))]) for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_against_a_plain_model(spark, order):
    texts = prose(order, 80)
    docs = list(enumerate(texts)) + [(3, texts[3]), (3, texts[4]), (None, texts[5].upper()), (None, "new words w1 w2")]
    docs += [(500, None), (501, ""), (502, " \t\n"), (503, "Ä w1 w2 w3"), (504, texts[6] + " </s> <s>"), (505, texts[0])]
    train = F.col("doc_id") % 5 != 0
    corpus = corpus_of(spark, docs, order, 300, train)
    assert corpus.blocks.count() > 5
    model = lm.fit(corpus)
    plain = Plain([t for i, t in docs if i is None or i % 5 != 0], order)
    assert (model.tokens, model.words) == (sum(plain.c.values()), len(plain.c))
    assert np.array(model.discounts) == pytest.approx(np.array([plain.d[n] for n in range(1, order + 1)]))
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, round(r["score"], 6), r["n_tokens"], r["n_known"], round(r["base_score"], 6))
                 for r in lm.score(corpus, model).collect())
    want = sorted((i is not None, i or 0, round(plain.score(t), 6), len(tokens(t)), sum(plain.c[w] > 0 for w in tokens(t)), round(plain.base(t), 6))
                  for i, t in docs)
    assert got == want
    again = corpus_of(spark, docs, order, 300, train)  # the same texts, but not the blocks that the model was counted from
    assert sorted(round(r["score"], 6) for r in lm.score(again, model).collect()) == sorted(x[2] for x in want)


def test_probabilities_of_all_words_add_up(spark):
    texts = prose(9, 40)
    plain = Plain(texts, 2)
    docs = [(i, f"{a} {w}") for i, (a, w) in enumerate((a, w) for a in ("w1", "w33") for w in [*plain.c, "unknown"] if w != STOP)]
    corpus = corpus_of(spark, list(enumerate(texts, 10_000)) + docs, 2, train=F.col("doc_id") >= 10_000)
    got = {r["doc_id"]: r["score"] for r in lm.score(corpus, lm.fit(corpus)).collect()}
    for a in ("w1", "w33"):
        mine = [(i, t.split()[1]) for i, t in docs if t.split()[0] == a]
        first = math.log10(plain.p((GO, a)))
        total = sum(10 ** (got[i] - first) / plain.p((w, STOP)) for i, w in mine) + plain.p((a, STOP))
        assert total == pytest.approx(1)


def test_long_texts_lie_in_several_blocks(spark, monkeypatch):
    text = prose(4, 1)[0] + " "
    docs = [(1, text * (2_500_000 // len(text)) + "end"), (2, text), (3, "x" * 2_000_000)]
    whole = corpus_of(spark, docs, 3)
    cut = corpus_of(spark, docs, 3, 20_000)
    assert cut.blocks.count() > whole.blocks.count()
    a, b = ({r["doc_id"]: r for r in lm.score(c, lm.fit(c)).collect()} for c in (whole, cut))
    plain = Plain([t for _, t in docs], 3)
    for i, t in docs:
        assert a[i]["score"] == pytest.approx(b[i]["score"], rel=1e-9) == pytest.approx(plain.score(t), rel=1e-9)
        assert a[i]["n_tokens"] == b[i]["n_tokens"] == len(tokens(t))


def test_nothing_to_learn_from_and_no_rows(spark):
    corpus = corpus_of(spark, [(1, "a b"), (2, None)], 2, train=F.lit(False))
    got = {r["doc_id"]: r for r in lm.score(corpus, lm.fit(corpus)).collect()}
    assert got[1]["score"] == 0 and got[1]["n_known"] == 0 and got[1]["train_tokens"] == 0 and got[2]["n_tokens"] == 1
    empty = corpus_of(spark, [], 2)
    assert lm.score(empty, lm.fit(empty)).count() == 0


def test_hash_arrays_and_packing(tmp_path):
    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(h)) == h).all() and len(lm.unpack_sorted(lm.pack_sorted(h[:0]))) == 0
    for top in (1, 300, 70_000, 1 << 40):
        x = rng.integers(0, top, 100)
        assert (lm.unpack_counts(lm.pack_counts(x)) == x).all()
    path = lm.write_arrays(str(tmp_path), "a", {"hash": h[::2], "c0": np.arange(len(h[::2]), dtype=np.uint16)})
    (got,) = lm.lookup(lm.read_arrays(str(tmp_path), path), h)
    assert (got[::2] == np.arange(len(h[::2]))).all() and not got[1::2].any()
    shards = lm.shard_of(h, 7)
    assert (np.diff(shards) >= 0).all() and set(shards) == set(range(7))


def test_discounts():
    assert lm.discounts(4, 3, 2, 1) == pytest.approx((1 - 0.4 * 2 * 3 / 4, 2 - 0.4 * 3 * 2 / 3, 3 - 0.4 * 4 * 1 / 2))
    assert lm.discounts(0, 1, 1, 1) == lm.discounts(5, 1, 0, 0) == lm.discounts(1, 1, 10, 1) == lm.FALLBACK
