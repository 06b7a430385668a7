import hashlib
import random
import re
from collections import Counter

import numpy as np

from almacen.llm import substring_dedup


def brute(rows, block):
    first, docs = {}, []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        docs.append((i, w))
        for k in range(len(w) - block + 1):
            key, at = tuple(w[k : k + block]), (i is not None, i or 0, k)
            first[key] = min(first.get(key, at), at)
    out = []
    for i, w in docs:
        gone = set()
        for k in range(len(w) - block + 1):
            if first[tuple(w[k : k + block])] < (i is not None, i or 0, k):
                gone.update(range(k, k + block))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["the", "of", "a", "é", "X", "x"]) if rnd.random() < 0.4 else f"w{rnd.randrange(300)}"
    passages = [[word() for _ in range(n)] for n in (5, 19, 20, 21, 35, 60, 120)]
    out = []
    for _ in range(60):
        doc = []
        for _ in range(rnd.randrange(1, 6)):
            doc += rnd.choice(passages) if rnd.random() < 0.6 else [word() for _ in range(rnd.randrange(30))]
            if rnd.random() < 0.2:
                p = rnd.choice(passages)
                doc += p[rnd.randrange(len(p)) :]
        out.append(rnd.choice([" ", "\n", "  \t"]).join(doc))
    return [*out, None, "", "a " * 300, "a " * 45 + "b", out[0], "x\x85y\xa0z " * 50]


def check(make_docs, rows, **kw):
    got = substring_dedup.factor(make_docs(rows, extra=True), digest=True, **kw).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == brute(rows, kw.get("block", 20))
    for r in got:
        assert sum(f["n"] for f in r["factors"]) == r["n_removed"]


def test_equals_brute_force(make_docs):
    check(make_docs, list(enumerate(corpus(1), start=-5)))


def test_short_blocks(make_docs):
    check(make_docs, list(enumerate(corpus(2))), block=6, seed=3, part=2000)


def test_repeated_rows_and_nulls(make_docs):
    t = " ".join(f"v{i}" for i in range(40))
    rows = [(4, t), (4, t), (None, "z " + t), (9, None)]
    got = {(r["doc_id"], r["n_removed"]) for r in substring_dedup.factor(make_docs(rows)).collect()}
    assert got == {(4, 40), (None, 0), (9, 0)}
    assert substring_dedup.factor(make_docs([])).count() == 0


def ordered(rows):
    """Rows under ids that say their order: by id, null first, rows of one id by what the operator orders texts by."""
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = SparkSession.getActiveSession()
    hashed = spark.createDataFrame([(t,) for _, t in rows], "t string").select("t", F.xxhash64(F.coalesce("t", F.lit(""))).alias("h"))
    h = {r["t"]: r["h"] for r in hashed.collect()}
    shared = Counter(i for i, _ in rows)
    places = sorted({(i is not None, i or 0, h[t] if shared[i] > 1 else 0) for i, t in rows})
    return [(places.index((i is not None, i or 0, h[t] if shared[i] > 1 else 0)), t) for i, t in rows]


def test_rows_that_share_an_id_or_have_none(make_docs):
    """Different texts under one id, or none, in every order: nothing is lost and nothing crashes."""
    p = " ".join(f"p{i}" for i in range(30))
    other = lambda tag, n: " ".join(f"{tag}{i}" for i in range(n))
    cases = [
        [(1, p), (7, other("a", 200) + " " + p), (7, other("b", 300))],
        [(1, p), (7, "short text"), (7, other("a", 200) + " " + p)],
        [(None, "short"), (None, other("c", 200)), (5, "a " + p), (9, p)],
        [(None, other("d", 50) + " " + p), (None, p), (None, None), (None, p + " end"), (3, p)],
        [(i % 4 if i % 3 else None, t) for i, t in enumerate(corpus(3))],
    ]
    for rows in cases:
        want = Counter((n, r, k) for _, n, r, k in brute(ordered(rows), 20).elements())
        for version in (rows, rows[::-1]):
            got = substring_dedup.factor(make_docs(version), digest=True).collect()
            assert Counter((r["n_words"], r["n_removed"], r["kept"]) for r in got) == want
            assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)


def test_factors_copy_from_earlier_places(make_docs):
    rows = [(i, t) for i, t in enumerate(corpus(5))]
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    n = 0
    for r in substring_dedup.factor(make_docs(rows), part=4000).collect():
        own, end = words[r["doc_id"]], 0
        for f in r["factors"]:
            a, src = f["at"], f["source_at"]
            assert (f["source_id"], src) < (r["doc_id"], a) and f["n"] > 0 and a >= end
            assert own[a : a + f["n"]] == words[f["source_id"]][src : src + f["n"]]
            end, n = a + f["n"], n + 1
    assert n > 50


def test_parse():
    i = np.array
    assert substring_dedup.parse(i([3, 4, 5, 20, 40]), i([0, 0, 0, 1, 0]), i([7, 8, 9, 0, 2]), 10) == [(3, 12, 0, 7), (20, 10, 1, 0), (40, 10, 0, 2)]
    assert substring_dedup.parse(i([3, 8]), i([2, 2]), i([0, 30]), 10) == [(3, 10, 2, 0), (13, 5, 2, 35)]
    assert substring_dedup.parse(i([3, 4]), i([0, 1]), i([0, 1]), 10) == [(3, 10, 0, 0), (13, 1, 1, 10)]
    assert substring_dedup.parse(np.array([], dtype=np.int64), np.array([]), np.array([]), 10) == []
