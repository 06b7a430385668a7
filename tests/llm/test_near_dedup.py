import random
import re

import numpy as np

from almacen.llm import near_dedup

WORDS = [f"w{i}" for i in range(400)]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def shingles(t, n):
    w = words(t)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, n=4, percent=80):
    sets = [(i, shingles(t, n)) for i, t in rows]
    comp = {i: i for i, _ in rows}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((root(i), root(j)))
                comp[hi] = lo
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def corpus(seed):
    rnd = random.Random(seed)
    out = ["", None, "  \n", "one", "ONE", "one two", "One Two", "one two three", "Éa b c d", "éa b c d"]
    for _ in range(25):  # groups of copies with ever more edits
        text = [rnd.choice(WORDS) for _ in range(rnd.choice([4, 5, 6, 9, 30, 120, 500]))]
        for edits in range(rnd.randrange(1, 9)):
            copy = list(text)
            for _ in range(edits):
                copy[rnd.randrange(len(copy))] = rnd.choice(WORDS)
            out.append(" ".join(copy))
            if rnd.random() < 0.3:
                text = copy  # chains
    out += [" ".join(rnd.choice(WORDS) for _ in range(40)) for _ in range(20)]
    rnd.shuffle(out)
    return out


def test_equals_brute_force(make_docs):
    rows = list(enumerate(corpus(1), start=-3))
    got = near_dedup.near_groups(make_docs(rows, extra=True), shingle=4, percent=80).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_borderline_pairs(make_docs):
    base = [f"x{i}" for i in range(12)]  # 9 shingles of four words
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1])), (3, " ".join(base[1:-1])), (4, " ".join([*base, "y", "z"]))]
    got = near_dedup.near_groups(make_docs(rows), shingle=4, percent=80).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_repeated_rows_nulls_and_empty(make_docs):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "p q r s"), (2, "A B C D E"), (None, None)]
    got = near_dedup.near_groups(make_docs(rows), shingle=4).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (None, 1, None, True), (2, 2, 1, False), (None, 0, None, True)], key=str
    )
    assert near_dedup.near_groups(make_docs([])).count() == 0
    assert {r["doc_id"] for r in near_dedup.keep_one(make_docs(rows), 4).collect()} == {1, None}


def test_rows_without_ids_and_ids_with_two_texts(make_docs):
    text = lambda name, n=30: " ".join(f"{name}{i}" for i in range(n))
    rows = [(1, text("a")), (None, text("a").upper()), (None, text("b")), (2, text("c")), (3, text("c") + " x"), (3, text("d"))]
    rows += [(None, text("e")), (None, text("e") + " y"), (None, text("f")), (None, text("f")), (None, None), (None, "")]
    rows += [(None, text("b") + " z " + text("q", 90)), (4, text("g")), (4, text("h")), (5, text("h") + " x")]
    docs = make_docs(rows)
    got = near_dedup.near_groups(docs, shingle=4).collect()
    count = lambda i, comp, kept: sum((r["doc_id"], r["component_id"], r["kept"]) == (i, comp, kept) for r in got)
    assert len(got) == len(rows)
    assert count(None, 1, False) == 1 and count(None, None, False) == 2 and count(None, None, True) == 6
    assert count(3, 2, False) == 1 and count(3, 3, True) == 1 and count(4, 4, True) == 2 and count(5, 4, False) == 1
    left = near_dedup.keep_one(docs, shingle=4)
    assert left.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in left.collect()]
    e = [x for x in left if x[1] and x[1].startswith("e0")]
    want = [x for x in rows if x not in (rows[1], rows[4], rows[6], rows[7], rows[9], rows[15])] + [rows[9]]
    assert len(e) == 1 and sorted((x for x in left if x not in e), key=str) == sorted(want, key=str)


def test_estimate_is_close():
    rnd = np.random.Generator(np.random.PCG64(5))
    for size in (5, 60, 3000):
        err = []
        for _ in range(30):
            both = rnd.integers(0, 1 << 63, size * 8 // 10, dtype=np.uint64) * np.uint64(2)
            own = [rnd.integers(0, 1 << 63, size // 10, dtype=np.uint64) * np.uint64(2) for _ in "ab"]
            a, b = (near_dedup.sketch(np.unique(np.concatenate([both, o]))) for o in own)
            true = len(both) / (len(both) + len(own[0]) * 2)
            err.append(float(near_dedup.similarity(a, b)) - true)
        assert abs(np.mean(err)) < 0.06 and max(map(abs, err)) < 0.3


def test_group_of_edited_copies(make_docs, monkeypatch):
    """Copies of one text, most with too many edits for a link, some copied again: no link is lost, few pairs are compared."""
    rnd = random.Random(7)
    base = [rnd.choice(WORDS) for _ in range(150)]
    texts = []
    for _ in range(220):
        copy = list(rnd.choice(texts[-40:])) if texts and rnd.random() < 0.2 else list(base)
        for _ in range(rnd.randrange(12)):
            copy[rnd.randrange(len(copy))] = f"{rnd.choice(WORDS)}{rnd.randrange(30)}"
        texts.append(copy)
    rows = list(enumerate(map(" ".join, texts)))
    compared, promising = [], near_dedup._Links.promising

    def counted(self, pairs):
        out = promising(self, pairs)
        compared.append(out.count())
        return out

    monkeypatch.setattr(near_dedup._Links, "promising", counted)
    got = near_dedup.near_groups(make_docs(rows), shingle=4, percent=80).collect()
    want = brute(rows)
    assert sorted(map(tuple, got)) == want
    assert 1 < len({c for _, _, c, _ in want}) < 200
    assert sum(compared) < 6 * len(rows)  # all pairs would be 24,090
