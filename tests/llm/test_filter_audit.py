"""The filter audit against applying the filters one after another."""

import re
from itertools import permutations

import pytest

from almacen.llm import filter_audit as fa

DOCS = "doc_id long, text string, lang string, source string, n_chars long, mask int, part string, good int"
LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    rows = []
    for i, text, lang in docs:
        t = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        fails = set()
        if len(words) < 100:
            fails.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t):
            fails.add("C")
        if re.search("[#$%&*|]", t):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
            fails.add("E")
        good = any(j == i and q == 1 for j, q, _ in labels if i is not None)
        toxic = any(j == i and x == 1 for j, _, x in labels if i is not None)
        rows.append((lang or "", fails, good, toxic))
    out = set()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        found = []
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                failing = sum(f in r[1] for r in mine)
                only = sum(r[1] == {f} for r in mine)
                found.append((part, order, step, len(left), len(gone), failing - len(gone), only,
                              sum(r[2] for r in gone), sum(r[3] for r in gone), f))
        out |= {(*r[:-1], total[r[-1]]) for r in found}
    return out


def run(spark, docs, labels):
    d = spark.createDataFrame([(i, t, lang, "s", 1, 9, "p", 2) for i, t, lang in docs], DOCS).repartition(3)
    masks = fa.document_masks(d, spark.createDataFrame(labels, LABELS))
    return fa.audit(masks)


def test_against_filters_in_order(spark):
    long = " ".join(f"word{i}" for i in range(120))
    often = "again and " * 60
    docs = [(1, long, "en"), (2, long, "fr"), (3, long, "en"), (3, long, "en"), (2, long, "en"), (4, long + " ", "en")]
    docs += [(5, often, "en"), (6, often.upper(), "fr"), (7, "100% of it", None), (8, None, ""), (9, "", "de"), (None, "", "de")]
    docs += [(None, long, "de"), (None, long, "de"), (10, "\tTab\x0bWORD|\n", "de"), (11, "Ünï ÇÖDE " * 200, "de"), (12, long + " #", "fr")]
    docs += [(13, long.replace(" ", " "), "fr"), (14, "x" * 50_000, "en"), (15, often.upper() + "&", "en"), (16, often.upper() + "&", "en")]
    labels = [(1, 1, 0), (3, 1, 1), (3, 0, 0), (5, 0, 1), (6, None, 1), (7, 1, None), (16, 1, 1), (None, 1, 1), (99, 1, 1)]
    got = run(spark, docs, labels)
    assert {tuple(r) for r in got.collect()} == plain(docs, labels)


def test_no_rows_and_no_labels(spark):
    assert run(spark, [], []).count() == 0
    got = run(spark, [(1, "a", "en")], []).collect()
    assert len(got) == 600 and sum(r["removed"] for r in got) == 120 and sum(r["good_lost"] for r in got) == 0


def test_ranks_and_intervals():
    orders = ["".join(p) for p in permutations("ABCDE")]
    assert [fa.lehmer_rank(o, "ABCDE") for o in orders] == list(range(120))
    seen = {(m, r) for m, _, a, b in fa.intervals("ABCDE") for r in range(a, b)}
    assert len(seen) == 31 * 120 == sum(b - a for _, _, a, b in fa.intervals("ABCDE"))


@pytest.mark.parametrize("letters", ["AB", "ABC"])
def test_fewer_filters(spark, letters):
    masks = spark.createDataFrame([("x", m, 1 + m, m, 0) for m in range(1 << len(letters))], "part string, mask int, rows long, good long, toxic long")
    for r in fa.audit(masks, letters).collect():
        passed = sum(1 << letters.index(x) for x in r["filter_order"][: r["step"] - 1])
        own = 1 << letters.index(r["filter_order"][r["step"] - 1])
        assert r["removed"] == sum(1 + m for m in range(1 << len(letters)) if m & own and not m & passed)
