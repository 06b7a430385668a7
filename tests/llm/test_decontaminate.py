import random

import numpy as np

from almacen.llm import decontaminate


def brute(a, b):
    """Smith-Waterman, cell by cell."""
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_align_equals_brute_force():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = ([rnd.randrange(5) for _ in range(rnd.randrange(14))] for _ in "ab")
        assert decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64)) == brute(a, b)


def test_many_alignments_equal_single_ones(monkeypatch):
    rnd = random.Random(3)
    monkeypatch.setattr(decontaminate, "CELLS", 60)
    pairs = [tuple(np.array([rnd.randrange(5) for _ in range(rnd.randrange(14))], np.uint64) for _ in "ab") for _ in range(300)]
    assert decontaminate.align_all(pairs).tolist() == [decontaminate.align(*p) for p in pairs]


def corpus():
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(900)]
    some = lambda n: [rnd.choice(words) for _ in range(n)]
    items = [(k, " ".join(some(n))) for k, n in enumerate((30, 45, 20, 60, 12, 33, 3, 2, 1, 0))] + [(10, None)]
    rows, leaked = [], set()
    for i in range(300):
        k = rnd.randrange(6)
        own = items[k][1].split()
        kind = i % 6
        if kind == 0:
            rows.append((i, " ".join([*some(40), *own, *some(40)])))
        elif kind == 1:  # every eighth word changed, one left out
            edited = [w if j % 8 else "other" for j, w in enumerate(own)]
            del edited[len(edited) // 2]
            rows.append((i, ", ".join([*some(10), *edited, *some(90)]).upper()))
        elif kind == 2:  # a short stretch only
            rows.append((i, " ".join([*some(30), *own[: len(own) // 4], *some(30)])))
        else:
            rows.append((i, " ".join(some(rnd.randrange(200)))))
        if kind < 2:
            leaked.add((i, k))
    return rows, items, leaked


def test_planted_items_are_found(spark, make_docs):
    rows, items, leaked = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(make_docs(rows, extra=True), bench).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["item_id"]) for r in got if r["contaminated"]} == leaked
    left = decontaminate.drop_contaminated(make_docs(rows), bench)
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in rows} - {i for i, _ in leaked}


def test_a_passage_in_most_documents_is_still_found(spark, make_docs):
    _, items, _ = corpus()
    rows = [(i, f"start {i} " + items[1][1] + f" end {i}") for i in range(200)] + [(i, f"clean {i} text") for i in range(200, 260)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(make_docs(rows), bench).collect()
    assert {r["doc_id"] for r in got if r["contaminated"]} == set(range(200))


def test_one_edited_copy_in_many_documents(spark, make_docs):
    items = [(k, " ".join(f"i{k}w{j}" for j in range(40))) for k in range(3)]
    edited = [" ".join(w if j % 5 else f"new{j}" for j, w in enumerate(t.split())) for _, t in items]
    rows = [(i, f"start {i} {edited[0]} end {i}") for i in range(5)] + [(i, f"start {i} {edited[1]} end {i}") for i in range(5, 1005)]
    rows += [(i, f"start {i} {edited[2]} end {i}") for i in range(1005, 1105)] + [(1105, items[2][1])]  # and one whole copy
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(make_docs([*rows, (2000, "clean")]), bench).collect()
    want = {(i, 0 if i < 5 else 1 if i < 1005 else 2) for i, _ in rows}
    assert {(r["doc_id"], r["item_id"]) for r in got if r["contaminated"]} == want


def test_equals_brute_force_over_all_pairs(spark, make_docs):
    """Copies with words replaced, left out and added at random, up to the threshold and beyond it; every pair aligned."""
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]  # few words: seeds recur by chance
    some = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(some(rnd.randrange(8, 50)))) for k in range(12)]
    rows = []
    for i in range(150):
        own, rate = rnd.choice(items)[1].split(), rnd.choice((0, 0.1, 0.2, 0.3))
        edited = []
        for w in own:
            kind = rnd.random()
            edited += [w] if kind >= rate else [] if kind < rate / 3 else ["new"] if kind < 2 * rate / 3 else [w, "more"]
        rows.append((i, " ".join([*some(rnd.randrange(60)), *(edited if i % 3 else []), *some(rnd.randrange(60))])))
    want = {}
    for i, text in rows:
        shares = {k: brute(t.split(), text.split()) / len(t.split()) for k, t in items}
        if max(shares.values()) >= 0.5:
            want[i] = (min(k for k, x in shares.items() if x == max(shares.values())), max(shares.values()))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(make_docs(rows), bench).collect()
    assert {r["doc_id"]: (r["item_id"], r["score"]) for r in got if r["contaminated"]} == want and len(want) > 50


def test_needed_seeds_stay_in_every_copy():
    """Replaced and left-out words at random and at the worst places."""
    rnd = random.Random(6)
    for n in range(3, 70):
        item = list(range(n))
        for _ in range(30):
            e = rnd.randrange(n // 4 + 1)
            at = set(rnd.sample(item, e)) if rnd.random() < 0.5 else set(range(2, n, 3)[:e])
            gone = rnd.random() < 0.5
            copy = [w if w not in at else -1 for w in item if not (gone and w in at)]
            if brute(item, copy) < n / 2:
                continue
            seeds = {tuple(copy[i : i + 3]) for i in range(len(copy) - 2)}
            kept = sum(tuple(item[i : i + 3]) in seeds for i in range(n - 2))
            assert kept >= decontaminate.needed(n, 0.5) or n < 13  # shorter items need one seed, worst places may leave none


def test_common_phrases_make_no_pairs(spark, make_docs):
    """A phrase that all items and all documents hold joins nothing: rows grow with the copies, not with items x documents."""
    items = [(k, f"which one of the following holds for {' '.join(f'i{k}w{j}' for j in range(30))}") for k in range(40)]
    rows = [(i, f"doc {i} one of the following holds for it " + " ".join(f"d{i}w{j}" for j in range(50))) for i in range(200)]
    rows += [(1000 + k, f"see {items[k][1]} end") for k in range(5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.leaks(make_docs(rows), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["score"]) for r in found) == [(1000 + k, k, 1.0) for k in range(5)]


def test_scripts_without_spaces(spark, make_docs):
    item = "\u4eca\u65e5\u306f\u3068\u3066\u3082\u826f\u3044\u5929\u6c17\u3067\u3059\u306d\u3068\u5f7c\u304c\u8a00\u3063\u305f"
    rows = [(1, "\u3042" * 30 + item + "\u3044" * 30), (2, "\u3042\u3044\u3046" * 20), (3, item[::-1]), (4, item[:8] + "\u5929" + item[9:])]
    bench = spark.createDataFrame([(7, item), (8, item)], "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["item_id"]) for r in decontaminate.contaminated(make_docs(rows), bench).collect()}
    assert got[1] == got[4] == (True, 7) and not got[2][0] and not got[3][0]


def test_odd_rows(spark, make_docs):
    _, items, _ = corpus()
    rows = [(1, None), (2, ""), (None, items[0][1]), (3, items[0][1]), (3, items[0][1]), (3, "clean"), (4, (items[2][1] + " ") * 300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(make_docs(rows), bench).collect()
    assert sorted((str(r["doc_id"]), r["contaminated"]) for r in got) == sorted(
        [("1", False), ("2", False), ("None", True), ("3", True), ("3", True), ("3", False), ("4", True)]
    )
    none = bench.limit(0)
    assert not any(r["contaminated"] for r in decontaminate.contaminated(make_docs(rows), none).collect())
    assert decontaminate.contaminated(make_docs([]), bench).count() == 0
