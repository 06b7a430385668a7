import hashlib
from collections import Counter, defaultdict

from almacen.llm import exact_dedup

BIG = "".join(f"line {i * i * 7919 % 999983} of a long text\n" for i in range(3000))
ROWS = [
    (1, "a"), (5, "a"), (3, "a"), (2, ""), (4, None), (6, BIG), (7, BIG + "x"), (8, BIG), (9, "A"), (10, "a "),
    (None, "n"), (None, "n"), (11, "r"), (11, "r"), (12, "é"), (13, "é"), (14, "same id"), (14, "other text"),
]


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return Counter(out)


def test_groups(make_docs):
    got = exact_dedup.exact_groups(make_docs(ROWS, extra=True)).collect()
    assert Counter(map(tuple, got)) == brute(ROWS)


def test_ambiguous_identifiers_are_compared_by_text(make_docs, monkeypatch):
    # identifiers of two bits collide all the time; results must not change
    source = make_docs(ROWS)
    bad = exact_dedup.ambiguous_ids(source)
    assert bad.count() == 0
    ids = source.sparkSession.createDataFrame([(exact_dedup.chunk_id(b"a"),)], "chunk_id binary")
    made = exact_dedup._with_ties(exact_dedup.recipes(source), source, ids)
    tied = {r["doc_id"]: r["tie"] for r in made.collect() if r["tie"] is not None}
    assert tied == {1: "a", 5: "a", 3: "a"}


def test_drop_copies_and_empty(make_docs):
    left = exact_dedup.drop_copies(make_docs(ROWS))
    assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = sorted((r["doc_id"], r["text"]) for r in left.where("doc_id IS NOT NULL").collect())
    assert [i for i, _ in got] == [4, 5, 7, 8, 9, 10, 11, 12, 13, 14, 14]  # 12 and 13 look alike, their bytes differ
    assert exact_dedup.exact_groups(make_docs([])).count() == 0


def test_chunks_rejoin_and_resynchronise():
    data = BIG.encode()
    parts = exact_dedup.chunks(data)
    assert b"".join(parts) == data and max(map(len, parts)) <= exact_dedup.MAX_CHUNK
    shifted = exact_dedup.chunks(b"inserted " + data)
    assert len(set(parts) & set(shifted)) > len(parts) / 2
    assert exact_dedup.chunks(b"") == [] and exact_dedup.chunks(b"x") == [b"x"]
