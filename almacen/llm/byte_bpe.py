"""Byte-level BPE: overlapping chunks, stitched where their pre-token boundaries meet.

A long text is cut into overlapping chunks that are pre-tokenised in parallel.
The pattern looks ahead but never back, so once two chunks share a boundary they
share all later ones: the first common boundary in an overlap is a true one. The
text is cut there into pieces, each a whole number of pre-tokens, which are
encoded in parallel and put together by number. Where an overlap has no common
boundary the two chunks stay one piece. Decoding joins the tokens' bytes.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.llm.common import id_text, prepare

CHUNK_CHARS, OVERLAP_CHARS = 32_768, 512
CACHE_PIECES = 400_000  # pre-tokens whose ids a Python worker remembers

_vocabularies: dict[str, tuple[dict[bytes, int], list[bytes]]] = {}
_pieces: dict[tuple[str, str], dict[str, bytes]] = {}


def vocabulary(path: str) -> tuple[dict[bytes, int], list[bytes]]:
    """(rank of each token's bytes, bytes of each id) of a rank file."""
    if path not in _vocabularies:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        tokens = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            tokens[i] = t
        _vocabularies[path] = ranks, tokens
    return _vocabularies[path]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged first, the leftmost among equals.

    A heap of pairs over a linked list, so a pre-token of n bytes takes n log n steps.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that starts here
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (mid := end[i]) >= n or end[mid] != stop:
            continue
        alive[mid], end[i] = False, stop
        if stop < n:
            prev[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def boundaries(text: str, pattern: regex.Pattern, last: bool) -> list[int]:
    """Starts of the matches of ``pattern``; unless ``last``, those whose match may change with what follows are left out."""
    spans = [m.span() for m in pattern.finditer(text)]
    starts = [a for a, _ in spans]
    if not last and spans and spans[-1][1] == len(text):
        starts.pop()
    return starts


def encode_pieces(texts: list[str], path: str, pattern: str) -> list[bytes]:
    """Ids of every text, as little-endian unsigned 32-bit integers."""
    ranks, _ = vocabulary(path)
    find = regex.compile(pattern).findall
    known = _pieces.setdefault((path, pattern), {})
    if len(known) > CACHE_PIECES:
        known.clear()
    out = []
    for t in texts:
        parts = find(t)
        for w in set(parts).difference(known):
            known[w] = np.array(merge(w.encode(), ranks), dtype="<u4").tobytes()
        out.append(b"".join(map(known.__getitem__, parts)))
    return out


def encode(
    docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text); ids little-endian unsigned 32-bit, as binary.

    ``ranks`` is the path of a rank file that every executor has; ``pattern`` must
    not look behind and must match every character. Texts of up to ``chunk``
    characters are one piece. Null texts are empty and have no ids. Repeated rows
    give repeated rows; other columns are not read. No rows, no rows.
    """
    prepare(docs.sparkSession)
    src = id_text(docs)

    def marks(batches):
        compiled = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for row in batch.select(["k", "n", "part"]).to_pylist():
                at = row["k"] * chunk
                own = np.array(boundaries(row["part"], compiled, row["k"] + 1 == row["n"]), dtype=np.int64)
                heads.append((own[own < overlap] + at).tolist())
                tails.append((own[own >= chunk] + at).tolist())
            kind = pa.list_(pa.int64())
            cols = [batch.column("key"), batch.column("k"), pa.array(heads, kind), pa.array(tails, kind)]
            yield pa.record_batch(cols, names=["key", "k", "head", "tail"])

    def pieces(batches):
        for batch in batches:
            ids = encode_pieces(batch.column("text").to_pylist(), ranks, pattern)
            rest = [c for c in batch.schema.names if c != "text"]
            yield pa.record_batch([*(batch.column(c) for c in rest), pa.array(ids, pa.binary())], names=[*rest, "ids"])

    short = src.where(F.char_length("text") <= chunk).mapInArrow(pieces, "doc_id long, ids binary")

    long = src.where(F.char_length("text") > chunk).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
    long = long.withColumn("key", F.sha2(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"), 256))
    n = F.ceil(F.char_length("text") / F.lit(chunk)).cast("long")
    parts = long.select("key", n.alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("k"), "text")
    parts = parts.select("key", "n", "k", F.expr(f"substring(text, int(k * {chunk} + 1), {chunk + overlap})").alias("part"))
    marked = parts.repartition("key", "k").mapInArrow(marks, "key string, k long, head array<long>, tail array<long>")
    # the first boundary that a chunk shares with the next one; a document's chunks only meet as positions
    met = F.array_min(F.array_intersect("tail", F.lead("head").over(Window.partitionBy("key").orderBy("k"))))
    cuts = marked.select("key", met.alias("cut")).groupBy("key").agg(F.sort_array(F.collect_set("cut")).alias("cuts"))
    whole = long.join(cuts, "key", "left").withColumn(
        "cuts", F.concat(F.array(F.lit(0).cast("long")), F.coalesce("cuts", F.array().cast("array<long>")),
                         F.array(F.char_length("text").cast("long")))
    )
    pieced = whole.select("key", "doc_id", "copies", "text", "cuts", F.explode(F.sequence(F.lit(0), F.size("cuts") - 2)).alias("piece"))
    pieced = pieced.select(
        "key", "doc_id", "copies", "piece",
        F.expr("substring(text, int(cuts[piece] + 1), int(cuts[piece + 1] - cuts[piece]))").alias("text"),
    )
    encoded = pieced.repartition("key", "piece").mapInArrow(
        pieces, "key string, doc_id long, copies long, piece int, ids binary"
    )
    joined = encoded.groupBy("key", "doc_id", "copies").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("p"))
    joined = joined.select(
        "doc_id", "copies", F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids")
    )
    rows = joined.select("doc_id", "ids", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc_id", "ids")
    return short.unionByName(rows)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``, the joined bytes of the ids' tokens."""

    def texts(batches):
        _, tokens = vocabulary(ranks)
        for batch in batches:
            out = [
                b"".join(map(tokens.__getitem__, np.frombuffer(x, dtype="<u4").tolist()))
                for x in batch.column("ids").to_pylist()
            ]
            yield pa.record_batch([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, ids binary, decoded binary")
