"""Substring dedup by relative Lempel-Ziv parsing of word sequences.

The reference is made of blocks of ``BLOCK`` consecutive words, one from every
word on, each indexed at its earliest place in the corpus. A document is parsed
greedily from left to right: where the block at a word is indexed at an earlier place, a
factor starts that copies from there, and it grows word by word while the next block is
indexed at the next word of that source. At a factor's boundary the block that straddles it is looked up
as well and may open the next factor, from another source; other words are literals. A factor
thus covers whole blocks, and the factors are the duplicate spans.

Texts are held in files of about ``PART`` bytes. What is compared travels as sorted arrays of
hashes, one message from each file to each shard (a range of hashes), and the shards' answers
come back in the same order; a hash that is very frequent is one entry a file.

* The index would hold a block for each word of the corpus. It only needs those
  that can occur twice, and these are found by a sparse sample first: of each
  block, the least hash of its ``SEED``-word grams. Equal blocks have equal seeds,
  so a block whose seed no other place has is unique and is never sent. One seed
  serves about seven blocks in a row.
* Of the blocks that are left each file sends its earliest place; the shard answers with the
  earliest of all. Blocks are compared by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.llm.common import id_text, materialize, prepare, scratch_path, shuffle_partitions
from almacen.llm.ngram_lm import open_folder, pack_counts, pack_sorted, shard_of, unpack_counts, unpack_sorted
from almacen.llm.textkit import blocks, grams, sliding_argmin, word_hashes

BLOCK, SEED = 20, 8  # words
PART = 1 << 24  # bytes of text in a file
_NO_ID = -(1 << 63)  # stands for a null doc_id, which is before all others

MESSAGE = "shard int, part long, hashes binary, cols array<binary>"
ANSWER = "shard int, part long, cols array<binary>"
FACTOR = "struct<at: int, n: int, source_id: long, source_at: int>"


def _write_parts(folder: str, limit: int):
    """Texts to files; rows (part, path)."""

    def run(batches):
        held, size, done, task = [], 0, 0, TaskContext.get().partitionId()

        def flush():
            nonlocal held, size, done
            fs, base = open_folder(folder)
            fs.create_dir(base, recursive=True)
            path = f"{base}/part-{task:06d}-{uuid.uuid4().hex}.arrow"
            with fs.open_output_stream(path) as out:
                with pa.ipc.new_file(out, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    for batch in held:
                        w.write_batch(batch)
            row = pa.record_batch([pa.array([task << 33 | done]), pa.array([path])], names=["part", "path"])
            held, size, done = [], 0, done + 1
            return row

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            held.append(batch.set_column(batch.schema.get_field_index("text"), "text", texts))
            size += pc.sum(pc.binary_length(texts)).as_py() or 0
            if size >= limit:
                yield flush()
        if held:
            yield flush()

    return run


class _Part:
    """The texts of a file as word hashes; a place is the number of a word among all of the file."""

    def __init__(self, folder: str, path: str):
        fs, _ = open_folder(folder)
        with fs.open_input_file(path) as f:
            table = pa.ipc.open_file(f).read_all()
        self.doc_id = table.column("doc_id").to_pylist()
        self.doc, self.own = (table.column(c).to_numpy() for c in ("doc", "own"))
        self.texts = table.column("text").to_pylist()
        words, sizes = [], []
        for lo, hi in blocks(self.texts):
            h, first, *_ = word_hashes(self.texts[lo:hi])
            words.append(h)
            sizes.append(np.diff(first))
        self.words = np.concatenate(words) if words else np.empty(0, np.uint64)
        sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        # texts in the order of the documents, equal ones (one id, one text) at the same rank
        pairs = np.stack([self.doc, self.own], axis=1)
        self.documents, self.rank = np.unique(pairs, axis=0, return_inverse=True)
        self.rank = self.rank.reshape(-1)
        self.text_of = np.repeat(np.arange(len(sizes)), sizes)

    def seeds(self, block: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places of blocks, the seed's place of each, seeds' hashes by place)."""
        values = grams(self.words, seed)
        place = sliding_argmin(values, block - seed + 1)
        at = np.arange(len(place))
        whole = at + block <= self.first[1:][self.text_of[: len(place)]]
        return at[whole], place[whole], values


def _deal(part: int, h: np.ndarray, cols: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """Messages of ascending hashes ``h`` with columns (integers of 0 or more, or 64-bit hashes as bytes)."""
    cut = np.searchsorted(shard_of(h, shards), np.arange(shards + 1))
    own = np.flatnonzero(np.diff(cut))
    packed = [
        [c[a:b].tobytes() if c.dtype == np.uint64 else pack_counts(c[a:b]) for c in cols]
        for a, b in zip(cut[own].tolist(), cut[own + 1].tolist(), strict=True)
    ]
    return pa.record_batch(
        [
            pa.array(own.astype(np.int32)),
            pa.array(np.full(len(own), part, dtype=np.int64)),
            pa.array([pack_sorted(h[a:b]) for a, b in zip(cut[own].tolist(), cut[own + 1].tolist(), strict=True)], pa.binary()),
            pa.array(packed, pa.list_(pa.binary())),
        ],
        names=["shard", "part", "hashes", "cols"],
    )


def _answered(table: pa.Table, column: int) -> np.ndarray:
    """One column of a file's answers, in the order of its hashes."""
    rows = table.sort_by("shard").column("cols").to_pylist()
    return np.concatenate([unpack_counts(r[column]) for r in rows]) if rows else np.empty(0, np.int64)


def _reply(table: pa.Table, cols: list[np.ndarray], sizes: list[int]) -> pa.Table:
    """Columns over all messages of a shard, cut again by message."""
    ends = np.cumsum(sizes)
    told = [[pack_counts(c[b - n : b]) for c in cols] for n, b in zip(sizes, ends.tolist(), strict=True)]
    return pa.table([table.column("shard"), table.column("part"), pa.array(told, pa.list_(pa.binary()))], names=["shard", "part", "cols"])


def _distinct_seeds(p: _Part, block: int, seed: int):
    """(places of blocks, which distinct seed each has, the distinct hashes, whether a seed has two places in the file)."""
    at, place, values = p.seeds(block, seed)
    own, inverse = np.unique(place, return_inverse=True)  # a seed serves several blocks from one place
    h, which, n = np.unique(values[own], return_inverse=True, return_counts=True)
    return at, which[inverse], h, n


def _send_seeds(folder: str, block: int, seed: int, shards: int):
    def run(batches):
        for batch in batches:
            for part, path in zip(batch.column("part").to_pylist(), batch.column("path").to_pylist(), strict=True):
                _, _, h, n = _distinct_seeds(_Part(folder, path), block, seed)
                yield _deal(part, h, [np.minimum(n, 2)], shards)

    return run


def _seen_twice(table: pa.Table) -> pa.Table:
    """Shard: 1 for the hashes that the files have in two places or more, together."""
    sent = [unpack_sorted(x) for x in table.column("hashes").to_pylist()]
    n = np.concatenate([unpack_counts(c[0]) for c in table.column("cols").to_pylist()])
    h, inverse = np.unique(np.concatenate(sent), return_inverse=True)
    total = np.zeros(len(h), dtype=np.int64)
    np.add.at(total, inverse, n)
    return _reply(table, [(total[inverse] > 1).astype(np.int64)], [len(x) for x in sent])


def _candidates(p: _Part, told: pa.Table, block: int, seed: int):
    """Places of the blocks whose seed occurs twice, and their two hashes."""
    at, which, h, _ = _distinct_seeds(p, block, seed)
    twice = _answered(told, 0) > 0 if len(h) else np.empty(0, dtype=bool)
    at = at[twice[which]]
    return at, grams(p.words, block, 1)[at], grams(p.words, block, 2)[at]


def _distinct_blocks(p: _Part, at: np.ndarray, a: np.ndarray, b: np.ndarray):
    """(order of the places by hashes and then by document and word, where each distinct block begins in it)."""
    text = p.text_of[at]
    order = np.lexsort((at - p.first[text], p.rank[text], b, a))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    return order, np.flatnonzero(new)


def _send_blocks(folder: str, block: int, seed: int, shards: int):
    def run(file: pa.Table, told: pa.Table) -> pa.Table:
        p = _Part(folder, file.column("path")[0].as_py())
        at, a, b = _candidates(p, told, block, seed)
        order, new = _distinct_blocks(p, at, a, b)
        least = order[new]
        text = p.text_of[at[least]]
        cols = [b[least], p.doc[text].view(np.uint64), p.own[text].view(np.uint64), at[least] - p.first[text]]
        return pa.Table.from_batches([_deal(file.column("part")[0].as_py(), a[least], cols, shards)])

    return run


def _earliest(table: pa.Table) -> pa.Table:
    """Shard: the earliest place of each block: its doc, own (as two halves each) and word."""
    a = [unpack_sorted(x) for x in table.column("hashes").to_pylist()]
    sizes, cols = [len(x) for x in a], table.column("cols").to_pylist()
    a = np.concatenate(a)
    b, doc, own = (np.concatenate([np.frombuffer(c[i], "<u8") for c in cols]) for i in range(3))
    at = np.concatenate([unpack_counts(c[3]) for c in cols])
    order = np.lexsort((at, own.view(np.int64), doc.view(np.int64), b, a))
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    least = np.empty(len(a), dtype=np.int64)
    least[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    low = np.uint64(0xFFFFFFFF)
    halves = [(x[least] >> np.uint64(32) if k else x[least] & low).astype(np.int64) for x in (doc, own) for k in (0, 1)]
    return _reply(table, [*halves, at[least]], sizes)


def parse(starts: np.ndarray, source: np.ndarray, source_at: np.ndarray, block: int = BLOCK) -> list[tuple[int, int, int, int]]:
    """Factors (first word, words, source, the word in the source) of a document.

    ``starts`` are the ascending words at which a block begins that is indexed earlier, at word ``source_at`` of ``source``.
    Greedy: a factor starts at the first of them and takes one more word as long as the next block is the next of the
    same source; a block that straddles the end of a factor opens the next one, and the shared words belong to the
    earlier factor.
    """
    if not len(starts):
        return []
    same = (np.diff(starts) == 1) & (np.diff(source) == 0) & (np.diff(source_at) == 1)
    first = np.concatenate([[0], np.flatnonzero(~same) + 1])
    last = np.concatenate([first[1:] - 1, [len(starts) - 1]])
    out, end = [], 0
    for i, j in zip(first.tolist(), last.tolist(), strict=True):
        at, stop = max(int(starts[i]), end), int(starts[j]) + block
        out.append((at, stop - at, int(source[i]), int(source_at[i]) + at - int(starts[i])))
        end = stop
    return out


def _factors(folder: str, block: int, seed: int, with_text: bool):
    def whole(told: pa.Table, low: int) -> np.ndarray:
        lo, hi = (_answered(told, low + k).astype(np.uint64) for k in (0, 1))
        return (lo | hi << np.uint64(32)).view(np.int64)

    def run(file: pa.Table, told: pa.Table) -> pa.Table:
        p = _Part(folder, file.column("path")[0].as_py())
        is_seed = pc.equal(told.column("kind"), 0)
        at, a, b = _candidates(p, told.filter(is_seed), block, seed)
        told = told.filter(pc.invert(is_seed))
        order, new = _distinct_blocks(p, at, a, b)
        step, which = np.zeros(len(at), dtype=np.int64), np.empty(len(at), dtype=np.int64)
        step[new] = 1
        which[order] = np.cumsum(step) - 1
        doc, own, src_at = (x[which] if len(which) else x[:0] for x in (whole(told, 0), whole(told, 2), _answered(told, 4)))
        text = p.text_of[at]
        word = at - p.first[text]
        mine, its = (doc == p.doc[text]) & (own == p.own[text]), (p.doc[text], p.own[text])
        earlier = (doc < its[0]) | ((doc == its[0]) & (own < its[1])) | (mine & (src_at < word))
        keep = np.flatnonzero(earlier)
        sources, number = np.unique(np.stack([doc[keep], own[keep]], axis=1), axis=0, return_inverse=True)
        number, cut = number.reshape(-1), np.searchsorted(text[keep], np.arange(len(p.texts) + 1))
        names = [None if d == _NO_ID else int(d) for d in sources[:, 0].tolist()]
        n_words, n_removed, kept, factors = [], [], [], []
        for i, t in enumerate(p.texts):
            words, k = t.split(), keep[cut[i] : cut[i + 1]]  # bytes.split: the six ASCII white-space characters
            found = parse(word[k], number[cut[i] : cut[i + 1]], src_at[k], block)
            left, done = [], 0
            for f, n, _, _ in found:
                left += words[done:f]
                done = f + n
            left += words[done:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode() if with_text else hashlib.sha256(b" ".join(left)).hexdigest())
            factors.append([{"at": f, "n": n, "source_id": names[s], "source_at": w} for f, n, s, w in found])
        kind = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("source_id", pa.int64()), ("source_at", pa.int32())]))
        return pa.table(
            {
                "doc_id": pa.array(p.doc_id, pa.int64()),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept": pa.array(kept, pa.string()),
                "factors": pa.array(factors, kind),
            }
        )

    return run


def _documents(docs: DataFrame) -> DataFrame:
    """doc_id, doc, own, text: ``doc`` and then ``own`` order the documents and tell them apart.

    ``doc`` is the doc_id, with a value before all others for null. ``own`` is 0 for an id that one row has. Rows
    that share an id (null too) get a hash of their text, so that texts are told apart and
    rows equal in id and text are one document. The ids are counted alone, and written, so that what is
    joined to the texts is usually nothing, or small enough for Spark to broadcast.
    """
    src = id_text(docs).withColumn("doc", F.coalesce("doc_id", F.lit(_NO_ID)))
    again = src.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc", F.lit(True).alias("shared"))
    again = materialize(again, "shared-ids")
    if again.isEmpty():
        return src.select("doc_id", "doc", F.lit(0).cast("long").alias("own"), "text")
    own = F.when(F.col("shared"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    return src.join(again, "doc", "left").select("doc_id", "doc", own.alias("own"), "text")


def factor(docs: DataFrame, block: int = BLOCK, seed: int = SEED, digest: bool = False, part: int = PART) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept, factors.

    Words are runs of characters other than space, tab and the line breaks
    \\n \\v \\f \\r. Each word covered by ``block`` consecutive words that also start
    earlier (in a smaller doc_id, or in the same document before) is removed;
    blocks are judged on the whole input. kept holds the other words joined by one
    space (``digest``: the sha256 of their UTF-8 instead), factors the removed spans in words, each with the
    doc_id and the word it copies from. Null texts have no words; texts shorter than a block lose none. A null doc_id
    is smaller than any other. Rows that share a doc_id, or have none, are documents of
    their own, in the order of a hash of their texts; rows equal in id and text are one document, and a
    repeated row is treated like the first. Other columns are not read. No rows, no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    shards, folder = shuffle_partitions(spark), scratch_path(spark, "substring-parts")
    parts = materialize(_documents(docs).mapInArrow(_write_parts(folder, part), "part long, path string"), "parts")
    by_part = lambda rows: rows.repartition(shards, "part")  # noqa: E731 - few small rows, much work behind each: never coalesced
    dealt = by_part(parts)
    seeds = dealt.mapInArrow(_send_seeds(folder, block, seed, shards), MESSAGE).groupBy("shard").applyInArrow(_seen_twice, ANSWER)
    seeds = materialize(seeds, "seeds-told")
    found = dealt.groupBy("part").cogroup(by_part(seeds).groupBy("part")).applyInArrow(_send_blocks(folder, block, seed, shards), MESSAGE)
    places = materialize(found.groupBy("shard").applyInArrow(_earliest, ANSWER), "blocks-told")
    told = seeds.withColumn("kind", F.lit(0)).unionByName(places.withColumn("kind", F.lit(1)))
    return dealt.groupBy("part").cogroup(by_part(told).groupBy("part")).applyInArrow(
        _factors(folder, block, seed, not digest), f"doc_id long, n_words long, n_removed long, kept string, factors array<{FACTOR}>"
    )
