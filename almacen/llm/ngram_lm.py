"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, kept as sorted hash arrays.

Texts become blocks of at most about ``BLOCK`` tokens, each a file of word hashes and
of the tokens as places among them. Within a block every n-gram is counted once; its
64-bit hash goes, with its count, to the shard of the model that covers that range of hashes.
A shard adds up what the blocks send and writes an Arrow file, a sorted array of hashes
with columns of counts. Nothing is pruned, so the model grows with its corpus, and a shard
holds as much as a block, if the shuffle partitions grow with the input.

Levels are built from the longest n-grams down. A shard tells each block that asked how
often its n-grams occur and for which of them it is the first block; the first block counts the
n-gram once for its suffix (continuation counts) and for its context (sum, and
how many n-grams occur once, twice and more often). So no context, however common, is ever gathered.

Scoring asks the other way round: the distinct hashes of a block go to the shards, where
a worker maps the file and searches the sorted array; the counts go back, and the
block works out the probabilities. A hot n-gram is one hash in each block. A block that the model was
counted from has been told the counts of its own longest n-grams already and asks only for those
of texts that are held out.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almacen.llm.common import materialize, prepare, scratch_path, shuffle_partitions
from almacen.llm.textkit import blocks, mix, word_hashes

ORDER = 2
BLOCK = 1 << 21  # tokens
SECTION = 1 << 20  # bytes of a text that are hashed at once; words are never cut
SMOOTH = 0.1  # of the unigram base score
FALLBACK = (0.5, 1.0, 1.5)  # discounts where too few n-grams occur once to four times to estimate them
START, END = np.uint64(0x5354415254000001), np.uint64(0x454E440000000001)
_STEP = np.uint64(0xD1342543DE82EF95)
_SPACES = b" \t\n\v\f\r"

MESSAGE = "level int, shard int, block long, hashes binary, cols array<binary>"
MERGED = MESSAGE.replace("hashes binary", "path string") + ", stats array<long>"
STATS = 8  # n-grams seen once, twice, three and four times, at all, sum of counts, tokens, words


# files and columns


def open_folder(folder: str):
    """(file system, path) of a folder given as URI or path."""
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"
    return pafs.FileSystem.from_uri(uri)


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray], codec: str | None = None) -> str:
    """One Arrow file below ``folder``; a task that is run again writes under another name."""
    fs, base = open_folder(folder)
    fs.create_dir(base, recursive=True)
    path = f"{base}/{name}-{uuid.uuid4().hex}.arrow"
    batch = pa.record_batch([pa.array(a) for a in arrays.values()], names=list(arrays))
    with fs.open_output_stream(path) as out, pa.ipc.new_file(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as w:
        w.write_batch(batch)
    return path


def read_arrays(folder: str, path: str) -> dict[str, np.ndarray]:
    """The arrays of a file: views of a memory map where the folder is mounted, read otherwise."""
    fs, _ = open_folder(folder)
    source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
    batch = pa.ipc.open_file(source).get_batch(0)
    return {n: batch.column(n).to_numpy() for n in batch.schema.names}


def pack_sorted(h: np.ndarray) -> bytes:
    """Differences of ascending hashes, byte by byte: the high bytes are zero and compress."""
    return np.diff(h, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def pack_counts(x: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest type that holds them, its width in front."""
    top = int(x.max()) if len(x) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _narrow(x: np.ndarray) -> np.ndarray:
    return np.frombuffer(memoryview(data := pack_counts(x))[1:], f"<u{data[0]}")


def lookup(arrays: dict[str, np.ndarray], hashes: np.ndarray) -> list[np.ndarray]:
    """Columns (int64) of a shard for ascending ``hashes``, zeros where it has none."""
    held = arrays["hash"]
    at = np.searchsorted(held, hashes)
    hit = np.flatnonzero(at < len(held))
    hit = hit[held[at[hit]] == hashes[hit]]
    out = []
    for name, col in arrays.items():
        if name != "hash":
            x = np.zeros(len(hashes), dtype=np.int64)
            x[hit] = col[at[hit]]
            out.append(x)
    return out


# texts to blocks


def _sections(text: bytes) -> Iterator[bytes]:
    """Parts of ``text`` of about ``SECTION`` bytes that end before white space."""
    at = 0
    while at < len(text):
        stop = at + SECTION
        while stop < len(text) and text[stop] not in _SPACES:
            stop += 1
        yield text[at:stop]
        at = stop


class _Block:
    """Pieces of texts, each after the ``order`` - 1 tokens before it."""

    def __init__(self, order: int):
        self.order, self.tokens, self.pieces, self.size = order, [], [], 0

    def add(self, tokens: np.ndarray, pieces: list[tuple]) -> None:
        self.tokens.append(tokens)
        self.pieces += pieces
        self.size += len(tokens)

    def write(self, folder: str, name: str) -> str:
        h = np.concatenate(self.tokens)
        words, places, n = np.unique(h, return_inverse=True, return_counts=True)
        common = np.argsort(-n, kind="stable")  # small numbers for common words compress
        rank = np.empty(len(words), dtype=np.uint32)
        rank[common] = np.arange(len(words), dtype=np.uint32)
        row, doc, train, size = zip(*self.pieces, strict=True)
        parts = {
            "words": words[common],
            "tokens": rank[places],
            "sizes": np.array(size, dtype=np.int64),
            "rows": np.array(row, dtype=np.int64),
            "docs": np.array([d or 0 for d in doc], dtype=np.int64),
            "named": np.array([d is not None for d in doc], dtype=np.uint8),
            "train": np.array(train, dtype=np.uint8),
        }
        cols = pa.record_batch([pa.array([a.tobytes()], pa.binary()) for a in parts.values()], names=list(parts))
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        path = f"{base}/{name}-{uuid.uuid4().hex}.arrow"
        with fs.open_output_stream(path) as out:
            with pa.ipc.new_file(out, cols.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(cols)
        return path


_TYPES = {"words": "<u8", "tokens": "<u4", "sizes": "<i8", "rows": "<i8", "docs": "<i8", "named": "u1", "train": "u1"}


def read_block(folder: str, path: str) -> dict[str, np.ndarray]:
    fs, _ = open_folder(folder)
    with fs.open_input_file(path) as f:
        batch = pa.ipc.open_file(f).get_batch(0)
        return {n: np.frombuffer(batch.column(n)[0].as_py(), t) for n, t in _TYPES.items()}


def _with_leads(words: np.ndarray, first: np.ndarray, order: int) -> np.ndarray:
    """Words of whole texts (``first``: where each begins) with starts before and an end after each."""
    n = np.diff(first)
    out = np.full(len(words) + len(n) * order, START, dtype=np.uint64)
    shift = np.repeat(np.arange(len(n)) * order + order - 1, n)
    out[np.arange(len(words)) + shift] = words
    out[first[1:] + np.arange(1, len(n) + 1) * order - 1] = END
    return out


def _write_blocks(order: int, limit: int, folder: str):
    def run(batches):
        block, done, part = _Block(order), 0, TaskContext.get().partitionId()

        def flush():
            nonlocal block, done
            path = block.write(folder, f"block-{part:06d}")
            out = pa.record_batch([pa.array([part << 33 | done]), pa.array([path])], names=["block", "path"])
            block, done = _Block(order), done + 1
            return out

        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            about = list(zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "train")), strict=True))
            for lo, hi in blocks(texts):
                if hi == lo + 1 and len(texts[lo]) > SECTION:
                    before = np.full(order - 1, START, dtype=np.uint64)
                    for section in _sections(texts[lo]):
                        words = word_hashes([section], lower=True)[0]
                        block.add(np.concatenate([before, words]), [(*about[lo], len(words))])
                        before = np.concatenate([before, words])[len(words) :]
                        if block.size >= limit:
                            yield flush()
                    block.add(np.concatenate([before, [END]]), [(*about[lo], 1)])
                else:
                    words, first, *_ = word_hashes(texts[lo:hi], lower=True)
                    sizes = (np.diff(first) + 1).tolist()
                    block.add(_with_leads(words, first, order), [(*a, n) for a, n in zip(about[lo:hi], sizes, strict=True)])
                if block.size >= limit:
                    yield flush()
        if block.pieces:
            yield flush()

    return run


@dataclass(frozen=True)
class Corpus:
    """Blocks of texts: a manifest (block, path) of files in ``folder``."""

    blocks: DataFrame
    folder: str
    order: int

    def spread(self) -> DataFrame:
        """The manifest dealt out: its rows are few and small, the work behind each is not."""
        return self.blocks.repartition(shuffle_partitions(self.blocks.sparkSession), "block")


def read_corpus(docs: DataFrame, train: Column | None = None, order: int = ORDER, limit: int = BLOCK) -> Corpus:
    """The blocks of ``docs`` (doc_id, text), written to the shared folder.

    A-Z in lower case; tokens are runs of characters other than space, tab and the line breaks \\n \\v \\f \\r,
    then one end. Null texts are empty. ``train`` (default: all) marks the rows that a model learns
    from; null counts as true. Long texts are hashed in sections and may lie in several blocks. Other columns are not
    read.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    prepare(docs.sparkSession)
    folder = scratch_path(docs.sparkSession, "ngram-blocks")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.lit(True) if train is None else train, F.lit(True)).alias("train"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return Corpus(materialize(rows.mapInArrow(_write_blocks(order, limit, folder), "block long, path string"), "blocks"), folder, order)


# n-grams of a block


@dataclass
class _Level:
    """Distinct n-grams of a block: their hashes and where their contexts and suffixes are a level below."""

    hash: np.ndarray
    at: np.ndarray  # for each token: which n-gram ends there; -1 if its first words are not in the piece
    context: np.ndarray | None = None
    suffix: np.ndarray | None = None


class _Grams:
    def __init__(self, block: dict[str, np.ndarray], order: int):
        self.order, lengths = order, block["sizes"] + order - 1
        self.piece = np.repeat(np.arange(len(lengths)), lengths)
        offset = np.arange(len(self.piece)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.content = offset >= order - 1
        words, tokens = block["words"], block["tokens"].astype(np.int64)
        self.train = self.content & (block["train"][self.piece] > 0)
        self.start = int(np.flatnonzero(words == START)[0]) if (words == START).any() else -1
        self.levels = [_Level(words, tokens)]
        self.begins = [np.arange(len(words)) == self.start]  # does the n-gram begin with a start?
        for n in range(2, order + 1):
            below, valid = self.levels[-1], np.flatnonzero(offset >= n - 1)
            key = below.at[valid - 1] * len(words) + tokens[valid]
            distinct, first, inverse = np.unique(key, return_index=True, return_inverse=True)
            at = np.full(len(tokens), -1, dtype=np.int64)
            at[valid] = inverse
            context, last = np.divmod(distinct, len(words))
            with np.errstate(over="ignore"):
                h = mix(below.hash[context] * _STEP + words[last] + np.uint64(n))
            self.levels.append(_Level(h, at, context, below.at[valid[first]]))
            self.begins.append(self.begins[-1][context])

    def learnt(self) -> np.ndarray:
        """How often each of the longest n-grams occurs in training texts."""
        return np.bincount(self.levels[-1].at[self.train], minlength=len(self.levels[-1].hash))


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each hash: equal ranges, ascending with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _messages(level: int, block: int, h: np.ndarray, cols: list[np.ndarray], shards: int, select: np.ndarray | None = None):
    """Rows of ``MESSAGE``: hashes (those of ``select``) by shard, ascending, with columns in the same order."""
    order = np.argsort(h) if select is None else select[np.argsort(h[select])]
    h, cols = h[order], [c[order] for c in cols]
    cut = np.searchsorted(shard_of(h, shards), np.arange(shards + 1))
    own = np.flatnonzero(np.diff(cut))
    pairs = list(zip(cut[own].tolist(), cut[own + 1].tolist(), strict=True))
    return pa.record_batch(
        [
            pa.array(np.full(len(own), level, dtype=np.int32)),
            pa.array(own.astype(np.int32)),
            pa.array(np.full(len(own), block, dtype=np.int64)),
            pa.array([pack_sorted(h[a:b]) for a, b in pairs], pa.binary()),
            pa.array([[pack_counts(c[a:b]) for c in cols] for a, b in pairs], pa.list_(pa.binary())),
        ],
        names=["level", "shard", "block", "hashes", "cols"],
    )


def _answers(table: pa.Table, level: int, h: np.ndarray, n_cols: int, select: np.ndarray | None = None) -> list[np.ndarray]:
    """Columns for the hashes of a block from the shards' answers; zeros outside ``select``."""
    rows = table.filter(pc.equal(table.column("level"), level)).sort_by("shard").column("cols").to_pylist()
    order = np.argsort(h) if select is None else select[np.argsort(h[select])]
    out = []
    for i in range(n_cols):
        x = np.zeros(len(h), dtype=np.int64)
        if rows:
            x[order] = np.concatenate([unpack_counts(r[i]) for r in rows])
        out.append(x)
    return out


# counting


def _count(corpus: Corpus, shards: int):
    """Counts of the longest n-grams of the training texts."""

    def run(batches):
        for batch in batches:
            for block, path in zip(batch.column("block").to_pylist(), batch.column("path").to_pylist(), strict=True):
                g = _Grams(read_block(folder, path), order)
                n = g.learnt()
                yield _messages(order, block, g.levels[-1].hash, [n], shards, np.flatnonzero(n))

    folder, order = corpus.folder, corpus.order
    return run


def _merge(level: int, folder: str):
    """Shard: sums of the blocks' columns, written as sorted arrays; each block is told the first sum, twice, plus whether it is first."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        sent = [unpack_sorted(x) for x in table.column("hashes").to_pylist()]
        held = list(zip(*table.column("cols").to_pylist(), strict=True))
        h, first, inverse = np.unique(np.concatenate(sent), return_index=True, return_inverse=True)
        sums = []
        for col in held:
            x = np.zeros(len(h), dtype=np.int64)
            np.add.at(x, inverse, np.concatenate([unpack_counts(c) for c in col]))
            sums.append(x)
        k = sums[0]
        keep = np.flatnonzero(np.any(sums, axis=0))
        shard = table.column("shard")[0].as_py()
        arrays = {"hash": h[keep]} | {f"c{i}": _narrow(x[keep]) for i, x in enumerate(sums)}
        path = write_arrays(folder, f"level-{level}-shard-{shard:06d}", arrays)
        tokens = sums[-1] if len(sums) > 1 else np.zeros(1, np.int64)
        stats = [int((k == i).sum()) for i in (1, 2, 3, 4)] + [int((k > 0).sum()), int(k.sum()), int(tokens.sum()), int((tokens > 0).sum())]
        told, ends = [], np.cumsum([len(x) for x in sent])
        for a, b in zip((ends - [len(x) for x in sent]).tolist(), ends.tolist(), strict=True):
            mine = inverse[a:b]
            told.append([pack_counts(2 * k[mine] + ((first[mine] >= a) & (first[mine] < b)))])
        n = len(told)
        return pa.table(
            {
                "level": pa.array([level] * (n + 1), pa.int32()),
                "shard": pa.array([shard] * (n + 1), pa.int32()),
                "block": pa.concat_arrays([*table.column("block").chunks, pa.array([None], pa.int64())]),
                "path": pa.array([None] * n + [path], pa.string()),
                "cols": pa.array([*told, None], pa.list_(pa.binary())),
                "stats": pa.array([None] * n + [stats], pa.list_(pa.int64())),
            }
        )

    return run


def _contributions(level: int, corpus: Corpus, shards: int):
    """What a block adds to the n-grams one ``level`` down from those its shards have just counted."""

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        number, path = block.column("block")[0].as_py(), block.column("path")[0].as_py()
        g = _Grams(read_block(folder, path), order)
        above, below = g.levels[level], g.levels[level - 1]
        select = np.flatnonzero(g.learnt()) if level + 1 == order else None  # only those of training texts were sent
        (answer,) = _answers(told, level + 1, above.hash, 1, select)
        k = answer // 2
        own = np.flatnonzero((answer % 2 == 1) & (k > 0))
        n, k = len(below.hash), k[own]

        def add(place: np.ndarray, what: np.ndarray) -> np.ndarray:
            out = np.zeros(n, dtype=np.int64)
            np.add.at(out, place, what)
            return out

        suffix, context = above.suffix[own], above.context[own]
        cols = [
            add(suffix, np.where(g.begins[level - 1][suffix], k, 1)),  # what begins with a start has no words before it
            add(context, k),
            add(context, (k == 1).astype(np.int64)),
            add(context, (k == 2).astype(np.int64)),
            add(context, (k > 2).astype(np.int64)),
            np.bincount(below.at[g.train], minlength=n) if level == 1 else np.zeros(n, np.int64),
        ]
        return pa.Table.from_batches([_messages(level, number, below.hash, cols, shards)])

    folder, order = corpus.folder, corpus.order
    return run


@dataclass(frozen=True)
class Model:
    """Files (level, shard, path) of sorted hash arrays in ``folder`` and the numbers that hold for all of them."""

    files: DataFrame
    folder: str
    order: int
    shards: int
    discounts: tuple  # (D1, D2, D3) of each level, the lowest first
    seen: tuple  # unigrams with continuation counts 1, 2 and more, and the sum of these counts
    tokens: int  # N
    words: int  # V
    source: str  # folder of the corpus it was counted from
    told: DataFrame | None  # what its shards told the blocks of that corpus about their longest n-grams


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many n-grams occur once to four times."""
    if n1 and n2 and n3:
        y = n1 / (n1 + 2 * n2)
        d = tuple((i + 1) - (i + 2) * y * b / a for i, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4))))
        if all(0 < x <= i + 1 for i, x in enumerate(d)):
            return d
    return FALLBACK


def fit(corpus: Corpus) -> Model:
    """The model of the training texts of ``corpus``, written to the shared folder. Nothing is pruned."""
    spark = corpus.blocks.sparkSession
    shards, folder, order = shuffle_partitions(spark), scratch_path(spark, "ngram-model"), corpus.order
    sent, files, per_level, longest = corpus.spread().mapInArrow(_count(corpus, shards), MESSAGE), None, [], None
    for level in range(order, 0, -1):
        merged = materialize(sent.groupBy("shard").applyInArrow(_merge(level, folder), MERGED), f"level{level}")
        own = merged.where("path IS NOT NULL").select("level", "shard", "path")
        files = own if files is None else files.unionByName(own)
        sums = merged.where("path IS NOT NULL").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(STATS)]).first()
        per_level.append([int(x or 0) for x in sums])
        told = merged.where("block IS NOT NULL").select("level", "shard", "block", "cols")
        longest = told if level == order else longest
        if level > 1:
            sent = corpus.blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_contributions(level - 1, corpus, shards), MESSAGE)
    per_level.reverse()
    n1, n2, _, _, seen, total, tokens, words = per_level[0]
    cut = tuple(discounts(*s[:4]) for s in per_level)
    return Model(files, folder, order, shards, cut, (n1, n2, seen - n1 - n2, total), tokens, words, corpus.folder, longest)


# scoring


def _ask(corpus: Corpus, shards: int, told: bool):
    def run(batches):
        for batch in batches:
            for block, path in zip(batch.column("block").to_pylist(), batch.column("path").to_pylist(), strict=True):
                g = _Grams(read_block(folder, path), order)
                for n, level in enumerate(g.levels, 1):
                    select = np.flatnonzero(g.learnt() == 0) if told and n == order else None
                    yield _messages(n, block, level.hash, [], shards, select)

    folder, order = corpus.folder, corpus.order
    return run


def _answer(folder: str):
    """Shard: maps its file and looks up what each block asks for."""

    def run(asked: pa.Table, file: pa.Table) -> pa.Table:
        arrays = read_arrays(folder, file.column("path")[0].as_py()) if len(file) else None
        hashes = asked.column("hashes").to_pylist()
        cols = []
        for x in hashes:
            h = unpack_sorted(x)
            found = lookup(arrays, h) if arrays is not None else [np.zeros(len(h), dtype=np.int64)] * 6
            cols.append([pack_counts(c) for c in found])
        return pa.table([asked.column("level"), asked.column("shard"), asked.column("block"), pa.array(cols, pa.list_(pa.binary()))],
                        names=["level", "shard", "block", "cols"])

    return run


def _block_scores(corpus: Corpus, model: tuple, known_before: bool):
    def counts(g: _Grams, told: pa.Table, n: int) -> list[np.ndarray]:
        h = g.levels[n - 1].hash
        if n < order or not known_before:
            return _answers(told, n, h, 6 if n < order else 1)
        learnt = g.learnt()
        (own,) = _answers(told, -order, h, 1, np.flatnonzero(learnt))
        (asked,) = _answers(told, order, h, 1, np.flatnonzero(learnt == 0))
        return [own // 2 + asked]

    def run(block: pa.Table, told: pa.Table) -> pa.Table:
        data = read_block(folder, block.column("path")[0].as_py())
        g = _Grams(data, order)
        p, known = None, None
        for n, level in enumerate(g.levels, 1):
            d1, d2, d3 = discount[n - 1]
            cols = counts(g, told, n)
            k = cols[0]
            mass = np.maximum(k - np.select([k == 0, k == 1, k == 2], [0, d1, d2], d3), 0)
            if n == 1:
                n1, n2, n3, total = seen
                p = np.full(len(k), 1 / (words + 1))
                if total:
                    p = (mass + (d1 * n1 + d2 * n2 + d3 * n3) * p) / total
                known = cols[5]
            else:
                total, rest = (x[level.context] for x in (contexts[1], d1 * contexts[2] + d2 * contexts[3] + d3 * contexts[4]))
                lower = p[level.suffix]
                p = np.where(total > 0, (mass + rest * lower) / np.maximum(total, 1), lower)
            contexts = cols
        here, piece = g.content, g.piece[g.content]
        word, gram = g.levels[0].at[here], g.levels[-1].at[here]
        base = np.log10((known + SMOOTH) / (tokens + SMOOTH * (words + 1)))
        count = len(data["sizes"])
        named = data["named"] > 0
        return pa.table(
            {
                "row": pa.array(data["rows"]),
                "doc_id": pa.array(data["docs"], mask=~named),
                "n_tokens": pa.array(data["sizes"]),
                "n_known": pa.array(np.bincount(piece, weights=known[word] > 0, minlength=count).astype(np.int64)),
                "base_score": pa.array(np.bincount(piece, weights=base[word], minlength=count)),
                "score": pa.array(np.bincount(piece, weights=np.log10(p)[gram], minlength=count)),
            }
        )

    folder, order = corpus.folder, corpus.order
    discount, seen, tokens, words = model
    return run


def score(corpus: Corpus, model: Model) -> DataFrame:
    """One row per text: doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    score is the model's log10 probability of the text's tokens, end included, each
    given the ``order`` - 1 before it (starts before the first). Unknown words share the mass of one
    word. base_score sums log10((c + 0.1) / (N + 0.1 * (V + 1))) over the tokens, n_known counts those with c > 0.
    An empty or null text is one end. Rows that repeat an id are texts of their own; null ids stay null. A model of no
    texts gives every token the probability 1 / (V + 1) = 1. No rows, no rows.
    """
    known = model.source == corpus.folder
    asked = corpus.spread().mapInArrow(_ask(corpus, model.shards, known), MESSAGE).select("level", "shard", "block", "hashes")
    files = model.files.groupBy("level", "shard")
    told = asked.groupBy("level", "shard").cogroup(files).applyInArrow(_answer(model.folder), "level int, shard int, block long, cols array<binary>")
    numbers = (model.discounts, model.seen, model.tokens, model.words)
    told = materialize(told, "answers")
    if known:
        told = told.unionByName(model.told.withColumn("level", F.lit(-model.order)))
    parts = corpus.blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _block_scores(corpus, numbers, known), "row long, doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    rows = parts.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *sums)
    return rows.select(
        "doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
