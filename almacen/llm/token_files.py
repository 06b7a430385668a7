"""Token ids as Arrow stream files of equal-length sequences and masks.

Documents, in ascending id order, form one stream of token ids. Each range of
documents becomes a shard: a stream file whose record batches hold two
fixed-size lists, ``ids`` and ``mask``, of ``seq_len`` values a row (the last
row is padded, its mask says where), and a small file (doc_id, start, n_tokens)
of the documents in it. All batches of a file but the last have the same number
of rows and no compression, so position p of the stream lies in batch
p // (batch_rows * seq_len) and is read without a copy from a memory map.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.llm.common import id_text, materialize, prepare, scratch_path, shuffle_partitions

SEQ_LEN, BATCH_ROWS = 2048, 256
END_ID = 1
CACHE_WORDS = 300_000  # words whose ids a Python worker remembers, at least; twice as many at most

_tokenizers: dict = {}
_encoders: dict[str, _Encoder] = {}

MANIFEST = "shard int, tokens_path string, docs_path string, n_docs long, n_tokens long"


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


def id_type(path: str) -> np.dtype:
    """Two bytes an id where the vocabulary allows it."""
    return np.dtype("<u2" if _tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4")


class _Encoder:
    """Ids of white-space separated words, each encoded once by the library and remembered.

    The vocabulary drops white space and splits words into runs of letters, digits
    and other characters before it merges, so a text's ids are those of its words, and a word
    with a mark at its end is the word and the mark. Words of letters only are one
    run each: they are encoded many at a time and told apart by the vocabulary's
    end-of-word suffix. Two generations of remembered words bound the memory. A text that
    may hold a token that was added to the vocabulary goes to the library whole, as that finds them first.
    """

    def __init__(self, path: str, dtype: np.dtype):
        self.tok, self.dtype = _tokenizer(path), dtype
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # the first two characters, which normalisation leaves as they are: the rest of a token may be written differently
        self.added = {t.content[:2] for t in self.tok.get_added_tokens_decoder().values() if t.content}
        vocab = self.tok.get_vocab()
        suffix = self.tok.model.end_of_word_suffix
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def _each(self, words: list[str]) -> None:
        for w, e in zip(words, self.tok.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.young[w] = np.array(e.ids, dtype=self.dtype).tobytes()

    def _bulk(self, words: list[str]) -> None:
        parts = [words[i : i + 400] for i in range(0, len(words), 400)]
        made = self.tok.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)
        for part, e in zip(parts, made, strict=True):
            ids = np.array(e.ids, dtype=self.dtype)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):  # some word is not one run after all
                self._each(part)
                continue
            data, at = ids.tobytes(), 0
            for w, stop in zip(part, (stops * self.dtype.itemsize).tolist(), strict=True):
                self.young[w] = data[at:stop]
                at = stop

    def _know(self, words: set[str]) -> None:
        new = set()
        for w in words.difference(self.young):
            if (ids := self.old.get(w)) is not None:
                self.young[w] = ids
            else:
                new.add(w)
        plain = [w for w in new if w.isalpha()]
        self._bulk(plain)
        self._each([w for w in new if not w.isalpha()])

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > CACHE_WORDS:
            self.young, self.old = {}, self.young
        whole = {i: self.tok.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if any(x in t for x in self.added)}
        split = [[] if i in whole else t.replace("\n", " ").split(" ") for i, t in enumerate(texts)]
        compound = {}
        simple = set()
        for w in {w for words in split for w in words}.difference(self.young):
            if (ids := self.old.get(w)) is not None:
                self.young[w] = ids
                continue
            core = w
            # where lower case and composition leave one letter for each: Latin up to U+017F, but for the dotted I
            if w.isascii() or (w and max(w) <= "\u017f" and "\u0130" not in w):
                core = w.rstrip(".,;:!?")
                if not core or not core[-1].isalnum():
                    core = w
                tail, core = w[len(core) :], core.lower()
            else:
                tail = ""
            simple.add(core)
            if tail:
                simple.add(tail)
            if tail or core != w:
                compound[w] = core, tail
        self._know(simple)
        known = self.young
        for w, (core, tail) in compound.items():
            known[w] = known[core] + known[tail] if tail else known[core]
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for i, ids in whole.items():
            out[i] = np.array(ids, dtype=self.dtype).tobytes()
        return out


def encode_texts(texts: list[str], path: str, dtype: np.dtype) -> list[bytes]:
    """The ids of every text, without special tokens, as ``dtype`` bytes."""
    if path not in _encoders:
        _encoders[path] = _Encoder(path, dtype)
    return _encoders[path].encode(texts)


class _Shard:
    """Writes one shard; ids arrive document by document."""

    def __init__(self, fs, base: str, name: str, dtype: np.dtype, seq_len: int, batch_rows: int):
        self.dtype, self.seq_len, self.batch_rows = dtype, seq_len, batch_rows
        self.schema = pa.schema(
            [("ids", pa.list_(pa.from_numpy_dtype(dtype), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))]
        )
        self.paths = f"{base}/{name}.tokens.arrow", f"{base}/{name}.docs.arrow"
        self.tokens = fs.open_output_stream(self.paths[0])
        self.index = fs.open_output_stream(self.paths[1])
        self.tokens_out = pa.ipc.new_stream(self.tokens, self.schema)
        self.index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.index_out = pa.ipc.new_stream(self.index, self.index_schema)
        self.held, self.size, self.n_docs, self.n_tokens = [], 0, 0, 0
        self.batch_bytes = batch_rows * seq_len * dtype.itemsize

    def add(self, ids: list, texts: list[bytes]) -> None:
        counts = np.array([len(t) // self.dtype.itemsize for t in texts], dtype=np.int64)
        starts = self.n_tokens + np.cumsum(counts) - counts
        self.index_out.write_batch(
            pa.record_batch([pa.array(ids, pa.int64()), pa.array(starts), pa.array(counts)], schema=self.index_schema)
        )
        self.n_docs += len(ids)
        self.n_tokens += int(counts.sum())
        self.held += texts
        self.size += sum(map(len, texts))
        if self.size >= self.batch_bytes:
            joined = b"".join(self.held)
            whole = len(joined) // self.batch_bytes * self.batch_bytes
            for at in range(0, whole, self.batch_bytes):
                self._write(joined[at : at + self.batch_bytes])
            self.held, self.size = [joined[whole:]], len(joined) - whole

    def _write(self, data: bytes) -> None:
        flat = np.frombuffer(data, dtype=self.dtype)
        rows = -(-len(flat) // self.seq_len)
        ids = np.zeros(rows * self.seq_len, dtype=self.dtype)
        ids[: len(flat)] = flat
        mask = np.arange(rows * self.seq_len) < len(flat)
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (ids, mask)]
        self.tokens_out.write_batch(pa.record_batch(arrays, schema=self.schema))

    def close(self) -> None:
        if self.size:
            self._write(b"".join(self.held))
        for f in (self.tokens_out, self.index_out, self.tokens, self.index):
            f.close()


def write_shards(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, seq_len: int = SEQ_LEN, batch_rows: int = BATCH_ROWS,
    folder: str | None = None,
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the shards; the manifest, a row per shard.

    ``folder`` (default: a fresh one in the shared checkpoint folder) is a URI that
    pyarrow's file systems open on every executor. A task that is run again
    writes under new names, and the manifest, written once, names the files of the
    attempts that ended. Null texts are empty: they hold ``end_id`` only. Equal
    doc_ids follow one another in the order of their texts; null ids come first.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or scratch_path(spark, "tokens")
    dtype = id_type(tokenizer)
    end = np.array([end_id], dtype=dtype).tobytes()

    def write(batches):
        shard, n = None, TaskContext.get().partitionId()
        for batch in batches:
            if shard is None:
                uri = folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"
                fs, base = pafs.FileSystem.from_uri(uri)
                fs.create_dir(base, recursive=True)
                shard = _Shard(fs, base, f"shard-{n:06d}-{uuid.uuid4().hex}", dtype, seq_len, batch_rows)
            ids = encode_texts(batch.column("text").to_pylist(), tokenizer, dtype)
            shard.add(batch.column("doc_id").to_pylist(), [t + end for t in ids])
        if shard is not None:
            shard.close()
            cols = [[n], [shard.paths[0]], [shard.paths[1]], [shard.n_docs], [shard.n_tokens]]
            kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64())
            names = ("shard", "tokens_path", "docs_path", "n_docs", "n_tokens")
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    ranged = id_text(docs).repartitionByRange(shuffle_partitions(spark), "doc_id")
    manifest = ranged.sortWithinPartitions("doc_id", "text").mapInArrow(write, MANIFEST)
    manifest = materialize(manifest, "manifest")
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"
    return manifest.withColumn("folder", F.lit(uri))


class TokenFile:
    """Random access to one shard's stream of ids: ``file[start:stop]`` by position."""

    def __init__(self, fs, path: str):
        source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(source))
        self.size = self.batches[0].num_rows * self.batches[0].column(0).type.list_size if self.batches else 1

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of the ``row``-th sequence; the ids are a view of the file."""
        rows = self.batches[0].num_rows
        ids, mask = (self.batches[row // rows].column(c)[row % rows].values for c in (0, 1))
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)

    def read(self, start: int, stop: int) -> np.ndarray:
        parts = []
        while start < stop:
            k, at = divmod(start, self.size)
            flat = self.batches[k].column(0).flatten()
            parts.append(flat[at : at + stop - start].to_numpy())
            start += len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint32)


def _read(batches):
    for batch in batches:
        for row in batch.to_pylist():
            fs, _ = pafs.FileSystem.from_uri(row["folder"])
            tokens = TokenFile(fs, row["tokens_path"])
            with fs.open_input_stream(row["docs_path"]) as f:
                for part in pa.ipc.open_stream(f):
                    start, n = part.column("start").to_numpy(), part.column("n_tokens").to_numpy()
                    ids = (tokens.read(a, a + k) for a, k in zip(start.tolist(), n.tolist(), strict=True))
                    crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
                    yield pa.record_batch(
                        [part.column("doc_id"), pa.array(start + row["before"]), part.column("n_tokens"), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )


def read_documents(manifest: DataFrame) -> DataFrame:
    """Every document of the shards, read from the files: doc_id, start in the whole stream, n_tokens, ids_crc32.

    The running sum goes over the manifest, one row per shard. No shards, no rows.
    """
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = manifest.withColumn("before", before).repartition(shuffle_partitions(manifest.sparkSession), "shard")
    return rows.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
