"""Near-duplicate documents by HyperMinHash.

A document's set of word shingles is hashed into ``REGISTERS`` buckets; a bucket
keeps, of its least hash, the number of leading zeros and ``MANTISSA`` bits after
the leading one: 16 bits a register, 256 bytes a document. Empty buckets borrow
from others in a fixed random order (densification), so small sets have full
sketches, too. Bands of four registers are the candidate keys; the estimated
Jaccard similarity, corrected for chance collisions of registers, sorts out the
clearly different, and the full shingle sets decide.

Candidates are not all pairs of a bucket: documents with equal sets are one
class; each class of a bucket is paired with the bucket's centre, the class whose
other bands are shared most: of many edited copies that is the one with the fewest edits,
which nearly every copy that has a link at all is linked with. The confirmed links make
components; and only where a bucket still spans several components are the pairs across
them looked at as well: without the classes that have too many shingles of their own to
be linked with any other there, and joined on their rarest shingles, of which two linked classes
share one. So every pair of a bucket is decided, impossible, or inside one component, and no
link between components is lost.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.llm.common import components, id_text, materialize, prepare
from almacen.llm.textkit import blocks, grams, mix, word_hashes

REGISTERS, MANTISSA, BAND = 128, 10, 4
BANDS = REGISTERS // BAND  # at a similarity of 0.8 a pair shares no band with a chance of (1 - 0.8**4)**32 = 5e-8
MARGIN = 0.3  # pairs estimated this far below the threshold are not confirmed: over six standard errors
ROW = ("doc_id", "text_a", "text_b", "row")  # a row's id, two hashes of its text, and its own number
_ORDER = np.stack([np.random.Generator(np.random.PCG64(i)).permutation(REGISTERS) for i in range(REGISTERS)])
_ORDER = np.stack([np.concatenate([[i], row[row != i]]) for i, row in enumerate(_ORDER)])
# chance that two unequal minima give equal registers: both in one octave (about 1/3), equal mantissa
COLLISION = 2.0**-MANTISSA / 3


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: ``size`` words each, or all words of a shorter text."""
    out = []
    for lo, hi in blocks(texts):
        words, first, _, _ = word_hashes(texts[lo:hi], lower=True)
        all_grams = grams(words, size)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= size:
                out.append(np.unique(all_grams[a : b - size + 1]))
            else:
                out.append(grams(words[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out


def sketch(s: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (uint16: leading zeros, then mantissa) of a sorted set of hashes; zeros for no members."""
    regs = np.zeros(REGISTERS, dtype=np.uint16)
    if not len(s):
        return regs
    bits = REGISTERS.bit_length() - 1
    bucket = (s >> np.uint64(64 - bits)).astype(np.int64)
    at, lowest = np.unique(bucket, return_index=True)  # the set is sorted: the first of a bucket is its least
    rest = s[lowest] << np.uint64(bits)
    zeros = np.zeros(len(at), dtype=np.uint64)
    for step in (32, 16, 8, 4, 2, 1):
        small = rest < np.uint64(1 << (64 - step))
        zeros += np.where(small, np.uint64(step), np.uint64(0))
        rest = np.where(small, rest << np.uint64(step), rest)
    mantissa = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    regs[at] = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    if len(at) < REGISTERS:
        full = np.zeros(REGISTERS, dtype=bool)
        full[at] = True
        regs = regs[_ORDER[np.arange(REGISTERS), full[_ORDER].argmax(axis=1)]]
    return regs


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows of registers, corrected for chance collisions."""
    equal = (a == b).mean(axis=-1)
    return np.clip((equal - COLLISION) / (1 - COLLISION), 0, 1)


def _sketches(size: int):
    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), size)
            key = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            regs = [sketch(s) for s in sets]
            bands = [mix(r.view(np.uint64) + mix(np.arange(1, BANDS + 1, dtype=np.uint64))).view(np.int64) for r in regs]
            yield pa.record_batch(
                {
                    **{c: batch.column(c) for c in ROW},
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_key": pa.array(key, pa.binary()),
                    "regs": pa.array([r.tobytes() for r in regs], pa.binary()),
                    "bands": pa.array([x if len(s) else x[:0] for x, s in zip(bands, sets, strict=True)], pa.list_(pa.int64())),
                }
            )

    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), size)
            yield pa.record_batch([batch.column("rep"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "members"])

    return run


def _own_shingles(batches):
    for batch in batches:
        sets = [np.frombuffer(x, np.int64) for x in batch.column("members").to_pylist()]
        if sets:
            rep = np.repeat(batch.column("rep").to_numpy(), [len(x) for x in sets])
            yield pa.record_batch([pa.array(rep), pa.array(np.concatenate(sets))], names=["rep", "shingle"])


def _estimate(batches):
    for batch in batches:
        a, b = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("regs_a", "regs_b")
        )
        cols = [*(batch.column(c) for c in ("a", "b", "n_a", "n_b")), pa.array(similarity(a, b), pa.float64())]
        yield pa.record_batch(cols, names=["a", "b", "n_a", "n_b", "est"])


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.searchsorted(u, v)
                both = int((u[np.minimum(at, len(u) - 1)] == v).sum())
                ok.append(100 * both >= percent * (len(u) + len(v) - both))
            yield pa.record_batch([batch.column("a"), batch.column("b"), pa.array(ok)], names=["a", "b", "linked"])

    return run


class _Links:
    """Candidate pairs of classes are handed in; components of the confirmed links come out."""

    def __init__(self, classes: DataFrame, members: DataFrame, percent: int):
        self.classes, self.members, self.percent = classes, members, percent
        self.links = self.labels = None

    def promising(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and sketches allow, with their estimate."""
        c = self.classes
        sided = pairs.join(c.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("regs").alias("regs_a")), "a")
        sided = sided.join(c.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("regs").alias("regs_b")), "b")
        sided = sided.where(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b"))
        est = sided.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(
            _estimate, "a long, b long, n_a long, n_b long, est double"
        )
        return materialize(est.where(F.col("est") >= self.percent / 100 - MARGIN), "pairs")

    def across(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose ends are in different components so far."""
        if self.labels is None:
            return pairs
        lab = self.labels
        out = pairs.join(lab.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left")
        out = out.join(lab.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
        return out.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb")

    def confirm(self, pairs: DataFrame) -> None:
        m = self.members
        both = pairs.select("a", "b").join(m.select(F.col("rep").alias("a"), F.col("members").alias("set_a")), "a")
        both = both.join(m.select(F.col("rep").alias("b"), F.col("members").alias("set_b")), "b")
        new = both.select("a", "b", "set_a", "set_b").mapInArrow(_confirm(self.percent), "a long, b long, linked boolean")
        new = materialize(new.where("linked").select("a", "b"), "links")
        self.links = new if self.links is None else self.links.unionByName(new)
        self.labels = materialize(components(self.links), "labels")

    def settle(self, pairs: DataFrame) -> None:
        """Decide all ``pairs``: first the likeliest of each class, then what is left between components."""
        best = pairs.select(F.explode(F.array("a", "b")).alias("x"), "a", "b", "est").groupBy("x").agg(
            F.max(F.struct("est", "a", "b")).alias("m")
        )
        first = materialize(best.select("m.a", "m.b").distinct(), "first")
        self.confirm(first)
        rest = materialize(self.across(pairs).join(first, ["a", "b"], "left_anti"), "rest")
        if not rest.isEmpty():
            self.confirm(rest)


def _pairs(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _to_centres(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of each class with the centres of its buckets, from (band, rep, size of the bucket).

    A class weighs what its buckets hold together, so every edit that moves a class out of the
    common buckets makes it lighter. The heaviest of a bucket is its centre.
    """
    weight = shared.groupBy("rep").agg(F.sum("size").alias("weight"))
    centre = shared.join(weight, "rep").groupBy("band").agg(F.max(F.struct("weight", "rep")).alias("m"))
    near = shared.join(centre.select("band", F.col("m.rep").alias("centre")), "band").where("rep <> centre")
    return near.select(*_pairs("rep", "centre")).distinct()


def _undecided(shared: DataFrame, classes: DataFrame, members: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(rep, comp, n, least) of the classes in buckets that hold several components, without those that can have no link there.

    A link needs (100 + percent) * |A and B| >= percent * (|A| + |B|). In a bucket
    |B| is at least the least size in it and percent / 100 * |A|, and |A and B| is at most the
    number of A's shingles that any other class of these buckets has.
    """

    def mixed(held: DataFrame) -> DataFrame:
        several = held.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("least"))
        return held.join(several.where("lo < hi").select("band", "least"), "band")

    lab, size = labels.withColumnRenamed("node", "rep"), classes.select("rep", F.col("n_shingles").alias("n"))
    held = shared.select("band", "rep").join(lab, "rep", "left").join(size, "rep")
    held = materialize(mixed(held.select("band", "rep", "n", F.coalesce("comp", "rep").alias("comp"))), "mixed")
    sets = members.join(held.select("rep").distinct(), "rep", "left_semi").select("rep", "members")
    counted = sets.mapInArrow(_own_shingles, "rep long, shingle long").groupBy("shingle")
    lonely = counted.agg(F.count(F.lit(1)).alias("df"), F.min("rep").alias("rep")).where("df = 1")
    lonely = lonely.groupBy("rep").agg(F.count(F.lit(1)).alias("lonely"))
    open_ = held.join(lonely, "rep", "left").where(
        f"(100 + {percent}) * (n - coalesce(lonely, 0)) >= {percent} * (n + greatest(least, {percent} * n / 100))"
    )
    left = mixed(open_.select("band", "rep", "n", "comp")).groupBy("rep", "comp", "n").agg(F.min("least").alias("least"))
    return materialize(left, "undecided")


def _across(left: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of the classes ``left`` that may be linked and are in different components.

    All shingles are ordered, the rarest first. Of two linked classes the first shingle that they
    share has, in each, so few before it that the rest suffices for a link; so only
    that many of a class's rarest shingles are joined, and edited copies of one text do not meet at what all
    of them have.
    """
    sets = members.join(left, "rep").select("rep", "members")
    own = materialize(sets.mapInArrow(_own_shingles, "rep long, shingle long"), "own")
    df = own.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # lonely shingles come first in any order and match nothing: the others' places follow their number
    met = own.join(df, "shingle").join(left, "rep")
    order = Window.partitionBy("rep").orderBy(F.desc("df"), F.desc("shingle"))
    met = met.withColumn("after", F.row_number().over(order))  # this shingle and the class's more frequent ones
    few = f"(100 + {percent}) * after >= {percent} * (n + greatest(least, {percent} * n / 100))"
    met = materialize(met.where(few).select("shingle", "rep", "comp", "n", "after"), "rare")
    # at a shingle, classes of its most frequent component meet only the others
    most = met.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("shingle")
    most = most.agg(F.max(F.struct("k", "comp")).alias("m"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    held = met.join(most.select("shingle", F.col("m.comp").alias("major")), "shingle")
    x, y = held.where("comp <> major").drop("major").alias("x"), held.alias("y")
    enough = f"(100 + {percent}) * least(x.after, y.after) >= {percent} * (x.n + y.n)"
    pair = f"x.shingle = y.shingle AND x.comp <> y.comp AND (y.comp = y.major OR x.rep < y.rep) AND {enough}"
    return x.join(y, F.expr(pair)).select(*_pairs("x.rep", "y.rep")).distinct()


def _rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and two hashes of the text: id and hashes name a row (or rows of equal fate) in every reading of ``docs``."""
    return id_text(docs).withColumns({"text_a": F.xxhash64("text"), "text_b": F.xxhash64(F.lit(1), "text")})


def _grouped(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The rows of ``docs`` by ``ROW``, with n_shingles, comp (null without shingles), component_id and kept."""
    spark = docs.sparkSession
    prepare(spark)
    src = _rows(docs)
    made = src.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _sketches(shingle),
        "doc_id long, text_a long, text_b long, row long, n_shingles long, set_key binary, regs binary, bands array<long>",
    )
    made = materialize(made, "sketches")  # the rows' numbers are written once, here
    # documents with equal sets are one class, numbered; it knows its least id and its first row
    classes = made.where("n_shingles > 0").groupBy("set_key", "n_shingles", "regs", "bands")
    classes = classes.agg(F.min("doc_id").alias("least"), F.min("row").alias("first"))
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")

    rows = classes.select("rep", F.explode("bands").alias("band"))
    buckets = rows.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = materialize(rows.join(buckets, "band"), "shared")
    pairs = _to_centres(shared)

    nodes = classes.select("rep", F.col("first").alias("row")).join(shared.select("rep").distinct(), "rep", "left_semi")
    nodes = made.select(*ROW).join(nodes, "row").drop("row").alias("n")
    same = F.expr("s.doc_id <=> n.doc_id AND s.text_a = n.text_a AND s.text_b = n.text_b")
    texts = src.alias("s").join(nodes, same).select("rep", "text")
    members = materialize(texts.mapInArrow(_sets(shingle), "rep long, members binary").dropDuplicates(["rep"]), "members")

    state = _Links(classes, members, percent)
    star = state.promising(pairs)
    state.settle(star)
    left = _undecided(shared, classes, members, state.labels, percent)
    cross = _across(left, members, percent).join(pairs, ["a", "b"], "left_anti")
    more = state.promising(cross)
    if not more.isEmpty():
        state.settle(more)

    lab = state.labels.select(F.col("node").alias("rep"), "comp")
    own = classes.select("set_key", "n_shingles", "rep", "least", "first")
    ends = own.join(lab, "rep").groupBy("comp").agg(F.min("least").alias("c_least"), F.min("first").alias("c_first"))
    named = own.join(lab.join(ends, "comp"), "rep", "left").select(
        "set_key",
        "n_shingles",
        F.coalesce("comp", "rep").alias("comp"),
        F.when(F.col("comp").isNull(), F.col("least")).otherwise(F.col("c_least")).alias("least"),
        F.coalesce("c_first", "first").alias("first"),
    )
    # the class size is implied by the key; as a join key it gives both sides an exchange that AQE can split
    out = made.select(*ROW, "n_shingles", "set_key").join(named, ["set_key", "n_shingles"], "left")
    component = F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    nameless = F.col("comp").isNotNull() & F.col("least").isNull()
    kept = F.when(nameless, F.col("row") == F.col("first")).otherwise(F.col("doc_id").eqNullSafe(component))
    return out.select(*ROW, "n_shingles", "comp", component.alias("component_id"), kept.alias("kept"))


def near_groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two rows are linked when 100 * |A and B| >= percent * |A or B| for their
    sets of ``shingle``-word shingles (A-Z in lower case; shorter texts: all words
    as one). component_id is the least doc_id reached over links, kept whether it
    is the row's own. Null and empty texts, and texts of white space, have no
    shingles and no links. Rows that repeat a doc_id are one document each, linked by their
    own texts; rows with null ids are linked like others, and of a component without
    any id (component_id null) one row is kept. Other columns are not read. No rows, no rows.
    """
    return _grouped(docs, shingle, percent).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the near copies: of each component one row, with the least doc_id. All columns stay.

    A row without an id goes only if its own text is a near copy of a row that stays. Of rows with
    equal ids and equal texts any one stays, rows without words all do.
    """
    fate = materialize(_grouped(docs, shingle, percent).where("comp IS NOT NULL").select(*ROW, "comp", "kept"), "fate")
    several = fate.where("kept").groupBy("comp").agg(F.min("row").alias("one"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stays = F.col("kept") & F.coalesce(F.col("row") == F.col("one"), F.lit(True))
    rows = fate.join(several.drop("n"), "comp", "left").withColumn("stays", stays)
    keys = rows.groupBy("doc_id", "text_a", "text_b").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n"))
    listed = materialize(keys.where("NOT stays OR n > 1"), "gone")

    text = F.coalesce("text", F.lit(""))
    own = {"_near_id": F.col("doc_id").cast("long"), "_near_a": F.xxhash64(text), "_near_b": F.xxhash64(F.lit(1), text)}
    marked = docs.withColumns(own).alias("d")
    same = F.expr("d._near_id <=> g.doc_id AND d._near_a = g.text_a AND d._near_b = g.text_b")
    out = marked.join(listed.alias("g"), same, "left_anti")
    twice = listed.where("stays")
    if not twice.isEmpty():  # one of each
        out = out.unionByName(marked.join(twice.alias("g"), same, "left_semi").dropDuplicates(list(own)))
    return out.drop(*own)
