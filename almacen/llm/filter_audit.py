"""How filters interact: what each one removes in every order of applying them.

A row's mask says which filters it fails. In a given order the row is removed
at the first filter of its mask. The orders, in lexicographic order, have ranks
0 to n! - 1; all orders that begin with the same letters fill one interval of ranks.
So a mask leaves at step s through filter f exactly on the intervals of the prefixes
of s letters that end in f and have no other letter of the mask. Each mask's
count is added where an interval starts and taken off where it ends, and running
sums over the ranks give every order's numbers at once: the rows are
read once and counted by mask, whatever the number of orders.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almacen.operators.joins import salted_left_join

SPACE = r"[\x20\x09-\x0D]+"
LETTERS = "ABCDE"
COUNTS = ("rows", "good", "toxic")  # what is added up over the intervals: rows, and rows with each label


def lehmer_rank(order: str, letters: str) -> int:
    """Place of ``order`` among all permutations of ``letters`` in lexicographic order."""
    left, rank = sorted(letters), 0
    for i, x in enumerate(order):
        rank += left.index(x) * math.factorial(len(order) - i - 1)
        left.remove(x)
    return rank


def intervals(letters: str) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, end rank) of every interval of orders in which ``mask`` leaves at ``step``."""
    n, out = len(letters), []
    bit = {x: 1 << i for i, x in enumerate(letters)}
    for step in range(1, n + 1):
        width = math.factorial(n - step)
        for prefix in permutations(letters, step):
            rest = "".join(x for x in sorted(letters) if x not in prefix)
            start = lehmer_rank("".join(prefix) + rest, letters)
            passed = sum(bit[x] for x in prefix[:-1])
            for mask in range(1, 1 << n):
                if mask & bit[prefix[-1]] and not mask & passed:
                    out.append((mask, step, start, start + width))
    return out


def text_failures(text: Column) -> dict[str, Column]:
    """Conditions A to D on a text that is not null."""
    words = F.array_remove(F.split(text, SPACE), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` counted by part (lang) and mask: part, mask, rows, good, toxic.

    Bits 0 to 3 of the mask are :func:`text_failures` A to D. Bit 4 (E): the text, null
    as empty, is that of a row with a smaller doc_id. A null doc_id is neither smaller nor greater than
    another, and rows of one doc_id are not copies of one another. good and toxic count the rows
    whose doc_id has a label quality = 1 or toxic = 1 (in any of its label rows).

    Texts are compared by their sha256, and no group of equal texts is ever
    gathered: rows are first counted by (text, lang, labels, doc_id), then of each such group
    only its least doc_id and counts go on, so a text has at most as many rows as
    there are languages times four.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    fails = text_failures(text)
    mask = sum((fails[x].cast("int") * (1 << i) for i, x in enumerate("ABCD")), F.lit(0))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("same"),
        mask.cast("int").alias("mask"),
    )
    told = labels.groupBy(F.col("doc_id").cast("long").alias("_of")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    rows = salted_left_join(rows, told.where("good OR toxic"), "doc_id", "_of", row_id=["same"]).drop("_of")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    kind = ["same", "part", "mask", "good", "toxic"]
    by_id = rows.groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    groups = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
    )
    first = F.min("least.doc_id").over(Window.partitionBy("same"))
    alone = F.col("nameless") + F.when(F.col("least.doc_id") == F.col("_first"), F.col("least.n")).otherwise(F.lit(0))
    split = groups.withColumn("_first", first).withColumn("_alone", F.coalesce(alone, F.lit(0)))
    ends = F.array(
        F.struct(F.col("mask"), F.col("_alone").alias("rows")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("_alone")).alias("rows")),
    )
    out = split.select("part", "good", "toxic", F.explode(ends).alias("e")).select("part", "good", "toxic", "e.*")
    return out.groupBy("part", "mask").agg(
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("good"), F.col("rows")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("rows")).otherwise(0)).alias("toxic"),
    )


def audit(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every order of the filters ``letters``, from rows counted by part and mask.

    ``masks``: part, mask (bit i: fails the i-th letter), rows, good, toxic. One row per part,
    filter_order and step, zeros included: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley. The counts have at most parts * 2**n rows, what follows at
    most parts * n! * n; no part, no rows.
    """
    spark = masks.sparkSession
    n = len(letters)
    orders = ["".join(p) for p in permutations(sorted(letters))]
    steps = spark.createDataFrame(intervals(letters), "mask int, step int, start int, stop int")
    held = masks.where("mask > 0").join(F.broadcast(steps), "mask")  # as many rows as the rule makes, 840 for five
    signed = [F.col("start").alias("rank"), *[F.col(c) for c in COUNTS]], [F.col("stop").alias("rank"), *[-F.col(c) for c in COUNTS]]
    ends = F.array(*[F.struct(r, *[x.alias(c) for x, c in zip(v, COUNTS, strict=True)]) for r, *v in signed])
    marks = held.select("part", "step", F.explode(ends).alias("e")).select("part", "step", "e.*").where(F.col("rank") < len(orders))
    bit = {x: 1 << i for i, x in enumerate(letters)}
    by_part = [F.sum("rows").alias("total")]
    for x in letters:
        has = F.col("mask").bitwiseAND(bit[x]) > 0
        by_part.append(F.sum(F.when(has, F.col("rows")).otherwise(0)).alias(f"fails_{x}"))
        by_part.append(F.sum(F.when(F.col("mask") == bit[x], F.col("rows")).otherwise(0)).alias(f"only_{x}"))
    parts = masks.groupBy("part").agg(*by_part)
    grid = parts.select("part", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("rank"))
    grid = grid.select("part", "rank", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    zero = grid.select("part", "step", "rank", *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    deltas = marks.select(*zero.columns).unionByName(zero).groupBy("part", "step", "rank").agg(
        *[F.sum(c).alias(c) for c in COUNTS]
    )
    running = Window.partitionBy("part", "step").orderBy("rank")
    sums = deltas.select("part", "step", "rank", *[F.sum(c).over(running).alias(c) for c in COUNTS])
    order = F.element_at(F.array(*[F.lit(o) for o in orders]), F.col("rank") + 1)
    named = sums.withColumn("filter_order", order).withColumn("letter", F.substr("filter_order", "step", F.lit(1)))
    named = named.join(parts, "part")

    def pick(prefix: str) -> Column:
        return F.element_at(F.create_map(*[y for x in letters for y in (F.lit(x), F.col(f"{prefix}_{x}"))]), F.col("letter"))

    so_far = F.sum("rows").over(Window.partitionBy("part", "rank").orderBy("step"))
    out = named.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - so_far).alias("kept"),
        F.col("rows").alias("removed"),
        (pick("fails") - F.col("rows")).alias("redundant"),
        pick("only").alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("rows").over(Window.partitionBy("part", "letter")).alias("shapley"),
    )
    whole = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return out.withColumns({c: F.col(c).cast("long") for c in whole})
