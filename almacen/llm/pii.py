"""Personal data: patterns, and terms that give a protected value away.

Everything is DataFrame functions. A pattern's matches and the pieces between
them come from one split and one extraction of the text; the running lengths of
both give the positions. Spans are (kind, start, end) in code points.

The statistical part is information-theoretic: for each term near protected
values, the corpus says how much it tells about a value. With p(v) the
share of contexts of protected values that hold v, and p(v | t) the share of
all occurrences of t that are next to v, the disclosure of v by t is
log2(p(v | t) / p(v)) bits. A term that singles a value out, in enough different contexts
(in edited copies of one passage most of the surroundings recur, not only a name's other words: those don't count),
is a span of kind "term" wherever it stands, and is generalised with the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almacen.llm.common import id_text, materialize

# The patterns. Groups that nothing follows are possessive, which
# matches the same and takes no stack on long runs; a match starts where a run of its
# first characters starts or the last match ended, so that long runs are looked at once.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"  # shorter runs are no cards anyway
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term")  # in the order of equal starts

WINDOW = 3  # terms on either side of a value
WIDE = 12  # words on either side by which contexts differ
NEAR = 400  # code points in which these words are looked for first
MIN_CONTEXTS = 3  # different contexts in which a term is next to a value
MAX_COMPANY = 0.5  # of these contexts, from which on another term is company; of the terms around, that may be company, else they are copies of a passage
MIN_SHARE = 0.8  # of the term's occurrences that are next to the value
MIN_BITS = 3.0  # disclosed about the value
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(x: Column) -> Column:
    """Whether the digits of ``x`` pass the Luhn check."""
    d = digits(x)

    def worth(i: Column) -> Column:
        v = F.substring(d, F.length(d) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, v).otherwise(F.when(v > 4, 2 * v - 9).otherwise(2 * v))

    total = F.aggregate(F.transform(F.sequence(F.lit(0), F.length(d) - 1), worth), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def small_parts(x: Column) -> Column:
    """Whether all parts of a dotted number are at most 255."""

    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(x, r"\."), small)


SPAN = "struct<start: int, `order`: int, kind: string, end: int, value: string>"


def found(kind: str, pattern: str | Column, keep=None, text: str = "text") -> Column:
    """Array of (start, kind order, kind, end, value) of the matches of ``pattern``; ``keep`` tests a value."""
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    values = F.regexp_extract_all(F.col(text), regex, F.lit(0))
    gaps = F.transform(F.split(F.col(text), regex, -1), lambda x: F.char_length(x))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.char_length(x["value"])
        span = F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("order"), F.lit(kind).alias("kind"),
            end.alias("end"), x["value"].alias("value"),
        )
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    spans = F.aggregate(steps, begin, add, lambda acc: acc["spans"])
    return F.filter(spans, lambda s: keep(s["value"])) if keep else spans


def base_spans() -> Column:
    """All pattern spans of ``text``, by start, then kind."""
    count = lambda x: F.length(digits(x))
    parts = [
        found("email", EMAIL),
        found("ip", IP, small_parts),
        found("card", CARD, lambda x: (count(x) <= 19) & luhn(x)),
        found("phone", PHONE, lambda x: count(x).between(10, 15)),
    ]
    return F.array_sort(F.concat(*parts))


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_SPLIT), lambda w: w != "")


def term_of(word: Column) -> Column:
    """A word as a term: lower case, without punctuation at its ends; the empty string for no term.

    Words with a digit, "@" or "+" are values themselves or parts of one, not terms.
    """
    bare = F.regexp_replace(F.lower(word), r"^[^\p{L}]+|[^\p{L}]+$", "")
    return F.when(F.regexp_like(word, F.lit(r"[0-9@+]")), F.lit("")).otherwise(bare)


def before(start: Column, text: str = "text") -> Column:
    """The last WIDE words before the code point ``start``, the nearest first.

    As a rule they stand within NEAR code points: a stretch with more than WIDE words has the last WIDE whole. Only
    where it has fewer is the text split from its beginning.
    """
    lo = F.greatest(start - NEAR, F.lit(0))
    short, whole = words(F.substring(F.col(text), lo + 1, start - lo)), words(F.substring(F.col(text), F.lit(1), start))
    return F.slice(F.reverse(F.when((lo == 0) | (F.size(short) > WIDE), short).otherwise(whole)), F.lit(1), F.lit(WIDE))


def behind(end: Column, text: str = "text") -> Column:
    """The first WIDE words from the code point ``end`` on; see :func:`before`."""
    short = words(F.substring(F.col(text), end + 1, F.lit(NEAR)))
    whole = words(F.substring(F.col(text), end + 1, F.char_length(F.col(text))))
    return F.slice(F.when(F.size(short) > WIDE, short).otherwise(whole), F.lit(1), F.lit(WIDE))


def contexts(marked: DataFrame) -> DataFrame:
    """(value, context, n, terms, term): the terms within WINDOW words of each protected value, one context per distinct wide surrounding.

    n is how often the context occurs in distinct texts. Copies of a passage are one context, so that repeated documents give no evidence.
    """
    def beside(s: Column) -> Column:
        return F.struct(
            F.concat(s["kind"], F.lit(":"), F.lower(s["value"])).alias("value"),
            s["start"].alias("start"), before(s["start"]).alias("l"), behind(s["end"]).alias("r"),
        )

    near = marked.select(F.xxhash64("text").alias("text_key"), F.explode(F.transform("base", beside)).alias("s"))
    near = near.select("s.value", "text_key", "s.start", "s.l", "s.r")
    close = F.concat(F.slice("l", F.lit(1), F.lit(WINDOW)), F.slice("r", F.lit(1), F.lit(WINDOW)))
    near = near.select("value", "text_key", "start", F.transform(close, term_of).alias("terms"), F.to_json(F.struct("l", "r")).alias("c"))
    near = near.withColumn("context", F.sha2("c", 256)).drop("c").dropDuplicates(["value", "context", "text_key", "start"])
    near = near.groupBy("value", "context").agg(F.count(F.lit(1)).alias("n"), F.first("terms").alias("terms"))
    near = near.select("value", "context", "n", F.array_distinct(F.filter("terms", lambda t: t != "")).alias("terms"))
    return near.select("value", "context", "n", "terms", F.explode("terms").alias("term"))


def disclosing_terms(docs: DataFrame, near: DataFrame) -> DataFrame:
    """(term, value, bits) of the terms that give a value away, from counts over the whole corpus.

    ``docs`` has the texts, ``near`` the :func:`contexts` of their protected values.
    """
    total = near.agg(F.count_distinct("value", "context").alias("all_contexts"))
    of_value = near.groupBy("value").agg(F.count_distinct("context").alias("value_contexts"))
    pairs = near.groupBy("term", "value").agg(F.count(F.lit(1)).alias("both"), F.sum("n").alias("beside"))
    pairs = pairs.where(F.col("both") >= MIN_CONTEXTS)
    others = near.select("term", "value", F.explode("terms").alias("other")).where("other <> term")
    company = others.groupBy("term", "value", "other").count().join(pairs.select("term", "value", "both"), ["term", "value"])
    recurring = F.when(F.col("count") > MAX_COMPANY * F.col("both"), F.col("count")).otherwise(0)
    company = company.groupBy("term", "value").agg((F.sum(recurring) / F.sum("count")).alias("company"))
    pairs = pairs.join(company, ["term", "value"], "left").where(F.coalesce("company", F.lit(0.0)) <= MAX_COMPANY)
    # every word of the corpus is counted, partially before the shuffle, per distinct text
    said = docs.select("text").distinct().select(F.explode(words(F.col("text"))).alias("word")).groupBy("word").count()
    said = said.select(term_of(F.col("word")).alias("term"), "count").groupBy("term").agg(F.sum("count").alias("term_count"))
    told = pairs.join(of_value, "value").join(said, "term").crossJoin(F.broadcast(total))  # total is one row
    share = F.least(F.lit(1.0), F.col("beside") / F.col("term_count"))
    bits = F.log2(share / (F.col("value_contexts") / F.col("all_contexts")))
    told = told.select("term", "value", share.alias("share"), bits.alias("bits"))
    return told.where((F.col("share") >= MIN_SHARE) & (F.col("bits") >= MIN_BITS))


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def detect(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text, base, spans.

    base and spans are arrays of (start, order, kind, end, value) by start, then kind: the pattern
    spans, and all spans with those of the terms that disclose a value. Null texts are empty and have none.
    Null and repeated ids are allowed, repeated rows give repeated rows, other columns are not read. No rows, no rows.
    """
    src = id_text(docs)
    marked = src.withColumn("base", base_spans())
    near = materialize(contexts(marked.where(F.size("base") > 0)), "contexts")
    terms = materialize(disclosing_terms(src, near).select("term").distinct(), "terms")
    plain = marked.withColumn("spans", F.col("base"))
    if terms.isEmpty():
        return plain
    # the texts that hold a disclosing term, by the words they have, and the places of each
    keyed = marked.withColumn("row", F.monotonically_increasing_id())
    held = src.select("text").distinct().select("text", F.explode(F.array_distinct(F.transform(words(F.col("text")), term_of))).alias("term"))
    held = held.join(terms, "term").select(F.sha2("text", 256).alias("key"), "text", "term")
    quoted = F.concat(F.lit(r"(?iu)(?<![^\x20\x09-\x0D\p{P}\p{S}])\Q"), "term", F.lit(r"\E(?![^\x20\x09-\x0D\p{P}\p{S}])"))
    places = held.select("key", F.explode(found("term", quoted)).alias("s")).groupBy("key").agg(F.collect_set("s").alias("more"))
    out = keyed.withColumn("key", F.sha2("text", 256)).join(places, "key", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.expr("slice(base, 1, 0)"))))
    return out.select("doc_id", "text", "base", spans.alias("spans"))


def sanitise(found_in: DataFrame) -> DataFrame:
    """``found_in`` (from :func:`detect`) with ``clean``: pattern spans become "<kind>", disclosing terms "<term>".

    Of overlapping spans the one that starts first is replaced, and the rest of the other with it.
    """
    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
        tag = F.when(s["start"] >= acc["at"], F.concat(F.lit("<"), s["kind"], F.lit(">"))).otherwise(F.lit(""))
        return F.struct(F.concat(acc["out"], gap, tag).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    def end(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.char_length("text")))

    return found_in.withColumn("clean", F.aggregate("spans", begin, step, end))


def digest(found_in: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of the rows of :func:`detect`."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found_in.select(
        "doc_id", *map(count, KINDS[:4]), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )
