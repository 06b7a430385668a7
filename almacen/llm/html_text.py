"""Main text of web pages: page structure, and a suffix array over each host's pages, which decide together.

A page's markup says what is an article and what is a menu, notice, advert, form and so on. The suffix array finds
what markup does not say: text that pages of a host repeat. All pages go into it, articles and the rest.

Outside articles every token starts a suffix, ordered by its first ``REPEAT`` tokens; suffixes that share them on
distinct pages are boilerplate, and pages without an article give the runs of their text that are left.

In articles every block starts a suffix (a sparse array, since blocks stay or go whole), ordered by the hashes of its
first 6, 7, 8, 10, 12, 15, ... and of all its tokens; so the common prefix of neighbours is known to a fifth, or whole. An article's
slot is an element with its parents' names, such as ``article/div/p``. A slot that the array finds on other pages in
most of its tokens, and that half of the host's articles have, is boilerplate on that host, whatever its name, and its blocks go. The slot that
holds most of a host's text, and headings, are the article itself: passages that pages share there are content and stay.
Both orders are range partitioned sorts by host and first tokens of (block id, place) or of hashes, so no host and no
suffix list sits in one task's memory.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almacen.llm.common import materialize, prepare, shuffle_partitions

REPEAT = 6  # tokens that two pages must share in a row; shorter blocks count as a whole
FEW = 3  # a host with fewer distinct articles shows no slots that repeat
SLOT = 4  # names of elements, from the inside, that make a slot
ROWS = 20_000  # suffixes of an Arrow batch

# Elements and names of the markup
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|object|select|audio|video|canvas"
SKIPPED = frozenset("nav footer aside form menu dialog button fieldset".split())
SKIPPED_OUTSIDE = frozenset(["header"])
MAIN = frozenset(["article", "main"])
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
SKIPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent notice popup modal newsletter subscribe share "
    "sharing social related comment comments disqus widget toolbar".split()
)

# inside an article a part of a class name counts for these only: "social-history" is no menu, "cookie-recipe" no notice
FIRST_PARTS = frozenset("ad ads advert adverts advertisement advertising sponsored comment comments disqus newsletter".split())
LAST_PARTS = frozenset("comment comments disqus newsletter notice ad ads advert".split())
PAIRS = (
    (frozenset(["cookie", "cookies"]), frozenset("banner bar consent notice policy popup".split())),
    (frozenset(["share", "sharing"]), frozenset("article bar buttons links page post social story tools".split())),
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# legal omitted end tags: what an opening tag ends, and what the search for it doesn't look through
ENDS_P = frozenset(
    "address article aside blockquote details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section summary table ul".split()
)
ROWS = frozenset(["thead", "tbody", "tfoot"])
ENDS = {"li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "td": ["td", "th"], "th": ["td", "th"], "tr": ["tr"], **dict.fromkeys(ROWS, ROWS)}
THROUGH = {
    **dict.fromkeys(("li", "dt", "dd"), frozenset(["p", "div", "address", *INLINE])),
    **dict.fromkeys(("td", "th"), frozenset(["p", "div", "li", "ul", "ol", "dl", "dt", "dd", *INLINE])),
    "tr": frozenset(["td", "th", "p", "div", "li", "ul", "ol", "dl", "dt", "dd", *INLINE]),
    **dict.fromkeys(ROWS, frozenset(["tr", "td", "th", "p", "div", "li", "ul", "ol", "dl", "dt", "dd", "caption", "colgroup", *INLINE])),
}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_HOST = r"(?U)^[\s\x1c-\x1f]*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)"


def host_of(url: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))


def _skips(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether an element is boilerplate by its name, role, class or id."""
    if tag in SKIPPED or (tag in SKIPPED_OUTSIDE and not in_main):
        return True
    if not attributes or tag in MAIN or tag in ("html", "body"):
        return False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in SKIPPED_ROLES:
            return True
        if name in ("class", "id") and not in_main and not SKIPPED_NAMES.isdisjoint(re.split(r"[\s_-]+", value)):
            return True
        if in_main and (name == "class" or (name == "id" and tag not in HEADINGS)) and any(map(_named, value.split())):
            return True
    return False


def _named(token: str) -> bool:
    """Whether a class or id inside an article is a name of boilerplate as a whole, by its first or last part, or by two."""
    parts = re.split("[_-]+", token)
    return (
        token in SKIPPED_NAMES
        or parts[0] in FIRST_PARTS
        or parts[-1] in LAST_PARTS
        or any(not a.isdisjoint(parts) and not b.isdisjoint(parts) for a, b in PAIRS)
    )


def _implied(tag: str, open_: list[tuple[str, bool]]) -> int:
    """How many of the open elements stay when ``tag`` opens: those whose end tag may be left out end here."""
    at = len(open_)
    ended = ENDS.get(tag, ())
    if ended:
        k = at - 1
        while k >= 0 and open_[k][0] in THROUGH[tag] and open_[k][0] not in ended:
            k -= 1
        at = k if k >= 0 and open_[k][0] in ended else at
    elif tag in ENDS_P:
        k = at - 1
        while k >= 0 and open_[k][0] in INLINE:
            k -= 1
        at = k if k >= 0 and open_[k][0] == "p" else at
    return at


def _closed(tag: str, open_: list[tuple[str, bool]], count: Counter) -> int:
    """How many of the open elements stay when ``tag`` closes; an article ends with its own end tag only."""
    if not count[tag]:
        return len(open_)
    k = len(open_) - 1
    while open_[k][0] != tag:
        if open_[k][0] in MAIN and tag not in MAIN:
            return len(open_)
        k -= 1
    return k


def _name(tag: str, attributes: str) -> str:
    """An element in a slot: its tag and classes, without those that hold numbers, as they may name a page."""
    if not attributes or tag in MAIN:
        return tag
    classes = {c for n, *v in _ATTRIBUTE.findall(attributes) if n.lower() == "class" for c in "".join(v).lower().split()}
    return ".".join([tag, *sorted(c for c in classes if not re.search("[0-9]", c))])


def page_blocks(page: str) -> tuple[list[str], list[str], bool]:
    """(blocks of the articles, visible blocks outside them, whether there is an article).

    Blocks outside articles include menus, adverts and the like; those inside articles are left out.
    White space in a block is one space.
    """
    main, outside, found = page_parts(page)
    return [text for _, text in main], outside, found


def page_parts(page: str) -> tuple[list[tuple[str, str]], list[str], bool]:
    """:func:`page_blocks` with the slot of each block of the articles."""
    main: list[tuple[str, str]] = []
    outside: list[tuple[bool, str]] = []  # (in boilerplate, text)
    held: list[str] = []
    open_: list[tuple[str, bool]] = []  # elements, and whether they are an article that counts
    names: list[str] = []  # of the open elements
    count: Counter = Counter()
    depth, skip, skip_at, head, found = 0, "", 0, False, False  # skip_at: open elements around the skipped one

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text and not head:
            if depth and not skip:
                inner = open_[-SLOT:]
                first = next((k for k, (_, counts) in enumerate(inner) if counts), 0)
                main.append(("/".join(names[-SLOT:][first:]), text))
            elif not depth:
                outside.append((bool(skip), text))

    def leave(stay: int) -> None:
        nonlocal depth, skip
        for tag, counts in open_[stay:]:
            count[tag] -= 1
            depth -= counts
        del open_[stay:], names[stay:]
        if skip and stay <= skip_at:
            skip = ""

    def enter(tag: str, counts: bool = False, attributes: str = "") -> None:
        nonlocal depth
        open_.append((tag, counts))
        names.append(_name(tag, attributes) if depth else tag)
        count[tag] += 1
        depth += counts

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            if m[1]:
                flush()
            continue
        closing, attributes = m[2] or m[5], m[4] or m[7] or ""
        if tag in INLINE and not (attributes and not closing and not skip and _skips(tag, attributes, depth > 0)):
            if skip == tag:  # an inline element that is boilerplate by its class
                if not closing:
                    enter(tag)
                elif (stay := _closed(tag, open_, count)) <= skip_at:
                    flush()
                    leave(stay)
                else:
                    leave(stay)
            continue
        flush()
        if tag == "head":
            head = not closing
        elif tag == "body":
            head = False
        elif tag == "html":
            continue
        elif closing:
            leave(_closed(tag, open_, count))
        else:
            leave(_implied(tag, open_))
            if tag in VOID or attributes.endswith("/"):
                continue
            if skip and tag in MAIN and not depth and not re.search(rf"</{skip}\s*>", page[at:], re.I):
                leave(skip_at)  # an element that is never closed ends where the article begins
            if not skip and _skips(tag, attributes, depth > 0):
                skip, skip_at = tag, len(open_)
                enter(tag)
            else:
                counts = tag in MAIN and not skip
                enter(tag, counts, attributes)
                found = found or counts
    if at < len(page):
        held.append(page[at:])
    flush()
    return main, [t for _, t in outside] if found else [t for s, t in outside if not s], found


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def lengths(n: int, repeat: int) -> list[int]:
    """The prefix lengths, in tokens, at which a block of ``n`` tokens is compared with others."""
    out = []
    at = repeat
    while at < n:
        out.append(at)
        at += max(1, at // 4)
    return [*out, n]


def prefix_marks(tokens: list[str], repeat: int) -> list[int]:
    """A hash of 32 bits of each of the prefixes; equal by chance, they add a few tokens to what a slot shares."""
    out, start, crc = [], 0, 0
    for end in lengths(len(tokens), repeat):
        crc = zlib.crc32(f"{' '.join(tokens[start:end])} ".encode("utf-8", "surrogatepass"), crc)
        out.append(crc - 2**31)
        start = end
    return out


def _batches(rows, schema):
    """Arrow batches of at most ``ROWS`` of the rows; no rows, one empty batch."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _rows(batch, *names):
    return zip(*(batch.column(c).to_pylist() for c in names), strict=True)


_BLOCKS = "host string, slot string, block string, marks array<int>, article long, tokens long, row long, needed boolean"
_BLOCKS_ARROW = pa.schema([
    ("host", pa.string()), ("slot", pa.string()), ("block", pa.string()), ("marks", pa.list_(pa.int32())), ("article", pa.int64()),
    ("tokens", pa.int64()), ("row", pa.int64()), ("needed", pa.bool_()),
])


def _evidence(repeat: int):
    def of_page(host: str, page: str, row: int):
        main, outside, found = page_parts(page)
        for text in dict.fromkeys(outside):
            yield host, None, text, None, None, 0, row, not found
        if not main:
            return
        article = _hash(" ".join(text for _, text in main))  # pages with equal articles are one page
        size: Counter = Counter()
        for slot, text in dict.fromkeys(main):
            tokens = text.split(" ")
            yield host, slot, None, prefix_marks(tokens, repeat), None, len(tokens), article, False
            size[slot] += len(tokens)
        for slot, n in [*size.items(), ("", size.total())]:
            yield host, slot, None, None, article, n, article, False

    def run(batches):
        for batch in batches:
            yield from _batches((r for page in _rows(batch, "host", "html", "row") for r in of_page(page[0], page[1] or "", page[2])), _BLOCKS_ARROW)

    return run


def evidence(pages: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """What a host's pages (host, html) hold, each once with the least and greatest page that has it: the blocks outside
    articles (``block``), those of articles (``slot``, ``marks``) and, by article, how many tokens a slot has (``article``;
    slot "": all). Written once."""
    made = pages.select("host", "html", F.monotonically_increasing_id().alias("row")).mapInArrow(_evidence(repeat), _BLOCKS)
    # equal blocks are merged first, so a menu that a whole host shares is one row
    merged = made.groupBy("host", "slot", "block", "marks", "article", "tokens").agg(
        F.min("row").alias("lo"), F.max("row").alias("hi"), F.max("needed").alias("needed")
    )
    return materialize(merged.withColumn("id", F.monotonically_increasing_id()), "blocks")


_SUFFIXES = pa.schema([
    ("host", pa.string()), ("suffix", pa.string()), ("id", pa.int64()), ("at", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("needed", pa.bool_()),
])
_STARTS = pa.schema([("id", pa.int64()), ("at", pa.int32())])
_GAINS = pa.schema([("host", pa.string()), ("slot", pa.string()), ("covered", pa.int64())])


def _suffixes(repeat: int):
    def of_block(host, block, *more):
        tokens = block.split(" ")
        for at in range(max(1, len(tokens) - repeat + 1)):
            yield host, " ".join(tokens[at : at + repeat]), more[0], at, *more[1:]

    def run(batches):
        for batch in batches:
            yield from _batches((r for b in _rows(batch, "host", "block", "id", "lo", "hi", "needed") for r in of_block(*b)), _SUFFIXES)

    return run


def _repeated(batches):
    """Suffixes, in order, whose first tokens occur on two pages at least. Holds the suffixes of one page at most."""
    key, first, last, held = None, 0, 0, []
    for batch in batches:
        out = []
        for host, suffix, block, at, lo, hi, needed in _rows(batch, *_SUFFIXES.names):
            if (host, suffix) != key:
                key, first, last, held = (host, suffix), lo, hi, []
            first, last = min(first, lo), max(last, hi)
            if needed:
                held.append((block, at))
            if first < last:
                out += held
                held = []
        yield _batch(out, _STARTS)


def _prefixes(repeat: int):
    """Blocks in order of their marks: the tokens that each prefix shared with another article adds to the block's common prefix.

    Open prefixes are a stack, each with its least and greatest article; it holds the blocks of one article at most.
    """

    def run(batches):
        before: tuple = (None, [])
        stack: list[list] = []  # least article, greatest, blocks that wait for another article
        for batch in batches:
            out: list[tuple] = []
            for host, slot, marks, tokens, lo, hi in _rows(batch, "host", "slot", "marks", "tokens", "lo", "hi"):
                same = 0
                if host == before[0]:
                    while same < min(len(marks), len(before[1])) and marks[same] == before[1][same]:
                        same += 1
                before = (host, marks)
                stack = stack[:same] + [[lo, hi, []] for _ in marks[same:]]
                ends = lengths(tokens, repeat)
                for open_, start, end in zip(stack, [0, *ends], ends, strict=False):
                    open_[0], open_[1] = min(open_[0], lo), max(open_[1], hi)
                    open_[2].append((host, slot, end - start))
                    if open_[0] < open_[1]:
                        out += open_[2]
                        open_[2] = []
            yield _batch(out, _GAINS)

    return run


def unique_runs(block: str, covered: list[int], repeat: int) -> str:
    """The tokens of ``block`` outside the repeated stretches that start at ``covered``."""
    tokens = block.split(" ")
    gone = {k for at in covered for k in range(at, at + repeat)}
    return " ".join(t for k, t in enumerate(tokens) if k not in gone)


def boilerplate(blocks: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """(host, block, starts) of :func:`evidence`: where the visible blocks outside articles have tokens that distinct pages share.

    Only blocks of pages without an article are listed; all pages of the host count as evidence.
    """
    outside = blocks.where("slot IS NULL")
    suffixes = outside.mapInArrow(_suffixes(repeat), "host string, suffix string, id long, at int, lo long, hi long, needed boolean")
    order = ["host", "suffix"]
    ordered = suffixes.repartitionByRange(shuffle_partitions(blocks.sparkSession), *order).sortWithinPartitions(*order, "id", "at")
    covered = ordered.mapInArrow(_repeated, "id long, at int")
    starts = covered.groupBy("id").agg(F.collect_list("at").alias("starts"))
    return outside.where("needed").select("id", "host", "block").join(starts, "id").drop("id")


def repeated_slots(blocks: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """(host, slot) of :func:`evidence`: slots of a host's articles that the suffix array finds repeated in most of their tokens.

    Equal blocks count once, equal articles too. A slot counts if half of the host's articles, ``FEW`` at least, have it, and if it is
    no heading and not the slot with most of the host's text.
    """
    starts = blocks.where("marks IS NOT NULL")
    order = ["host", F.get("marks", F.lit(0))]
    ordered = starts.select("host", "slot", "marks", "tokens", "lo", "hi").repartitionByRange(shuffle_partitions(blocks.sparkSession), *order)
    covered = ordered.sortWithinPartitions("host", "marks").mapInArrow(_prefixes(repeat), "host string, slot string, covered long")
    none = F.lit(0).cast("long")
    held = blocks.where("article IS NOT NULL").select("host", "slot", F.col("tokens").alias("size"), F.lit(1).cast("long").alias("articles"), none.alias("tokens"), none.alias("covered"))
    own = starts.select("host", "slot", none.alias("size"), none.alias("articles"), "tokens", none.alias("covered"))
    found = covered.select("host", "slot", none.alias("size"), none.alias("articles"), none.alias("tokens"), "covered")
    slots = held.unionByName(own).unionByName(found).groupBy("host", "slot").agg(*[F.sum(c).alias(c) for c in ("size", "articles", "tokens", "covered")])
    slots = materialize(slots, "slots")
    all_ = F.col("slot") == ""
    hosts = slots.groupBy("host").agg(F.max(F.when(all_, F.col("articles"))).alias("_all"), F.max(F.when(~all_, F.col("size"))).alias("_most"))
    kept = slots.where(~all_ & ~F.col("slot").rlike(r"(^|/)h[1-6](\.[^/]*)?$")).join(hosts, "host")
    return kept.where(f"_all >= {FEW} AND 2 * articles >= _all AND 2 * covered > tokens AND size < _most").select("host", "slot")


def _articles(batches):
    for batch in batches:
        parsed = [page_parts(h or "") for h in batch.column("html").to_pylist()]
        gone = [set(g or ()) for g in batch.column("gone").to_pylist()]
        text = [" ".join(t for slot, t in m if slot not in g) if found else None for (m, _, found), g in zip(parsed, gone, strict=True)]
        yield pa.record_batch(
            {
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "host": batch.column("host"),
                "text": pa.array(text, pa.string()),
                "outside": pa.array([None if found else o for _, o, found in parsed], pa.list_(pa.string())),
            }
        )


def main_text(pages: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars (code points).

    Null and empty html give an empty text. Unclosed elements end with their
    parent or the page, or where HTML implies it (p, li, table cells and the like); stray "<" is text. Rows may repeat; a repeated row is a page of
    its own for the suffix array, so without an article its text is boilerplate; equal articles are one page there.
    Null urls share the host "". Other columns are not read. No rows, no rows.
    """
    prepare(pages.sparkSession)
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of("url").alias("host"))
    blocks = evidence(src, repeat)
    # written, so the planner knows its size: pages are not shuffled for it as long as it can be broadcast
    gone = materialize(repeated_slots(blocks, repeat).groupBy("host").agg(F.collect_list("slot").alias("gone")), "gone")
    kind = "page_id long, url string, host string, text string, outside array<string>"
    whole = src.join(gone, "host", "left").select("page_id", "url", "html", "host", "gone").mapInArrow(_articles, kind)
    whole = whole.where("text IS NOT NULL").select("page_id", "url", "text")
    made = src.withColumn("gone", F.lit(None).cast("array<string>")).mapInArrow(_articles, kind)
    # pages without an article: their blocks, cut by the host's repeats, put together again
    bare = materialize(made.where("text IS NULL").withColumn("row", F.monotonically_increasing_id()), "bare")
    parts = bare.select("row", "host", F.posexplode("outside").alias("k", "block"))
    cut = parts.join(boilerplate(blocks, repeat), ["host", "block"], "left").select("row", "k", "block", "starts")

    def runs(batches):
        for batch in batches:
            text = [
                unique_runs(b, s or [], repeat)
                for b, s in zip(batch.column("block").to_pylist(), batch.column("starts").to_pylist(), strict=True)
            ]
            yield pa.record_batch([batch.column("row"), batch.column("k"), pa.array(text, pa.string())], names=["row", "k", "part"])

    kept = cut.mapInArrow(runs, "row long, k int, part string").where("part <> ''")
    joined = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "part"))).alias("p"))
    joined = joined.select("row", F.array_join("p.part", " ").alias("joined"))
    rest = bare.join(joined, "row", "left").select("page_id", "url", F.coalesce("joined", F.lit("")).alias("text"))
    out = whole.unionByName(rest)
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
