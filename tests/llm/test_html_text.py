from almacen.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site head</header><nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- c > --><div class="ad">Buy</div>
<article><header><h1>Big &lt;Title&gt;</h1></header><p><b>Bold</b>er &eacute;&#233;&nbsp;x<br>line  two<p>Second
 para</p><aside>side</aside><div class="comments"><article>reader</article> said</div><form>f<input></form><p>a < b &amp; c</p>
<p>in<em>lin</em>e <span class="ad-box">advert <span>deep</span></span>rest</p></article><footer>&copy; foot</footer></body></html>"""


def test_article():
    main, _, found = html_text.page_blocks(PAGE)
    assert found
    assert " ".join(main) == "Big <Title> Bolder éé x line two Second para a < b & c inline rest"


def test_damaged_pages():
    text = lambda p: " ".join(html_text.page_blocks(p)[0])
    assert text("<nav>menu<article><p>one<p>two") == "one two"
    assert text("<article>one<footer>foot") == "one"
    assert text("<article>one</article><article>two</article>x") == "one two"
    assert text('<article class="ad"><p title="a>b">q</article>') == "q"
    assert text("<main>" + "<div>" * 3000 + "deep" + "<p") == "deep"
    assert text("<article>" + "<b " * 20_000) is not None
    assert text("") == "" and text("<article></article>") == ""


def test_omitted_end_tags_and_names():
    text = lambda p: " ".join(html_text.page_blocks(p)[0])
    assert text('<article><p class="promo">Buy<p>Real one</p><p>Real two</p></article><article>next</article>') == "Real one Real two next"
    assert text('<article><ul><li class="ad">Buy<li>one<li>two</ul><p>three</article>') == "one two three"
    assert text('<article><div><span class="ad">Buy</div>one<div><p class="share">x</div>two</article>') == "one two"
    assert text('<article><table><tr><td class="ad">Buy<td>one<tr class="promo"><td>x<tr><td>two</table>three') == "one two three"
    assert text('<article>one<p class="promo">Buy</article>') == "one"
    assert text('<article>one<div class="ad"><ul><li>a<li>b</ul><p>c</div>two</p></div>three</article>') == "one two three"
    assert text('<article><h2 id="social-history">Social</h2><section id="related-work">work</section><p class="share-price">up</p></article>') == (
        "Social work up"
    )
    assert text('<article>a<div class="comments">b</div><section id="related">c</section><div class="x ad-slot">d</div>e</article>') == "a e"


def test_comments_and_notices_inside_articles():
    text = lambda p: " ".join(html_text.page_blocks(p)[0])
    for name in ("reader-comments", "post-comments", "cookie-notice", "newsletter-signup", "comment_list", "social-share", "x cookie-banner"):
        assert text(f'<article><p>a</p><div class="{name}"><p>gone</p></div><p>b</p></article>') == "a b", name
    for name in ("cookie-recipe", "market-share", "share-price", "social-history", "noticeable", "commentary"):
        assert text(f'<article><p>a</p><div class="{name}"><p>stays</p></div></article>') == "a stays", name


def test_pages(spark):
    same = "Welcome to our little site of many things"
    rows = [
        (1, "http://h.example/1", PAGE),
        (2, "http://h.example/2", f"<body><p>{same}</p><p>Unique words of page two only here</p></body>"),
        (3, "http://h.example/3", f"<body><p>{same} today</p><p>Other words that page three alone holds</p></body>"),
        (4, "http://other.example/", f"<p>{same}</p>"),
        (5, None, None), (6, "", ""), (7, "http://h.example/7", "<article><p>" + same + "</p></article>"),
        (8, "http://H.example:80/8", "<div>© h.example all rights are kept forever</div><p>eight</p>"),
        (9, "http://h.example/9", "<article>nine</article><div>© h.example all rights are kept forever</div>"),
        (None, "http://n.example", "<article>null id</article>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "'y' AS host", "1 AS row")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.main_text(df).collect()}
    want = {
        1: "Big <Title> Bolder éé x line two Second para a < b & c inline rest", 2: "Unique words of page two only here",
        3: "today Other words that page three alone holds", 4: same, 5: "", 6: "", 7: same, 8: "eight", 9: "nine", None: "null id",
    }
    assert got == {k: (v, len(v)) for k, v in want.items()}
    assert html_text.main_text(df.limit(0)).count() == 0


def test_repeats_equal_brute_force(spark):
    import random

    rnd = random.Random(2)
    pages = [[" ".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 16))) for _ in range(3)] for _ in range(40)]
    rows = [(i, f"http://h{i % 2}.x/", "".join(f"<p>{b}</p>" for b in p)) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    size = html_text.REPEAT
    for i, p in enumerate(pages):
        grams = lambda b: [tuple(b.split()[k : k + size]) for k in range(max(1, len(b.split()) - size + 1))]
        others = {g for j, q in enumerate(pages) if j != i and j % 2 == i % 2 for b in q for g in grams(b)}
        left = []
        for b in p:
            gone = {k + d for k, g in enumerate(grams(b)) if g in others for d in range(size)}
            left += [w for k, w in enumerate(b.split()) if k not in gone]
        assert got[i] == " ".join(left), i


def test_slots_that_a_host_repeats_inside_articles(spark):
    import random

    rnd = random.Random(5)
    words = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    shared = words(30)
    rows, want = [], {}
    for i in range(6):
        own, item = words(40), words(9)
        more = f"Our little paper asks all its friends to tell others {words(2)}"
        body = f"<h1>The same title on every page of it</h1><p>{own}</p><p>{shared}</p><ul><li>{item}</ul>"
        rows.append((i, "http://h.x/", f'<article class="post-{i}">{body}<div class="x{i}">{more}</div></article>'))
        want[i] = f"The same title on every page of it {own} {shared} {item}"
    # the same text on a host where too few articles have the slot, and one article under many addresses
    rows += [(10 + i, "http://few.x/", f"<article><p>{words(20)}</p><div>{more}</div></article>") for i in range(2)]
    rows += [(20 + i, "http://copies.x/", f"<article><p>{shared}</p><div>{more}</div></article>") for i in range(6)]
    rows += [(30 + i, "http://rare.x/", f"<article><p>{words(20)}</p>{'<div>' + more + '</div>' if i < 2 else ''}</article>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for i, _, page in rows[6:]:
        want[i] = " ".join(html_text.page_blocks(page)[0])
    assert {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()} == want


def test_common_prefixes_equal_brute_force(spark):
    import random

    rnd = random.Random(3)
    pages = [[" ".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 40))) for _ in range(4)] for _ in range(30)]
    rows = [(f"h{i % 2}", "<article>" + "".join(f"<p>{b}</p>" for b in p) + "</article>") for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "host string, html string")
    blocks = html_text.evidence(df).where("marks IS NOT NULL")
    order = blocks.select("host", "slot", "marks", "tokens", "lo", "hi").coalesce(1).sortWithinPartitions("host", "marks")
    run = order.mapInArrow(html_text._prefixes(html_text.REPEAT), "host string, slot string, covered long")
    got = {r["host"]: r["n"] for r in run.groupBy("host").sum("covered").toDF("host", "n").collect()}
    for h in (0, 1):
        mine = pages[h::2]
        total = 0
        for b in {b for p in mine for b in p}:
            t, best = b.split(), 0
            for n in html_text.lengths(len(t), html_text.REPEAT):
                holders = {i for i, p in enumerate(mine) for o in p if o.split()[:n] == t[:n] and n in html_text.lengths(len(o.split()), html_text.REPEAT)}
                best = n if len(holders) > 1 else best
            total += best
        assert got[f"h{h}"] == total


def test_suffixes_of_a_long_block_carry_no_text(spark):
    block = " ".join(f"w{i}" for i in range(150_000))  # over 1 MB
    df = spark.createDataFrame([(1, "http://h.x/1", f"<p>{block}</p>"), (2, "http://h.x/2", "<p>a</p>")], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert got == {1: block, 2: "a"}
