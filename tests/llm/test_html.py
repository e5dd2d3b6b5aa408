from tidemark.llm.html import extract, joined, parse, segments


def text(html):
    parts = segments(parse(html))
    return joined([t for t, _, _ in parts], [n for _, n, _ in parts])


def test_blocks_entities_and_broken_markup():
    page = (
        '<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/">menu</a></ul></nav>'
        '<!-- ad --><div class="ad">buy</div><article><h1>A &amp;  B&nbsp;C</h1><p><b>one<br>two<p>th<i>r</i>ee &lt;x&gt; &#233;'
        '<div class="comments">nice</div><form>name <input></form><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></article>'
        '<footer>&copy; h</footer>'
    )
    assert text(page) == "A & B C one two three <x> é x y 1 2"
    assert text(None) == text("") == text("<script>x") == ""
    assert text("no markup  at\nall") == "no markup at all"
    assert text("<body><header>logo</header><main><h2>M</h2></main><aside>s</aside></body>") == "M"
    assert text("<article><p>a</p></article><p>between</p><article>b") == "a b"
    assert text("<p>" * 3000 + "deep" + "<div>" * 3000 + "deeper") == "deep deeper"


def test_repeated_branches_of_a_host_go(spark):
    def page(i):
        share = '<div class="legalese"><p>All rights reserved.</p></div>'
        return f"<html><body>{share}<div class='story'><p>Story {i} tells of {i * 7}.</p><p>Same end.</p></div></body></html>"

    rows = [(i, f"http://a.org/{i}", page(i)) for i in range(12)] + [(100, "http://b.org/", page(100)), (101, None, page(101))]
    rows += [(200, "http://a.org/x", None), (None, "http://a.org/y", ""), (2**60 + 1, "http://c.org/", "<p>" + "w " * 100_000), (1, "http://a.org/1", page(1))]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS host", "1 AS removed", "2 AS text")
    got = [(r["page_id"], r["url"], r["text"]) for r in extract(table).collect()]
    assert len(got) == len(rows)
    by_id = {g[0]: g[2] for g in got}
    assert by_id[3] == "Story 3 tells of 21. Same end."
    assert by_id[100] == "All rights reserved. Story 100 tells of 700. Same end."
    assert by_id[101].startswith("All") and by_id[200] == by_id[None] == "" and len(by_id[2**60 + 1]) == 199_999
    assert extract(table.limit(0)).count() == 0


def test_articles_of_the_smallest_scale(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in extract(pages).collect():
        article = re.search("<article>(.*?)</article>", sources[r["page_id"]], re.S).group(1)
        parts = [" ".join(html.unescape(p).split()) for p in re.split("<[^>]*>", article)]
        assert r["text"] == " ".join(p for p in parts if p)


def texts_of(spark, pages):
    rows = [(i, f"http://site.example/{i}", html) for i, html in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return [r["text"] for r in extract(table).orderBy("page_id").collect()]


def test_links_in_paragraphs_stay(spark):
    said = [f"See <a href=x>the <b>report</b> {i}</a> of <i>May</i> {i}" for i in range(4)]
    menu = "<div><a href=y>home</a> <a href=z>shop</a></div>"
    want = [f"See the report {i} of May {i}" for i in range(4)]
    assert texts_of(spark, [f"<body>{menu}<article><p>{s}</p></article>" for s in said]) == want
    # without an article the menu goes as a block, and links in a paragraph stay
    assert texts_of(spark, [f"<body>{menu}<p>{s}</p>" for s in said]) == want


def test_copies_and_equal_headings_of_a_host_stay(spark):
    page = "<body><article><h2>Summary</h2><p>one</p></article>"
    assert texts_of(spark, [page] * 3) == ["Summary one"] * 3
    others = [page.replace("one", f"text {i}") for i in range(3)]
    assert texts_of(spark, [page] * 27 + others) == ["Summary one"] * 27 + [f"Summary text {i}" for i in range(3)]
    # the same without an article, where repeated notes go
    plain = [f"<body><p>story {min(i, 6)} of the day</p><div>All rights reserved</div>" for i in range(60)]
    assert texts_of(spark, plain) == [f"story {min(i, 6)} of the day" for i in range(60)]


def test_text_in_boxes_of_an_article_stays():
    assert text("<article><header><h1>Title</h1><p>Lead</p></header><p>Body</p></article>") == "Title Lead Body"
    assert text('<article><div class="article-header"><h1>Title</h1></div><p>Body</p></article>') == "Title Body"
    for name in ("social-science", "notice-board", "skip", "header", "form-results", "related", "search"):
        assert text(f'<article><p>a</p><div class="{name}">b</div></article>') == "a b", name
    assert text("<article><p>a</p><label>b</label> c</article>") == "a b c"
    for name in ("ad", "comments", "x comments", "sidebar", "newsletter"):
        assert text(f'<article><p>a</p><div class="{name}">b</div></article>') == "a", name
    for tag in ("form", "nav", "aside", "footer", "script"):
        assert text(f"<article><p>a</p><{tag}>b</{tag}></article>") == "a", tag


def test_names_outside_articles():
    for name in ("form-results", "social-science", "notice-board", "addition"):
        assert text(f'<body><p>a</p><div class="{name}">b</div>') == "a b", name
    for name in ("ad", "site-header", "main-nav", "x sidebar", "cookie-notice", "comment-list"):
        assert text(f'<body><p>a</p><div class="{name}">b</div>') == "a", name
    # after an article has ended, the rules for the page hold again
    assert text('<main><article>a</article><p>b</p></main><div class="header">c</div>') == "a"
    assert text('<div><main>a</main></div><header>c</header>') == "a"


def test_deep_pages(spark):
    rows = [(i, "http://deep.example/", "<div>" * 16_000 + f"text {i}") for i in range(3)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert sorted(r["text"] for r in extract(table).collect()) == ["text 0", "text 1", "text 2"]


def test_parsing_grows_with_the_depth_alone():
    import pandas as pd
    from tidemark.llm.html import _parsed

    page = pd.DataFrame({"page_id": [1], "url": ["u"], "host": ["h"], "html": ["<div>" * 100_000 + "x"]})
    (out,) = _parsed([page])
    assert list(out["texts"][0]) == ["x"] and len(out["around"][0][0]) == 100_000


def texts_without_tree(spark, pages):
    rows = [(i, f"http://site.example/{i}", html) for i, html in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return [r["text"] for r in extract(table, threshold=-1).orderBy("page_id").collect()]


def test_the_tree_judges_boxes_of_articles(spark):
    share = '<div class="share-box"><p>Tell <a href=x>others</a></p></div>'
    box = '<div class="article-header related"><h1>Title {i}</h1></div>'
    refs = '<div class="link-widgets"><ul><li><a href=x>source {i}</a></ul></div>'
    pages = [f"<body><article>{box}<h2 class=widget>Summary</h2><p>text {{i}}</p>{refs}{share}</article>".format(i=i) for i in range(4)]
    assert texts_of(spark, pages) == [f"Title {i} Summary text {i} source {i}" for i in range(4)]
    # of two pages nothing is known, and without the tree nothing goes
    assert texts_of(spark, pages[:2])[0] == texts_without_tree(spark, pages)[0] == "Title 0 Summary text 0 source 0 Tell others"


def test_the_tree_picks_the_main_branch(spark):
    card = '<article class="card"><p>Best of the site</p></article>'
    story = "<div><p>Story {i} is longer than what the <a href=x>site</a> says of itself.</p></div><div class=legal>All rights</div>"
    want = [f"Story {i} is longer than what the site says of itself." for i in range(4)]
    # a repeated article gives way to the text beside it, or to the other article
    pages = [f"<body>{card}{story}".format(i=i) for i in range(4)]
    assert texts_of(spark, pages) == want
    assert texts_without_tree(spark, pages) == ["Best of the site"] * 4
    assert texts_of(spark, [f"<body>{card}<article>{story}</article>".format(i=i) for i in range(4)]) == [w + " All rights" for w in want]
    assert texts_of(spark, [f"<main>{card}{story}</main><p>end {{i}}".format(i=i) for i in range(4)]) == [w + " All rights" for w in want]
    # a longer article stays, also where a host repeats it
    long = f"<article>{card * 9}</article>"
    assert texts_of(spark, [f"<body>{long}<p>note {i}" for i in range(4)]) == [" ".join(["Best of the site"] * 9)] * 4
    assert texts_of(spark, [f"<body><article></article><p>note {i}" for i in range(4)]) == [""] * 4
