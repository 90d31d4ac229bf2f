import html
import re

import duckdb

import brute
from barflow.llm import htmltext
from barflow.llm.queries import QUERIES

PAGE = """<html><head><title>x</title></head><body class="home page-12"><header><a href="/">Site</a><h1>Brand</h1></header>
<div class="cookie-notice"><p>We use cookies, and more cookies, for a long, long, long text about consent and such.</p></div>
<ul class="menu"><li><a href=1>one<li><a href=2>two</ul><div class="wrap"><div class="post-55 content">
<div class="entry-header"><h2>Title &amp; more</h2><span>by me</span></div><p>First <b>para</b>graph with&nbsp;text<br>and
more. <p>Second&#33; <script>x="</p>"</script>para.<ul><li>a<li>b</ul><table><tr><td>c1<td>c2</table>
<div class="ad-box">Buy!</div><blockquote>Quote</blockquote><form><label>Name</label><input></form></div>
<div class="sidebar"><p>side side side</p></div><section id="comments"><p>Reader comment, very very very very very very
very long, longer than the article itself and so on and on and on, for ever and ever.</p></section></div>
<footer>&copy; x</footer></body></html>"""
TEXT = "Title & more\nFirst paragraph with text and more.\nSecond! para.\na\nb\nc1\nc2\nQuote"


def test_a_page_of_many_parts():
    assert htmltext.main_text(PAGE, None) == TEXT


def test_query_gives_the_articles(spark):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{brute.SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in QUERIES["op2_main_text"](spark, brute.SF).collect()}
    assert len(got) == len(pages)
    for page_id, source in pages:
        article = source.split("<article>")[1].split("</article>")[0]
        parts = [re.sub(r"<[^>]*>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(html.unescape(p).split()) for p in parts]
        want = "\n".join(b for b in blocks if b)
        assert got[page_id]["text"] == want and got[page_id]["n_chars"] == len(want)


def host_page(article, box="A box of unmarked text that is rather long, on every page of the host, again and again."):
    return f"<body><div class='x1'><p>{box}</p></div><div class='story s{len(article)}'><p>{article}</p></div></body>"


def test_odd_pages_follow_their_host(spark):
    rows = [(i, f"http://Host.example:80/p{i}", host_page("A long story of this page. " * 8 + str(i))) for i in range(20)]
    rows += [(90, "http://host.example/short", host_page("Short.")), (91, "http://other.example/", "<p>Alone here</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in htmltext.extract(df).collect()}
    assert got[90] == "Short." and got[91] == "Alone here" and got[3].endswith("3")
    paths = {r["host"]: r["paths"] for r in htmltext.host_paths(df).collect()}
    assert paths["host.example"][0] == "/div.s#.story"


def test_edges(spark):
    rows = [(1, None, None, 1), (2, "x", "", 2), (3, "http://h/x", "<p>hi", 3), (3, "http://h/x", "<p>hi", 3), (None, "http://h/y", "&amp;lt; <", 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = htmltext.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["text"]) for r in got.collect()) == [(0, "&lt; <"), (1, ""), (2, ""), (3, "hi"), (3, "hi")]
    assert htmltext.extract(df.limit(0)).count() == 0
    long = "<div><p>" + "many words " * 50_000 + "</p></div>"
    assert len(htmltext.main_text(long, None)) == 550_000 - 1
    assert htmltext.main_text("<script>never closed <p>x", None) == ""
    assert htmltext.main_text("<div><b>a</div></b>c</p><p>d<!-- e", None).split("\n")[0] == "a"


def test_wrappers_named_after_their_parts_keep_the_article():
    story = "A story of this page, with a good many words. " * 6
    side = "<div class='sidebar'><p>side words</p></div>"
    for tag in ("article", "main", "div"):
        for start in ("<div class='layout has-sidebar'>", "<div class='content-sidebar-wrap'>", "<div class='page with-banner'>",
                      "<div id='post-with-comments'>", "<div class='sidebar-layout'>", "<div class=noSidebar>"):
            page = f"<body>{start}<{tag}><p>{story}</p></{tag}>{side}</div><footer>f</footer></body>"
            assert htmltext.main_text(page, None) == story.strip(), (tag, start)
    page = f"<body><div class='overlay'><article><p>{story} <span class='ad'>Buy</span></p></article>{side}</div></body>"
    assert htmltext.main_text(page, None) == story.strip()
    page = f"<body><div class='overlay'><h1>Title</h1><p>{story}</p></div></body>"
    assert htmltext.main_text(page, None) == "Title\n" + story.strip()


def test_pages_in_one_form_keep_their_article():
    story, login = "A story of this page, with a good many words. " * 6, "<form class='login'><label>Name</label><input><p>Enter it.</p></form>"
    nav = "<nav><a>Home</a></nav><div class='sidebar'><p>side words</p></div>"
    for start, end in (("<form id='aspnetForm'>", "</form>"), ("<div role='form'>", "</div>"), ("<dialog open>", "</dialog>")):
        for body in (f"<article><p>{story}</p></article>", f"<div><p>{story}</p></div>", f"<h1>Title</h1><div>{story}</div>"):
            page = f"<html><body>{start}{nav}{body}<button>Send</button>{end}</body></html>"
            title = "Title\n" if "h1" in body else ""
            assert htmltext.main_text(page, None) == title + story.strip(), (start, body)
    # a form beside the article goes, and so does one in it
    for page in (f"<body>{login}<div><p>{story}</p></div></body>", f"<body><article><p>{story}</p>{login}</article></body>"):
        assert htmltext.main_text(page, None) == story.strip()


def test_formulas_are_text():
    formula = "<math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi></mrow><annotation encoding='application/x-tex'>E=m</annotation></semantics></math>"
    assert htmltext.main_text(f"<body><p>The energy is {formula} as shown</p></body>", None) == "The energy is E=m as shown"


def test_named_parts_beside_or_in_the_article_still_go():
    story, more = "A story of this page, with words. " * 6, "Another story to be read next. " * 4
    card = f"<div class='related'><article><p>{more}</p></article></div>"
    replies = f"<section id='comments'><article class='comment-body'><p>{more * 4}</p></article></section>"
    for page in (f"<body><article><p>{story}</p>{replies}</article>{card}</body>", f"<body><div class='post'><p>{story}</p></div>{card}{replies}</body>"):
        assert htmltext.main_text(page, None) == story.strip()


def test_quotes_that_do_not_close():
    text = lambda html: htmltext.main_text(html, None)
    assert text('<p title="a>Hello</p><p>there</p>') == "Hello\nthere"
    assert text('<p title="a>b">Hello</p><p class=it\'s>there isn\'t</p>') == "Hello\nthere isn't"
    assert text("<p>a < b and b <c") == "a < b and b <c"
    assert text("<p>a <!-- x > y --> b</p><!-- open <p>c</p>") == "a b"


def test_a_megabyte_of_anything_takes_linear_time():
    import time

    prose = "<p>" + "Some running text, at the end of the page. " * 5 + "</p>"
    pieces = ['<a "', '<a b="x" ', '<a b=">" ', "<a b='\"", "<div>", "<div>text", "<div class=some-name><p>t</p>", "</x", "<!", "<p>x"]
    for piece in pieces:
        start = time.time()
        htmltext.main_text(piece * (1_000_000 // len(piece)) + prose, ["/div.some-name"])
        assert time.time() - start < 15, piece
