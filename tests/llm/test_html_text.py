import html
import re

import pytest

from orrery.llm.html_text import extract_main_text, main_text
from orrery.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

PAGE = """<!doctype html><html><head><title>T</title><style>p{a:b}</style></head><body>
<header class="site">Site name and slogan of a rather long kind, longer than any threshold that there may be in it</header>
<nav><ul><li><a href=/>Home</a></li></ul></nav><script>if (a < b) document.write("<p>no</p>");</script>
<div class="cookie-notice">We use cookies and say so at great length, over and over, as all the others do as well here.</div>
<article><h1>A &amp; B</h1><p>First   para&shy;graph with <b>bold</b>text &#8212; &copy; and
line break.<br>More.</p><div class=ad>Buy!</div><p>Ok.<p>Unclosed <i>one</i></article>
<aside>Side</aside><form>Mail <input name=x> <button>Go</button></form>
<section id="comments"><article><p>Reader says a lot of things that are long enough to be taken for text by length alone.</p></article></section>
<footer>&copy; all of it</footer></body></html>"""


def test_article_without_furniture():
    assert main_text(PAGE) == "A & B First para\xadgraph with boldtext — \xa9 and line break. More. Ok. Unclosed one"


def test_without_marked_article_the_line_blocks_decide():
    body = "".join(f"<p>{'word ' * 30}{i}</p>" for i in range(3))
    page = f"<body><div><a href=x>link one</a> <a href=y>link two</a></div><hr><div class=menu>x</div>{body}<p>end.</p><div class=sidebar>y</div><div>tail</div></body>"
    assert main_text(page) == " ".join(f"{('word ' * 30)}{i}" for i in range(3)) + " end."


LONG = "word " * 30 + "end."


@pytest.mark.parametrize("page,want", [
    (f"<article><h1><a href=x>Title</a></h1><p>{LONG}</p><ul><li><a href=y>one</a><li>two</ul><p><a href=z>more</a></p></article>", f"Title {LONG} one two more"),
    (f"<h1>Title</h1><div class=share>Share!</div><p>{LONG}</p>", f"Title {LONG}"),
    (f"<h2><a href=x>Title</a></h2><nav>n</nav><p>{LONG}</p>", f"Title {LONG}"),
    (f"<p>{LONG}</p><div class=ad>Buy!</div><p>Short.</p><p><a href=x>link</a></p><aside>s</aside><p>{LONG}</p>", f"{LONG} Short. link {LONG}"),
    (f"<article class='has-sidebar'><p>{LONG}</p></article><p>out</p>", LONG),
    (f"<article class='sponsored'><p>{LONG}</p></article><p>out</p>", LONG),
    (f"<div class='header'><p>site</p><article><p>{LONG}</p></article></div>", LONG),
    (f"<div class='post-header'><h1 class=banner>Title</h1></div><div class='no-comments'><p>{LONG}</p></div>", f"Title {LONG}"),
    (f"<article><p>{LONG}</p><div class='share-buttons'>Share!</div><div class='cookieNotice'>c</div></article><div class=related><article>{LONG} x</article></div>", LONG),
    (f"<article><p>{LONG}</p><article class='comment odd'>c</article></article>", LONG)])
def test_text_that_is_no_furniture_stays(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("attrs", [
    "class='user-comments'", "class='cookie-message'", "class=main-nav-list", "class='advert-large'", "id='related-stories'",
    "class='wide page-footer'", "class='left-rail'", "style='display: none'", "style=\"color:red;visibility:hidden\""])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_furniture_by_name_and_style(attrs, tag):
    page = f"<body><{tag}><h1>Title</h1><p>{LONG}</p><div {attrs}><p>{LONG} not this</p></div><p>{LONG}</p></{tag}></body>"
    assert main_text(page) == f"Title {LONG} {LONG}"


@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_menus_between_paragraphs(tag):
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Section {i}</a></li>" for i in range(4)) + "</ul>"
    row = "<div><a href=a>one</a> <a href=b>two</a> <a href=c>three</a></div>"
    page = f"<{tag}>{menu}<p>{LONG}</p>{menu}{row}<p>{LONG}</p><ul><li><a href=x>Linked</a> item</li><li><a href=y>other</a></ul><p>{LONG}</p></{tag}>"
    assert main_text(page) == f"{LONG} {LONG} Linked item other {LONG}"


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<p", "<!-- never closed", "<script>x", "<p></p><p> </p>", "<<<>>>" * 50 + "<a b=\"" * 100])
def test_odd_pages(page):
    assert isinstance(main_text(page), str)


def test_plain_and_short():
    assert main_text("<p>hi</p>") == "hi"
    assert main_text("a < b and c > d") == "a < b and c > d"
    assert len(main_text("<p>" + "x " * 500_000 + "</p>")) == 999_999


def test_query_against_the_article_element(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op1_html_text"](spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        body = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        body = re.sub(r"</?b>", "", body)
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())
        assert r.n_chars == len(r.text)


def test_query_pages_without_the_article_tag(spark):
    """The line blocks alone find what the article element holds in nearly all pages."""
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    same = [main_text(re.sub(r"</?article>", "", r.html)) == main_text(r.html) for r in rows]
    assert sum(same) >= 0.9 * len(same)


def test_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, None, "t"), (1, "", "t"), (1, "<p>a</p>", None), (1, "<p>a</p>", None)], "page_id long, html string, text string")
    rows = extract_main_text(df)
    assert rows.columns == ["page_id", "html", "text"]
    assert sorted(r.text for r in rows.collect()) == ["", "", "a", "a"]
    assert extract_main_text(df.limit(0)).count() == 0
