"""Main text of pages: markup as given, the tree, hostile pages."""

import html
import re
import time

import pytest
from conftest import SF0001

from tripaudit.llm.htmltext import (
    classify,
    extract,
    grow,
    labelled_rows,
    main_text,
    op1_html_blocks,
    read_blocks,
)


@pytest.fixture(scope="module")
def tree():
    return grow(*labelled_rows())


def test_tree_fits_its_table(tree):
    x, y = labelled_rows()
    assert classify(tree, x) == [bool(v) for v in y]


LONG = "word " * 40


def page(body):
    return f"<!doctype html><html><head><title>t</title></head><body>{body}</body></html>"


@pytest.mark.parametrize(("body", "want"), [
    ("<nav><a href=/>x</a></nav><article><h1>T</h1><p>one<p>two</article><footer>f</footer>", "T\none\ntwo"),
    ("<article><p>a &amp; b &lt;i&gt; &#65;&nbsp;c<br>d</p></article>", "a & b <i> A c d"),
    ("<article><p>a <b>bold</b> <i>it</i><!-- no --><script>x()</script>alic</p></article>", "a bold italic"),
    (f"<main><p>{LONG}</p><div class='comments'><p>{LONG}</p></div></main>", LONG.strip()),
    (f"<article><header><h1>Head</h1></header><p>{LONG}</p><aside>side</aside></article>", f"Head\n{LONG.strip()}"),
    (f"<header>Site</header><article><p>{LONG}</p><div id=cookie-notice>c</div></article>", LONG.strip()),
    (f"<article><p>{LONG}</p><form>mail <input></form><section id='comments'><p>me too</p></section></article>", LONG.strip()),
    (f"<article><p>x</p><p class='ad sponsored'>Buy</p><p>{LONG}</p></article>", f"x\n{LONG.strip()}"),
    (f"<article><p>a <button>Share</button> b</p><p hidden>h</p><p style='display: none'>h</p></article>", "a b"),
    ("<article><ul><li>one<li><a href=x>two</a></ul><table><tr><td>c1<td>c2</table></article>", "one\ntwo\nc1\nc2"),
    (f"<div id=menu><a href=a>one</a></div><div><h1>Title</h1><p>{LONG}</p><p>{LONG}</p></div><div class=footer>f</div>",
     f"Title\n{LONG.strip()}\n{LONG.strip()}"),
    (f"<a href=1>a</a><br><p><a href=2>b</a></p><p><a href=3>c</a></p><p>{LONG}</p><p>{LONG}</p><p><a href=4>d</a></p>",
     f"{LONG.strip()}\n{LONG.strip()}"),
    ("<article><p>cut off", "cut off"),
    ("<nav>only</nav>", ""),
    ("", ""),
])
def test_pages(tree, body, want):
    assert main_text(page(body), tree) == want


HOSTILE = ["<", "<a", "<" * 100_000, '<a "' * 50_000, "<!--" * 50_000, "<div>" * 50_000 + "x" + "</p>" * 50_000,
           "<p>" * 100_000, "<script>" * 50_000, "</div>" * 50_000, '<b class="ad">' * 20_000 + "x", "&" * 100_000,
           "<article>" + "<p>w</p>" * 50_000, "<a href='" * 30_000, "<p x=" * 30_000]


@pytest.mark.parametrize("case", range(len(HOSTILE)))
def test_hostile_pages_take_linear_time(tree, case):
    began = time.time()
    main_text(HOSTILE[case], tree)
    assert time.time() - began < 8


def test_null_repeated_and_clashing_rows(spark):
    rows = [(1, "u", None, "x"), (2, "u", "<article><p>t</article>", "x"), (2, "u", "<article><p>t</article>", "x"),
            (None, None, "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "", 0), (1, "", 0), (2, "t", 1), (2, "t", 1)]
    assert extract(pages.limit(0)).count() == 0


def test_query_gives_the_article_of_every_page(spark):
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()}
    rows = op1_html_blocks(spark, SF0001).collect()
    assert len(rows) == len(source)
    for r in rows:
        body = re.search("<article>(.*?)</article>", source[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text)


def test_blocks_carry_link_words():
    got = read_blocks("<p>a <a href=x>b c</a> d</p><p><a name=x>e</a></p>")
    assert [(b.text, b.words, b.linked) for b in got] == [("a b c d", 4, 2), ("e", 1, 0)]


ARTICLE = f"<h1>T</h1><p>{LONG}</p><p>{LONG}</p>"


@pytest.mark.parametrize("body", [
    f"<div class='content-sidebar-wrap'><article>{ARTICLE}</article><div class=sidebar>{LONG}</div></div>",
    f"<div class='has-sidebar'><main>{ARTICLE}<div class='comments'><article>{LONG * 9}</article></div></main></div>",
    f"<main class='search-results'>{ARTICLE}</main><div class=footer>{LONG}</div>",
    f"<main><p class=widget>x</p><article class='post comments-open'>{ARTICLE}<ol class=commentlist><li>{LONG}</ol></article></main>",
    f"<div class=menu><a href=x>a</a></div><div id='privacy'>{ARTICLE}</div><div class=footer>f</div>",
    f"<div class='has-sidebar'><div class='with-ads'>{ARTICLE}</div><div class='widget'>{LONG}</div></div>",
    f"<article><a class=share href=x>Share</a>{ARTICLE}</article>",
    f"<span class='page-overlay'><div><article>{ARTICLE}</article></div></span>",
])
def test_wrappers_named_like_boilerplate_keep_the_article(tree, body):
    assert main_text(page(body), tree) == f"T\n{LONG.strip()}\n{LONG.strip()}"


@pytest.mark.parametrize("body", [
    f"<article>{ARTICLE}</article><div class='comments'><article class=comment>{LONG * 9}</article></div>",
    f"<article>{ARTICLE}<p>a <span class='ad'>Buy</span></p></article><div class='related-posts'><article>{LONG}</article></div>",
])
def test_marked_articles_beside_the_article_stay_out(tree, body):
    assert main_text(page(body), tree).startswith(f"T\n{LONG.strip()}\n{LONG.strip()}")
    assert main_text(page(body), tree).count("word") == 80


def test_deep_named_elements_take_linear_time(tree):
    began = time.time()
    main_text("<div class='has-sidebar'>" * 50_000 + "x", tree)
    main_text("<div class='has-sidebar'><p>w</p>" * 30_000 + "</div><i class=ad>" * 30_000, tree)
    assert time.time() - began < 8
