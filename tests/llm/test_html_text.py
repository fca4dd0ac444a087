import html as entities
import re

import pytest

from tidemark.llm import html_text

TREE = html_text.trained()


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<p>", ""), ("plain text only, of a few words and then some more words of no page at all", None),
    ("<nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>T &amp; U</h1><p>One\n two&nbsp;three<br>four</p><p>Five.</p></article><footer>c</footer>",
     "T & U\n\nOne two three four\n\nFive."),
    ("<article><p>A <!-- x > <p> --> b<script>var t='</p>';</script><style>p{}</style> c</article>", "A b c"),
    ("<article><p>open <b>bold<p>next <i>more", "open bold\n\nnext more"),
    ("<article><p>kept</p><!-- never closed <p>gone</p>", "kept"),
    ("<article><p>kept</p><script>never closed", "kept"),
    ("<article><p>1 < 2 &lt; 3 &#228;&unknown; <3</p></article>", "1 < 2 < 3 ä&unknown; <3"),
    ("<main><p>text</p><aside>side</aside><form><input><button>Go</button></form><section class='reader-comments'><p>I say so too, at length.</p></section></main>", "text"),
    ("<article><p>text</p><div class='cookie-notice'>We use cookies.</div><div id='adBanner'>Buy!</div><p>end</p></article>", "text\n\nend"),
    ("<header><p>Site</p></header><article><header><h1>Title</h1></header><p>Body</p></article>", "Title\n\nBody"),
    ("<nav><ul><li><a href=x>Menu</a><article><p>Body text</p></article>", "Body text"),
    ("<ARTICLE><P hidden>no</P><P>Yes</P></ARTICLE>", "Yes"),
    ("<article><p>" + "word " * 30_000 + "</p></article>", ("word " * 30_000).strip()),
])
def test_pages(page, want):
    got = html_text.main_text(page or "", TREE)
    assert got == want if want is not None else isinstance(got, str)


LONG = "A paragraph of the article that goes on for a while, with words enough to be read and hardly a link. " * 3
ARTICLE = f"<h1>Title</h1><p>{LONG}</p><p>Yes.</p><p>{LONG}</p>"
WANT = "\n\n".join(["Title", LONG.strip(), "Yes.", LONG.strip()])
MENU = "<div class='menu'><ul>" + "<li><a href='/x'>Go there</a></li>" * 5 + "</ul></div>"
FOOT = "<footer><p>© 2024 <a href='/l'>Legal</a></p></footer>"


@pytest.mark.parametrize("page", [
    f"<div class='content has-sidebar'>{ARTICLE}</div>",
    f"<article class='post no-comments'>{ARTICLE}</article>",
    f"<article class='post tag-news tags-x'>{ARTICLE}</article>",
    f"<form action='/page.aspx'><input type=hidden><div id='main'>{ARTICLE}</div></form>",
    f"<main><div class='legal-notice-analysis'>{ARTICLE}</div></main>",
    f"<div class='page with-sidebar'><div class='sidebar'><p>{LONG}</p></div><article>{ARTICLE}</article></div>",
    f"<div id='search-results-page'><div class='wrapper'>{ARTICLE}</div></div>",
    f"<body class='single sidebar'><div class='layout no-menu'><main class='post'>{ARTICLE}<div class='post-comments'><p>{LONG}</p></div></main></div></body>",
    f"<article>{ARTICLE}<form><label>Name</label><input><label>Comment</label><textarea></textarea><p>Your mail stays with us.</p><button>Send</button></form></article>",
    f"<article>{ARTICLE}<section id='comment-list'><p>{LONG}</p></section><div class='related-posts'><article><p>{LONG}</p></article></div></article>",
])
def test_names_and_forms_around_an_article(page):
    assert html_text.main_text(f"<body>{MENU}{page}{FOOT}</body>", TREE) == WANT


def test_formulas_are_text():
    page = "<article><p>So <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>"
    assert html_text.main_text(page, TREE) == "So a=2 holds."


def test_densities_decide_without_names():
    """A page of plain div elements; and the tree asks for link density."""
    links = "<div>" + " ".join(f"<a href='/{k}'>News item number {k}</a>" for k in range(9)) + "</div>"
    page = f"{links}<div>{LONG}</div><div>{LONG} <a href='/x'>more</a></div>{links}"
    assert html_text.main_text(page, TREE) == f"{LONG.strip()}\n\n{LONG.strip()} more"

    def asked(tree):
        return set() if tree.feature < 0 else {html_text.FEATURES[tree.feature]} | asked(tree.low) | asked(tree.high)

    assert "link density" in asked(TREE) and len(asked(TREE) & {"words before", "words after", "words", "link density before", "link density after"}) > 0


def test_tree_learns_its_table():
    x, y = html_text.labelled()
    assert (TREE.predict(x) == y).all()


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {}
    for r in pages.collect():
        body = r["html"][r["html"].index("<article>") + 9 :]
        body = body[: body.index("</article>")] if "</article>" in body else body
        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)[^>]*>", body.replace("<br>", " "))]
        want[r["page_id"]] = "\n\n".join(p for p in parts if p)
    got = {r["page_id"]: r for r in html_text.extract(pages).collect()}
    assert {k: r["text"] for k, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_odd_rows(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "u", "<article><p>t</p></article>", "x"), (2, "u", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_text.extract(pages).collect())
    assert got == [(0, "t", 1), (1, "", 0), (1, "", 0), (2, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0
