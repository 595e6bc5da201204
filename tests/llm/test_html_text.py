"""Main text of pages by example, on the given pages, and on broken or hostile markup."""

from __future__ import annotations

import html
import re
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from retailstrata.llm.html_text import extract, main_text


def article(page: str) -> str:
    """The given pages hold one article of h1 and p elements."""
    inner = page.split("<article>", 1)[1].split("</article>", 1)[0]
    blocks = re.sub(r"<[^>]*>", "", re.sub("<br>", " ", re.sub("</?(h1|p)>", "\n", inner))).split("\n")
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_given_pages():
    pages = pq.read_table(f"{SF_DIR}/pages.parquet")["html"].to_pylist()
    assert [main_text(p) for p in pages] == [article(p) for p in pages]


TEXT = "Some words, and more of them, to make this a paragraph."


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("", ""),
        (None, ""),
        ("plain  text\n only", "plain text only"),
        ("<p>a &lt;b&gt; &amp;&nbsp;c &#233; &eacute", "a <b> & c é é"),
        (f"<div id=content><h2>T</h2>{TEXT}<br>x<p>{TEXT}</p>tail</div><div class=sidebar><p>{TEXT}</div>", f"T\n{TEXT} x\n{TEXT}\ntail"),
        (f"<article><h1>T</h1><div class=section><p>{TEXT}</p></div><div class=section><p>short</p></div></article>", f"T\n{TEXT}\nshort"),
        (f"<main><p>{TEXT}</p><form><p>{TEXT}</p></form><section class='related-posts'>{TEXT}</section></main>", TEXT),
        (f"<div class='post'><p>{TEXT}</p></div><div id='comments'><p>{TEXT}</p><p>{TEXT}</p></div>", TEXT),
        (f"<body><div role=navigation>{TEXT}</div><div hidden>{TEXT}</div><div style='display: none'>{TEXT}</div><p>x, y</p></body>", "x, y"),
        (f"<article><p>{TEXT}<script>var a='</p><p>no</p>'</script><style>p</style><!-- <p>no</p> --></p></article>", TEXT),
        ("<table><tr><td>x y, z<td>b</table>", "x y, z\nb"),
        (f"<p title='a > b'>{TEXT}</p>", TEXT),
        (f"<ul><li><a href=a>one</a><li><a href=b>two</a></ul><div><p>{TEXT}</p></div>", TEXT),
        ("a < b and c > d", "a < b and c > d"),
        ("<p>one<p>two<b>bold<p>three</b> four", "one\ntwobold\nthree four"),
    ],
)
def test_examples(page, expected):
    assert main_text(page) == expected


@pytest.mark.parametrize(
    "name",
    "comment-body comments-content post-comments main-menu text-ad ad-content cookie-text newsletter-body article-sidebar".split(),
)
def test_a_name_of_what_is_no_article_outweighs_others(name):
    assert main_text(f"<article><p>{TEXT}</p><div class='content {name}'><p>no, no, no</p></div></article>") == TEXT
    assert main_text(f"<div class='content'><p>{TEXT}</p><section id='{name}'><p>no, no, no</p></section></div>") == TEXT


@pytest.mark.parametrize("name", ["has-sidebar", "content with-sidebar", "post comments-open", "no-ads", "share-enabled", "story"])
def test_names_of_states_do_not_count(name):
    assert main_text(f"<div class='{name}'><p>{TEXT}</p><p>{TEXT}</p></div>") == f"{TEXT}\n{TEXT}"


def test_articles_inside_and_beside_others():
    comment = f"<article><p>{TEXT}</p><p>{TEXT}</p></article>"
    own = f"<p>{TEXT} 1</p><p>{TEXT} 2</p><p>{TEXT} 3</p>"
    kept = f"{TEXT} 1\n{TEXT} 2\n{TEXT} 3"
    assert main_text(f"<article><h1>T</h1>{own}{comment}</article>") == f"T\n{kept}"
    assert main_text(f"<article>{own}<div><article class=comment itemprop=comment>{own}{own}</article></div></article>") == kept
    assert main_text(f"<article class='post comments'>{own}</article>") == kept
    assert main_text(f"<main><article>{own}</article><article><p>Short.</p></article></main>") == f"{kept}\nShort."
    assert main_text(f"<main><article>{own}</article><article><h2><a href=x>Read, on, and, on</a></h2></article></main>") == kept
    assert main_text(f"<article><article>{own}</article><article><p>Short.</p></article></article>") == f"{kept}\nShort."


def test_long_attributes():
    value = "x>" * 3000
    assert main_text(f"<article><p data-x='{value}'>{TEXT}</p><img alt=\"{value}\"></article>") == TEXT


def test_pages_of_links_and_forms_have_no_text():
    assert main_text("<div><a href=a>Home</a><a href=b>About, and, more</a></div><ul><li><a href=c>Third</a></ul>") == ""
    assert main_text(f"<body><form><p>{TEXT}</p></form></body>") == ""
    assert main_text("<h1>Only a title</h1><a href=a>Home</a>") == "Only a title"


def test_time_follows_length():
    start = time.perf_counter()
    for part in ("<div>", "<p>", '<a href="', "<b>x", "</div>", "<li>x", "<", "<!--", "<script>", "<p x='>", "&amp", "<ul><li>", "<div><b></i>", "<td><tr>"):
        main_text(part * (150_000 // len(part)))
    assert time.perf_counter() - start < 60


def test_rows_in_spark(spark):
    rows = [(1, f"<p>{TEXT}"), (1, f"<p>{TEXT}"), (2, None), (None, "")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("old"))
    out = df.select("page_id", "text", extract(F.col("html")).alias("main"))
    assert [tuple(r) for r in out.collect()] == [(1, "old", TEXT), (1, "old", TEXT), (2, "old", ""), (None, "old", "")]
    assert df.limit(0).select(extract(F.col("html"))).count() == 0
