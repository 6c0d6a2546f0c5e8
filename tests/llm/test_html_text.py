import html as entities
import re
import time

import pytest

from marquee.llm.common import importable
from marquee.llm.html_text import extract_text, main_text

PARA = "One sentence here, with commas, and words enough to be a paragraph of the text."

CASES = [
    ("", ""),
    (None, ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>a  b\n c</p><p>d</p>", "a b c\nd"),
    ("<article><h1>T</h1><p>x<br>y <b>z</b>!</article><footer>f</footer>", "T\nx y z!"),
    ("<nav><ul><li><a href=/>n</a></ul></nav><div class=ad>buy</div><article><p><b>x<br><p>y</article>", "x\ny"),
    ("<article><p>&lt;b&gt; &#233;&eacute;&copy &am", "<b> éé© &am"),
    ("<script>var t='</p>';</script><style>p{}</style><!-- <p>c</p> --><p>x</p>", "x"),
    (f"<div id=content><h2>H</h2><p>{PARA}</p><p>{PARA}</p></div><div class='comments'><p>{PARA}</p></div>", f"H\n{PARA}\n{PARA}"),
    (f"<main><header><h1>T</h1></header><p>{PARA}</p><aside>no</aside><form><p>{PARA}</p></form><section id='comments'><p>{PARA}</p></section></main>", f"T\n{PARA}"),
    (f"<div class='cookie-notice'>{PARA * 3}</div><div><p>{PARA}</p><p>{PARA}</p></div>", f"{PARA}\n{PARA}"),
    (f"<header><p>{PARA}</p></header><div class='page no-sidebar'><p>{PARA}</p></div>", PARA),
    ("<article><ul><li>a<li>b</ul><p>x</p></article>", "a\nb\nx"),
    ("<article><p>x</p><div hidden><p>no</p></div><div style='display: none'>no</div><p aria-hidden=true>no</p></article>", "x"),
    ("<article><p>a < b > c</p></article>", "a < b > c"),
    ("<article><p>x</p><a href='bro", "x"),
    ("<ARTICLE><P CLASS=Menu>m</P><P>x</P></ARTICLE>", "x"),
    ("<div class='ad'>only</div>", "only"),
]


@pytest.mark.parametrize(("html", "text"), CASES)
def test_cases(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize(
    ("inside", "text"),
    [
        ("<ul><li><a href=/a>First source</a></li><li><a href=/b>Second source</a></li></ul>", "First source\nSecond source"),
        (f"<div class='notice'><p>{PARA * 4}</p></div>", PARA * 4),
        (f"<p class='share-intro'>{PARA}</p>", PARA),
        (f"<div class='related-work'><h2>Work</h2><p>{PARA}</p><p>{PARA} <a href=/x>one</a></p><p>{PARA}</p></div>", f"Work\n{PARA}\n{PARA} one\n{PARA}"),
        ("<div class='notice'>We have moved.</div>", ""),
        ("<p class=share>Share this</p>", ""),
        (f"<div class=related><a href=/x>{PARA * 4}</a></div>", ""),
        (f"<div class='comments'><p>{PARA * 9}</p></div>", ""),
        (f"<div class='ad promo'><p>{PARA * 9}</p></div>", ""),
        (f"<div class='related'><p>{PARA * 3}</p><div class='share'>Tell a friend</div></div>", PARA * 3),
    ],
)
def test_parts_of_an_article(inside, text):
    page = f"<ul><li><a href=/m>menu</a></ul><article><h1>T</h1><p>{PARA}</p>{inside}<p>end</p></article><div class='notice'>{PARA * 9}</div>"
    assert main_text(page) == "\n".join(filter(None, ["T", PARA, text, "end"]))


def test_links_count_against_a_block():
    links = "".join(f"<p><a href=/{k}>{PARA}</a></p>" for k in range(9))
    assert main_text(f"<div>{links}</div><div><p>{PARA}</p><p>{PARA} {PARA}</p></div>") == f"{PARA}\n{PARA} {PARA}"


def test_hostile_pages_take_time_in_proportion():
    start = time.time()
    for page in ("<div>" * 50_000 + "deep", "<" * 100_000, "<a " * 50_000, "&" * 100_000, "<!--" * 30_000, "<p>" * 50_000, "<b>" * 20_000 + "<p>x" * 2_000, "</x>" * 100_000, "<li>" * 30_000, "<td>" * 20_000):
        main_text(page)
    assert time.time() - start < 20


def test_pages_of_the_table(spark, data):
    """These pages hold one article of headings and paragraphs, whose text can be cut out plainly."""
    importable(spark)
    pages = spark.read.parquet(f"{data}/pages.parquet")
    found = {r["page_id"]: r for r in extract_text(pages).collect()}
    assert len(found) == pages.count()
    for page in pages.collect():
        article = re.search(r"<article>(.*)</article>", page["html"], re.S)[1]
        parts = (re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", "", p))).strip() for p in re.split(r"</?(?:p|h1)>", article))
        text = "\n".join(filter(None, parts))
        assert (found[page["page_id"]]["text"], found[page["page_id"]]["n_chars"]) == (text, len(text))


def test_odd_rows(spark):
    importable(spark)
    rows = [(1, "u", None, "x"), (None, None, "<p>a", "x"), (1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (2, "u", "<p>😀" + "a" * 300_000, "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    assert sorted((repr((r["page_id"], r["n_chars"])) for r in extract_text(df).collect())) == sorted(["(1, 0)", "(None, 1)", "(1, 1)", "(1, 1)", "(2, 300001)"])
    assert extract_text(df.limit(0)).count() == 0
