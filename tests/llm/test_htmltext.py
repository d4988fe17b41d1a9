"""Main text of pages: the scan against all regions, awkward markup, and accuracy without the pages' own labels."""

import random
import re
from html import unescape

import pyarrow.parquet as pq
import pytest

from voxelspark.llm import htmltext

WEIGHT = htmltext.weights([])


def text(page, weight=WEIGHT):
    return htmltext.extract(page, weight)


def test_the_scan_finds_the_best_of_all_regions():
    pick = random.Random(3)
    for _ in range(400):
        values = [pick.choice([-300, -100, -1, 0, 0, 100, 200]) for _ in range(pick.randint(0, 14))]
        every = [(sum(values[i : j + 1]), -j, -i) for i in range(len(values)) for j in range(i, len(values))]
        most = max((e for e in every if e[0] > 0), default=None)
        found = htmltext.best(values)
        if most is None:
            assert found == (0, -1)
        else:
            # The same sum and end; zero-sum openings may be longer, never shorter.
            assert (sum(values[found[0] : found[1] + 1]), -found[1], -found[0]) == most


BODY = "<h1>On  rivers</h1><p>Rivers &amp; lakes<br>are w<b>et</b>.</p><p>They\n flow&nbsp;down.</p>"
WANT = "On rivers Rivers & lakes are wet. They flow down."


@pytest.mark.parametrize(
    "page",
    [
        f"<nav><a href=/>Home</a> <a href=/x>All of our many pages</a></nav><article>{BODY}</article><footer>&copy; someone, all rights reserved</footer>",
        f"<header><h1>My site</h1></header><div class='cookie-notice'>We use cookies on this site</div><article>{BODY}</article>",
        f"<article>{BODY}<div class=ad>Buy this now</div></article><aside><article>Another one to read</article></aside>",
        f"<article><h1>On rivers</h1><div class='ad-slot'>Buy now</div><p>Rivers &amp; lakes<br>are w<b>et</b>.</p><form>Name <input> <button>Send</button></form><p>They flow down.</p></article>",
        f"<article>{BODY}<section class='comments'><article class=comment><p>So many words from a reader here, more than in the article itself, I think</p></article></section></article>",
        f"<form id=all><header>My site</header><div role=navigation>One two three</div><article>{BODY}</article></form>",
        f"<script>var a='<article>no</article>' < 3;</script><style>p::before{{content:'</p>'}}</style><!-- <p>ad --><article>{BODY}<script>track()</script></article>",
        f"<ARTICLE CLASS=x>{BODY.replace('p>', 'P>')}</ARTICLE><DIV CLASS=\"Footer\">Copyright by us</DIV>",
        f"<article title='a > b'>{BODY}<!-- unfinished </article>",
        f"<article>{BODY}</article><div hidden title=it's>x</div><p",
        f"</div></nav><article>{BODY}</section></article></article>",
    ],
)
def test_pages(page):
    assert text(page) == WANT


def test_a_page_without_mark_or_labelled_pages():
    long = "Rivers and lakes are wet, and they flow down from the hills until they reach the sea."
    page = f"<body class='has-sidebar'><div id=sidebar>{long}</div><div><a href=x>More</a></div><div class=post><div class=entry-header><h1>On the many rivers of this and other lands</h1></div><p>{long}<p>{long}</div><div><a href=x>More</a></div></body>"
    assert text(page) == f"On the many rivers of this and other lands {long} {long}"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<p></p><br>", ""), ("<nav>menu only</nav>", ""), ("plain words", "plain words"), ("<", "<"), ("a < b", "a < b"), ("<!DOCTYPE html><title>T</title>", ""),
        ("<article></article><p>outside</p>", "outside"), ("<p>x&am y&amp z&#233;&#x41;", "x&am y& zéA"), ("<article>foo<script>x</script>bar <i>baz</i>qux</article>", "foobar bazqux"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>", "one two a b"), ("<article><custom-x>one</custom-x><li class=ad>no<li>two</article>", "one two"),
        ("<article><p>one<textarea>two</textarea><noscript>three</noscript></article>", "one"), ("<article>" + "<li><a href=x>word</a></li>" * 50 + "</article>", " ".join(["word"] * 50)),
        ("<article>" + "wörd " * 100_000 + "</article>", ("wörd " * 100_000).strip()), ("<div>" * 5000 + "deep words of text" + "</div>" * 5000, "deep words of text"),
        ("<a title=" + "'" * 20_000 + ">word</a>", "word"),
    ],
)
def test_awkward_pages(page, want):
    assert text(page) == want


def truth(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inner))).split())


def test_accuracy_without_the_mark(spark, sf):
    """Weights from even pages; odd pages lose their mark, and their text must still be found."""
    pages = spark.read.parquet(sf.replace("0.001", "0.01") + "/pages.parquet")
    weight = htmltext.fit(pages.filter("page_id % 2 = 0"))
    assert weight["p"] == -1 and weight["li"] < -400 and weight["#link"] < weight["#word"]
    held = [r[0] for r in pages.filter("page_id % 2 = 1").select("html").collect()]
    right = [text(re.sub("</?article>", "", page), weight) == truth(page) for page in held]
    assert sum(right) >= 0.98 * len(right)


def test_query(spark, sf):
    got = htmltext.op11_html_text(spark, sf)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = {r["page_id"]: r for r in got.collect()}
    pages = pq.read_table(f"{sf}/pages.parquet").to_pylist()
    assert len(rows) == len(pages)
    for page in pages:
        r = rows[page["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (page["url"], truth(page["html"]), len(truth(page["html"])))


def test_awkward_tables(spark):
    schema = "page_id long, url string, html string, text string, h long, n_chars int"
    rows = [(1, "u", f"<article>{BODY}</article>", "x", 1, 2), (1, "u", f"<article>{BODY}</article>", "x", 1, 2), (None, None, None, None, None, None), (2, None, "", "", 0, 0), (3, "v", "<p>a𝄞b</p>", None, None, None)]
    pages = spark.createDataFrame(rows, schema)
    got = sorted(htmltext.main_text(pages, htmltext.fit(pages)).collect(), key=repr)
    assert got == sorted([(1, "u", WANT, len(WANT)), (1, "u", WANT, len(WANT)), (None, None, "", 0), (2, None, "", 0), (3, "v", "a𝄞b", 3)], key=repr)
    nothing = pages.limit(0)
    assert htmltext.main_text(nothing, htmltext.fit(nothing)).collect() == []
