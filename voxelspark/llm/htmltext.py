"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score positive and tags negative, and one linear scan
finds the contiguous region with the highest sum: the article.  What a tag costs, and what a word in
or out of a link is worth, comes from labelled pages, which are those that mark their article by an
``article`` element: the log-odds of standing outside it against inside it, smoothed towards 3.25 for
a tag, and 0.3 for paragraphs, headings and tags within a line that are no links.  They are counted over a bounded sample (``LABELLED`` pages, by a hash of id and address) in
one aggregation, and the weights are a table of at most two rows for each name of HTML's elements.

Menus, headers, footers, sidebars, notices, adverts, forms and comments take no part in the sequence
where the page names them, by element, role, class or id; so an advert amid the article neither
splits it nor stays in it.  An ``article`` or ``main`` element inside what such a name covers lifts
it (a form around a whole page), but not inside comments, asides and lists of other articles.  Where
a page marks its own article, that is its label: words outside score negative and tags inside cost
the least.  The rest of the region is kept whole: blocks in page order, white space as one space.

Scores are whole hundredths, so sums are exact.  Of equal regions the one that ends first is taken,
and of these the longest.

Defined cases: a null or empty page, and one without words outside boilerplate, has the empty text;
unfinished tags, comments and scripts end with the page; end tags that match nothing are ignored; null
ids and repeated rows are returned as they are; further columns are ignored; without labelled pages
the smoothing alone is the weight; an empty table gives an empty result.  A page must fit a task.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.llm.common import table

#: Labelled pages that the weights are counted on.
LABELLED = 5000
#: Hundredths: what a tag costs unseen, at least and at most; what a word is worth, at least and at most.
UNSEEN, UNSEEN_IN_TEXT, LEAST, MOST = 325, 30, 1, 800
WORD, LINK, WORTH = 100, 50, 100

#: Names of HTML.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " legend li main menu nav noframes ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base basefont br col embed frame hr img input keygen link meta param source track wbr".split())
CLOSES_P = BLOCKS - frozenset("body br button caption col colgroup head html legend option optgroup select tbody td textarea tfoot th thead title tr".split())
IN_TEXT = INLINE - {"a"} | frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre br wbr img".split())
#: What an element ends that is still open, and where looking for it stops.
CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
#: Names of elements, roles and parts of class names and ids that stand for boilerplate; the second
#: of each is what no article inside lifts.
ELEMENTS = frozenset("nav header footer form dialog menu search select button textarea noscript head template svg canvas object audio video map datalist iframe".split())
FIRM_ELEMENTS = frozenset(["aside"])
ROLES = frozenset("navigation banner contentinfo search form dialog alert alertdialog menu menubar toolbar".split())
FIRM_ROLES = frozenset(["complementary"])
NAMES = frozenset(
    "nav navigation navbar menu menus submenu breadcrumb breadcrumbs header masthead banner topbar footer notice notices cookie cookies consent gdpr alert popup modal overlay ad ads adv advert adverts"
    " advertisement advertising adsense sponsor sponsored promo promotion form login signin signup register search searchbox newsletter subscribe subscription pagination pager toolbar skip copyright".split()
)
FIRM_NAMES = frozenset("sidebar sidebars aside widget widgets comment comments commentlist respond replies reply disqus discussion related recommended recommendations teaser teasers share sharing social".split())
#: Parts of names that say that something has, or is part of, the article.
HAS = frozenset("has with without no not".split())
OWN = frozenset("article post entry story content main".split())

_ATTRS = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+>"
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<raw>script|style|title|textarea|noscript|noframes|noembed|iframe|xmp)(?=[\s/>])" + _ATTRS + r".*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<attrs>" + _ATTRS + r"|[^>]*\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"(?:^|[\s/\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[-_:]+")

MASKED, ARTICLE, LINKED = 1, 2, 4


def _cover(name: str, attrs: str, in_article: bool) -> int:
    """Whether an element is boilerplate: 0 no, 1 unless an article is in it, 2 yes."""
    if name in ("html", "body", "main"):
        return 0
    if name in FIRM_ELEMENTS:
        return 2
    cover = int(name in ELEMENTS and not (name == "header" and in_article))
    for kind, a, b, c in _ATTR.findall(attrs):
        for value in (a or b or c).lower().split():
            if kind.lower() == "role":
                cover = max(cover, 2 * (value in FIRM_ROLES), value in ROLES)
                continue
            parts = set(_PART.split(value))
            if parts & HAS:
                continue
            if parts & FIRM_NAMES:
                return 2
            if found := parts & NAMES:
                cover = max(cover, int(not (found == {"header"} and (in_article or parts & OWN))))
    return cover


_cover_of_short = lru_cache(maxsize=4096)(_cover)


def parse(page: str) -> list[tuple[str, str, int]]:
    """The page as (tag, text, state): either is empty; a tag has its name, an end tag with a slash.
    The state says whether it is boilerplate, in a marked article, and in a link."""
    out, at, opened = [], 0, []
    covers = articles = links = 0

    def state() -> int:
        return (MASKED if covers else 0) | (ARTICLE if articles else 0) | (LINKED if links else 0)

    def close(i: int) -> None:
        """Takes the elements from the i-th on off the open ones."""
        nonlocal covers, articles, links
        for name, cover in opened[i:]:
            covers -= cover > 0
            articles -= name == "article"
            links -= name == "a"
        del opened[i:]

    def find(names: frozenset | tuple, stop: frozenset = frozenset()) -> int:
        for i in range(len(opened) - 1, -1, -1):
            if opened[i][0] in names:
                return i
            if opened[i][0] in stop:
                break
        return -1

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            out.append(("", unescape(text) if "&" in text else text, state()))
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if m["end"]:
            i = find((name,))
            if i >= 0:
                if name in INLINE and any(n not in INLINE for n, _ in opened[i + 1 :]):
                    rest = opened[i + 1 :]
                    close(i)
                    for n, cover in rest:
                        opened.append((n, cover))
                        covers += cover > 0
                        articles += n == "article"
                        links += n == "a"
                else:
                    before = state()
                    close(i)
                    out.append(("/" + name, "", (before & MASKED) | (state() & ~MASKED)))
                    continue
            out.append(("/" + name, "", state()))
            continue
        if name in CLOSES_P:
            i = len(opened) - 1
            while i >= 0 and opened[i][0] in INLINE:
                i -= 1
            if i >= 0 and opened[i][0] == "p":
                close(i)
        if name in CLOSES and (i := find(*CLOSES[name])) >= 0:
            close(i)
        if name in VOID:
            out.append((name, "", state()))
            continue
        attrs = m["attrs"]
        cover = (_cover_of_short if len(attrs) < 200 else _cover)(name, attrs, articles > 0)
        if name in ("article", "main") and not cover and covers and all(c < 2 for _, c in opened):
            opened[:] = [(n, 0) for n, _ in opened]
            covers = 0
        out.append((name, "", state() | (MASKED if cover else 0)))
        opened.append((name, cover))
        covers += cover > 0
        articles += name == "article"
        links += name == "a"
    if at < len(page):
        text = page[at:]
        out.append(("", unescape(text) if "&" in text else text, state()))
    return out


def marked(items: list[tuple[str, str, int]]) -> bool:
    """Whether the page marks an article that has words."""
    return any(state & ARTICLE and not state & MASKED and text and not text.isspace() for _, text, state in items)


_KNOWN = BLOCKS | INLINE | VOID


def _tag(tag: str) -> str:
    """Tags by HTML's names; all others are one."""
    return tag if tag.lstrip("/") in _KNOWN else "?"


def _unseen(tag: str) -> int:
    return UNSEEN_IN_TEXT if tag.lstrip("/") in IN_TEXT else UNSEEN


def counts(items: list[tuple[str, str, int]]) -> tuple[Counter, Counter]:
    """Tags and words of a labelled page, inside and outside its article."""
    found = (Counter(), Counter())
    for tag, text, state in items:
        side = found[0 if state & (ARTICLE | MASKED) == ARTICLE else 1]
        if tag:
            side[_tag(tag)] += 1
        else:
            side["#link" if state & LINKED else "#word"] += len(text.split())
    return found


def weights(found: list[tuple[str, int, int]]) -> dict[str, int]:
    """(token, inside, outside) -> what each scores: words more than nothing, tags less."""
    out = {"#word": WORD, "#link": LINK}
    for token, inside, outside in found:
        if token.startswith("#"):
            out[token] = max(LEAST, min(WORTH, round(100 * math.log((inside + 2) / (outside + 1))) if inside + outside else out[token]))
        else:
            out[token] = -max(LEAST, min(MOST, round(100 * math.log((outside + math.exp(_unseen(token) / 100)) / (inside + 1)))))
    return out


def scores(items: list[tuple[str, str, int]], weight: dict[str, int]) -> list[int]:
    own, out = marked(items), []
    for tag, text, state in items:
        if state & MASKED:
            out.append(0)
        elif tag:
            out.append(-LEAST if own and state & ARTICLE else weight.get(_tag(tag), -_unseen(tag)))
        elif own and not state & ARTICLE:
            out.append(-WORD * len(text.split()))
        else:
            out.append(len(text.split()) * (weight["#word"] if own else weight["#link" if state & LINKED else "#word"]))
    return out


def best(values: list[int]) -> tuple[int, int]:
    """First and last place of the contiguous run with the highest sum, (0, -1) if none is positive."""
    found, most, total, start = (0, -1), 0, 0, 0
    for i, value in enumerate(values):
        if total < 0:
            total, start = 0, i
        total += value
        if total > most:
            most, found = total, (start, i)
    return found


def extract(page: str | None, weight: dict[str, int]) -> str:
    """The main text of a page."""
    items = parse(page or "")
    first, last = best(scores(items, weight))
    out = []
    for tag, text, state in items[first : last + 1]:
        if tag:
            out.append(" " if tag.lstrip("/") in BLOCKS else "")
        elif not state & MASKED:
            out.append(text)
    return " ".join("".join(out).split())


def fit(pages: DataFrame, most: int = LABELLED) -> dict[str, int]:
    """Weights from the labelled pages with the ``most`` smallest hashes of (page_id, url)."""
    labelled = pages.filter(F.col("html").rlike(r"(?i)<article[\s/>]")).select(F.xxhash64("page_id", "url").alias("h"), "html")
    last = labelled.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in batch.column("html"):
                items = parse(page.as_py())
                if marked(items):
                    found = counts(items)
                    inside.update(found[0])
                    outside.update(found[1])
        tokens = list(inside | outside)
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array([inside[t] for t in tokens], pa.int64()), pa.array([outside[t] for t in tokens], pa.int64())], ["token", "inside", "outside"])

    if last is None:
        return weights([])
    found = labelled.filter(F.col("h") <= last).select("html").mapInArrow(count, "token string, inside long, outside long")
    return weights([tuple(r) for r in found.groupBy("token").agg(F.sum("inside"), F.sum("outside")).collect()])


def main_text(pages: DataFrame, weight: dict[str, int]) -> DataFrame:
    """(page_id, url, html) -> (page_id, url, text, n_chars)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):  # texts of so many pages are held
                part = batch.slice(low, 500)
                texts = [extract(page.as_py(), weight) for page in part.column("html")]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("long"), "url", "html")
    return main_text(pages, fit(pages))
