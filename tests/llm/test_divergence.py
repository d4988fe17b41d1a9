"""The divergence audit against whole-number arithmetic in Python, for tiles of many sizes."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from voxelspark.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string"


def share(n, total, vocabulary):
    return 1 + 1_000_000_000 * (n + 5) // (total + 5 * vocabulary)


def plain(rows, least, top=50):
    counts, held, langs = {}, Counter(), {}
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = Counter(TERM.findall((text or "").translate(UPPER)))
        counts.setdefault((lang, source), Counter()).update(found)
        langs.setdefault(lang, Counter()).update(found)
        held.update((lang, t) for t in found)
    out = []
    for (lang, source), mine in counts.items():
        kept = [t for t in langs[lang] if held[lang, t] >= least]
        total = {s: sum(c[t] for t in kept) for (lg, s), c in counts.items() if lg == lang}
        whole, v = sum(langs[lang][t] for t in kept), len(kept)
        found = {"pair": [], "term": []}
        for other in total:
            if other != source:
                found["pair"].append((sum(abs(share(mine[t], total[source], v) - share(counts[lang, other][t], total[other], v)) for t in kept), other))
        for t in kept:
            more = share(mine[t], total[source], v) - share(langs[lang][t], whole, v)
            if mine[t] and more > 0:
                found["term"].append((more, t))
        for part, items in found.items():
            items.sort(key=lambda i: (-i[0], i[1].encode()))
            out += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("tiling", [{}, {"block": 1, "chunk": 1, "span": 1}, {"block": 2, "chunk": 3, "span": 2}, {"block": 3, "chunk": 5, "span": 1}, {"block": 100, "chunk": 2, "span": 3}])
def test_against_plain_counts(spark, tiling):
    pick = random.Random(5)
    words = [f"{chr(97 + i)}{chr(97 + i * i % 26)}" for i in range(26)] + ["é", "Ünder", "日本"]
    rows = [(i, " ".join(pick.choices(words[: pick.randint(1, 29)], k=pick.randint(0, 30))), pick.choice(["en", "de", None]), pick.choice(["s1", "s2", "", "S", "é", None, "z"])) for i in range(120)]
    rows += [(200, "alone", "fr", "one"), (201, "never", "es", "a"), (202, "kept", "es", "b"), (203, None, "es", "c")]
    assert result(divergence.audit(spark.createDataFrame(rows, SCHEMA), least=4, top=6, **tiling)) == plain(rows, 4, 6)


def test_awkward_rows(awkward):
    rows = [tuple(r) for r in awkward.select("doc_id", "text", "lang", "source").collect()]
    for least in (1, 3):
        assert result(divergence.audit(awkward, least=least)) == plain(rows, least)


def test_no_rows(nothing):
    assert result(divergence.audit(nothing)) == []


def test_no_terms_are_kept(spark):
    rows = [(1, "a b", "en", "x"), (2, "12 3", "en", "y"), (3, "", "en", "z")]
    assert result(divergence.audit(spark.createDataFrame(rows, SCHEMA))) == plain(rows, 30) == [("en", a, "pair", b, 0, k) for a, bs in (("x", "yz"), ("y", "xz"), ("z", "xy")) for k, b in enumerate(bs, 1)]


def test_counts_are_given_out_when_full(spark, monkeypatch):
    class Column:
        def __init__(self, values):
            self.values = values

        def to_pylist(self):
            return self.values

        def __getitem__(self, i):
            return type("Cell", (), {"as_py": lambda _, v=self.values[i]: v})()

    batch = type("Batch", (), {"column": lambda _, c: Column({"lang": ["en"] * 50, "source": ["a", "b"] * 25, "text": [f"The the X{i} é".encode() for i in range(50)]}[c])})()
    whole = Counter()
    for held in (1 << 30, 1, 3000):
        monkeypatch.setattr(divergence, "HELD", held)
        out = Counter()
        given = list(divergence._counted([batch]))
        for b in given:
            for lang, source, term, n, docs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                out[lang, source, term] += n * 1000 + docs
        assert whole in (Counter(), out) and sum(out.values())
        whole = out
    monkeypatch.setattr(divergence, "LONG", 5)
    assert divergence.terms("The the 1x é\x7fZ".encode()) == {b"the": 2, b"x": 1, "é".encode(): 1, b"z": 1}


def test_shares_of_very_large_counts(spark):
    rows = [(0, 10, 3), (7 * 10**14, 9 * 10**17, 10**8), (9 * 10**18, 9 * 10**18, 10**9), (5, 5, 1)]
    got = spark.createDataFrame(rows, "n long, t long, v long").select(divergence.share(F.col("n"), F.col("t"), F.col("v"))).collect()
    assert [r[0] for r in got] == [share(*r) for r in rows]
