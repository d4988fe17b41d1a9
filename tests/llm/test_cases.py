"""Every operator over nulls, empty and long texts, ties, repeated rows, clashing names and nothing."""

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxelspark.llm import decontaminate, licenses, linededup, lmscore, mixing, neardup, sharding, textscan, tokencount, topk, toxicity


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_lm_score(awkward, nothing):
    out = lmscore.scored(awkward).collect()
    assert len(out) == awkward.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
        assert r.score <= 0 and r.base_score <= 0 and r.n_known <= r.n_tokens
    assert by[4][0].n_tokens == by[5][0].n_tokens == by[6][0].n_tokens == 1
    assert by[2][0] == by[2][1] and len(by[None]) == 2
    assert by[7][0].base_score == pytest.approx(by[8][0].base_score)
    assert lmscore.scored(nothing).count() == 0


def test_licenses(awkward, nothing, spark):
    out = {r.doc_id: r for r in licenses.scan(awkward).collect()}
    assert out[4].n_words == out[5].n_words == out[6].n_words == 0 and out[4].first_word is None and out[4].labels == "" and out[4].score == 0
    assert licenses.scan(nothing).count() == 0
    long = "license " * 20_000
    some = spark.createDataFrame([(1, long), (2, "A MIT License, a Apache LICENSE; general public license"), (3, "the MIT, mit license mit license")], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(some).collect()}
    assert got[1].n_base == 0 and got[1].n_words == 20_000
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].base_labels) == (3, 1, 6, "apache,gpl,mit")
    assert (got[3].n_base, got[3].first_word, got[3].last_word) == (2, 2, 4)


def test_a_phrase_alone_is_no_notice(spark):
    """And a notice with some words changed is one, as long as its key phrase stands."""
    bodies = {t[0]: t for t in licenses.TEMPLATES}
    mit, bsd = bodies["mit-body"][1], bodies["bsd-disclaimer"][1]
    texts = [
        "it was hereby granted free of charge to none", "to deal in the software without restriction", mit, mit.replace("any person", "each man").replace("sublicense", "rent").replace("merge", "join"),
        mit.replace("without restriction", "with restriction"), " ".join(mit.split()[:-40]), bsd.replace("copyright", "patent").replace("damages", "harm"), "even if advised of the possibility of such damage",
        " ".join(reversed(mit.split())) + " to deal in the software without restriction", ("x " * 5000 + mit + " y") * 3,
    ]
    got = {r.doc_id: (set(r.labels.split(",")), r.score) for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, label, there in ((0, "mit-grant", False), (1, "mit-body", False), (2, "mit-body", True), (3, "mit-body", True), (4, "mit-body", False), (5, "mit-body", False), (6, "bsd-disclaimer", True), (7, "bsd-disclaimer", False), (8, "mit-body", False), (9, "mit-body", True)):
        assert (label in got[k][0]) == there, k
    assert got[2][1] == got[9][1] == 1 and 0.7 <= got[3][1] < 1 and got[0][1] == got[1][1] == 0


def test_licenses_of_several_notices(spark):
    """Every notice that stands word for word is found, however many others stand in the file."""
    n, pick = len(licenses.TEMPLATES), random.Random(1)
    sets = [*itertools.combinations(range(n), 1), *itertools.combinations(range(n), 2), *(pick.sample(range(n), k) for k in (4, 4, 4, 13, 13)), range(n)]
    some = [(sum(1 << j for j in js), " and\n".join(licenses.TEMPLATES[j][1] for j in sorted(js))) for js in sets]
    for r in licenses.scan(spark.createDataFrame(some, "doc_id long, text string")).collect():
        want = {t[0] for j, t in enumerate(licenses.TEMPLATES) if r.doc_id >> j & 1}
        assert want <= set(r.labels.split(",")) and r.score == 1
    alone = spark.createDataFrame([(j, f"x {t[1]} y") for j, t in enumerate(licenses.TEMPLATES)], "doc_id long, text string")
    for r in licenses.scan(alone).collect():
        assert licenses.TEMPLATES[r.doc_id][0] in r.labels.split(",") and r.score == 1
    odd = spark.createDataFrame([(1, "M\u0130T License, m\u0130t \u212a"), (2, "\u00c9t\u00c9 MIT LICENSE")], "doc_id long, text string")
    assert [(r.n_words, r.n_base) for r in licenses.scan(odd).orderBy("doc_id").collect()] == [(4, 0), (3, 1)]
    cut = spark.createDataFrame([(1, licenses.TEMPLATES[2][1] + " " + "x " * 50 + " ".join(licenses.VOCABULARY))], "doc_id long, text string")
    assert "apache-2.0" in licenses.scan(cut).first().labels.split(",")


def test_line_dedup(awkward, nothing, spark):
    assert linededup.dropped_lines(nothing).count() == 0
    cleaned = linededup.cleaned(awkward)
    assert cleaned.columns == awkward.columns and cleaned.count() == awkward.count()
    lines = [(i, f"own words number{i} here\nuser {i} logged in from host{i} at port {i * 7}\n{'a b c d e f ' * i}") for i in range(6)]
    df = spark.createDataFrame([*lines, (9, None), (10, "")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.cleaned(df).collect()}
    assert all("logged in" not in got[i] for i in range(6)) and "own words number3 here" in got[3] and got[9] is None and got[10] == ""


def test_short_lines_that_recur(spark):
    """They go if every token is constant, and stay if one is a field."""
    own = [" ".join("abcd"[i] * k for k in range(2, 8)) for i in range(4)]
    docs = spark.createDataFrame([(i, f"{own[i]}\nAll rights reserved.\nPage {i}\nMenu\n\nonly {'abcd'[i % 2]} here") for i in range(4)], "doc_id long, text string")
    for r in linededup.cleaned(docs).collect():
        i = r.doc_id
        assert r.text == f"{own[i]}\nPage {i}\n\nonly {'abcd'[i % 2]} here"


def test_line_dedup_of_a_wide_leaf(spark):
    """Recurring lines that share length and opening go, however many there are."""
    lines = ["This file is " + " ".join(c * n for n in (1, 2, 3, 4)) for c in "abcdefghijklmnopqrst"]
    own = {d: "This file is " + " ".join(c * d for c in "uvwx") for d in range(1, 5)}
    df = spark.createDataFrame([(d, "\n".join([*lines, own[d]])) for d in own], "doc_id long, text string")
    assert {r.doc_id: r.text for r in linededup.cleaned(df).collect()} == own


def test_line_dedup_sieve(awkward, spark, monkeypatch):
    """Leaves in a bit table of fixed size give what their broadcast gives; rows that repeat are one
    document; lines of many tokens and of none are fine."""
    lines = [(i, f"user {i} logged in from host{i} at port {i * 7}\nsome own words of the text number {'abcdefgh'[i % 8] * 3} here\nthe same line stands here\tagain") for i in range(8)]
    df = awkward.select("doc_id", "text").union(spark.createDataFrame([*lines, lines[0], lines[0], (9, "a b " * 3000)], "doc_id long, text string"))
    want = sorted(rows(linededup.dropped_lines(df)))
    assert len({k for k, _ in want}) >= 8
    monkeypatch.setattr(linededup, "fits", lambda df: False)
    assert sorted(rows(linededup.dropped_lines(df))) == want
    alone = spark.createDataFrame([lines[0]] * 5, "doc_id long, text string")
    assert linededup.dropped_lines(alone).count() == 0


def test_token_counts(awkward, nothing):
    v = tokencount.Vocabulary({"▁": -1.0, "o": -5.0, "▁one": -2.0, "n": -5.0, "e": -5.0}, False)
    out = tokencount.token_counts(awkward, v)
    got = {r.doc_id: r.n_tokens for r in out.collect()}
    assert got[4] == got[5] == 0 and got[8] == 1 and out.count() == awkward.count()
    assert tokencount.token_counts(nothing, v).count() == 0


def test_toxicity(awkward, nothing, spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (9, None), (10, 0)], "doc_id long, toxic int")
    model = toxicity.fit(awkward, labels)
    out = toxicity.score(awkward, model).collect()
    assert len(out) == awkward.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(nothing, toxicity.fit(nothing, labels)).count() == 0
    assert not toxicity.fit(awkward, labels.limit(0)).fitted
    assert toxicity.accepted(awkward, model).columns == awkward.columns
    held = spark.createDataFrame([(None,), (1,)], "doc_id long").select(toxicity.held_out(F.col("doc_id")).alias("h"))
    assert all(r.h is not None for r in held.collect())


def test_toxicity_patterns_of_a_row():
    """A text votes alike wherever it stands in a batch."""
    texts = ["xyxy", "xyxy", "", None, "xyxyxyxyxy", "AAAA!", "#$%&", "a"]
    together = toxicity.patterns(pa.array(texts))
    assert [list(r) for r in together] == [list(toxicity.patterns(pa.array([t]))[0]) for t in texts]


def test_text_stretches(monkeypatch):
    """Words and their hashes do not depend on where a block is cut into stretches."""
    texts = ["one two  three", None, "", "é" * 40 + " tail", "x" * 100, " lead and trail ", "a b c d e f g h i j k l m n"]
    whole = textscan.scan(pa.array(texts))
    monkeypatch.setattr(textscan, "BLOCK_BYTES", 16)
    cut = textscan.scan(pa.array(texts))
    for name in ("starts", "ends", "row", "hash"):
        assert (getattr(whole, name) == getattr(cut, name)).all()
    for size in (3, 5):
        assert all((a == b).all() for a, b in zip(whole.prefixes(size), cut.prefixes(size), strict=True))


def test_mixing(awkward, nothing):
    out = mixing.copies(awkward)
    total = sum(r.size for r in out.collect())
    goals = {r.source: r.target for r in out.collect()}
    assert out.count() == awkward.count() and sum(goals.values()) == pytest.approx(1.5 * total)
    assert all(0 <= r.copies <= 2 for r in out.collect())
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    assert mixed.count() == sum(r.copies for r in out.collect())
    assert mixing.copies(nothing).count() == mixing.mix(nothing).count() == 0
    empty = awkward.filter("text = ''")
    assert [r.target for r in mixing.copies(empty).collect()] == [0.0]


def test_top_k(spark):
    inf = float("inf")
    data = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [inf, 0.0]), (5, [float("nan"), 0.0]), (6, [0.5, -1.0]), (7, [1.0]), (8, []), (None, [1.0, 1.0]), (100, []), (0, [1.0, 2.0]), (200, [-1.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("score", F.lit(2))
    got = rows(topk.top_k(df, F.col("vec_id") % 100 == 0, k=3).orderBy("query_id", "rank"))
    unit = 1024 * 1024
    of_0 = [(0, 1, 0, 5 * unit), (0, 2, 1, 5 * unit), (0, 3, 200, -unit)]  # either row of id 0 has the other one
    assert got == sorted([*of_0, *of_0, (100, 1, 8, 0), (200, 1, 6, -unit // 2), (200, 2, 0, -unit), (200, 3, 0, -unit)])
    assert rows(topk.top_k(df, F.col("vec_id") % 100 == 0, k=3, blocks=5).orderBy("query_id", "rank")) == got
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_of_large_components(spark):
    """Products beyond 2^53 and, before they cancel, beyond 64 bits."""
    big = float(1 << 26)
    df = spark.createDataFrame([(0, [big, big]), (1, [big, -big]), (2, [16384.0, 0.0]), (3, [-big, big + 1]), (4, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = rows(topk.top_k(df, F.col("vec_id") == 0).orderBy("rank"))
    at = 1024 * 1024 * (1 << 26)
    assert got == [(0, 1, 2, 16384 * at), (0, 2, 4, 2 * at), (0, 3, 3, at), (0, 4, 1, 0)]
    e = 1 << 33
    held = spark.createDataFrame([(0, [float(e), float(e)]), (1, [float(e), -float(e)]), (2, [1.0, -1.0 - 1 / 1024])], "vec_id long, embedding array<double>")
    assert rows(topk.top_k(held, F.col("vec_id") == 0).orderBy("rank")) == [(0, 1, 1, 0), (0, 2, 2, -e * 1024)]


def test_near_duplicates(awkward, nothing):
    out = neardup.near_duplicates(awkward, 4)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert out.count() == awkward.count()
    assert [got[i][0].component_id for i in (1, 2, 3)] == [1, 1, 1] and got[1][0].kept and not got[2][0].kept
    assert [got[i][0].n_shingles for i in (4, 5, 6, 7)] == [0, 0, 0, 1] and all(got[i][0].kept for i in (4, 5, 6))
    assert got[8][0].component_id == 7
    assert {r.component_id for r in got[None]} == {1, None}
    assert neardup.near_duplicates(nothing, 4).count() == 0
    left = neardup.deduplicated(awkward)
    assert left.columns == awkward.columns
    ids = [r.doc_id for r in left.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted(set(ids)) and 2 not in ids and 8 not in ids
    assert neardup.deduplicated(nothing).count() == 0


def test_near_duplicates_of_shared_ids(spark):
    """Rows that share an id and not a text are documents of their own; copies are found across them."""
    a, b, c = ("\n".join(f"{x}{i} {x}{i * i} w" for i in range(30)) for x in "abc")
    some = [(5, a, 1), (5, b, 2), (6, a, 3), (7, b, 4), (7, b, 4), (None, c, 5), (None, c, 6), (3, "", 7), (3, None, 8), (4, c, 9), (5, a, 1)]
    df = spark.createDataFrame(some, "doc_id long, text string, n int")
    got = neardup.near_duplicates(df).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got) == sorted(
        [(5, 5, True), (5, 5, True), (5, 5, True), (6, 5, False), (7, 5, False), (7, 5, False), (0, 4, False), (0, 4, False), (3, 3, True), (3, 3, True), (4, 4, True)]
    )
    left = sorted((r.doc_id, r.text or "", r.n) for r in neardup.deduplicated(df).collect())
    assert left == sorted([(5, a, 1), (5, b, 2), (3, "", 7), (3, "", 8), (4, c, 9)])
    nameless = spark.createDataFrame([(None, c, 5), (None, c, 6)], "doc_id long, text string, n int")
    assert neardup.deduplicated(nameless).count() == 1


def test_sharding(awkward, nothing):
    out = sharding.shards(awkward, whole=False)
    got = out.collect()
    n = len(got)
    sizes = [sum(r.shard == s for r in got) for s in range(8)]
    assert n == awkward.count() and max(sizes) - min(sizes) <= 1
    assert sorted((r.shard, r.slot) for r in got) == sorted((p % 8, p // 8) for p in range(n))
    assert {r.size for r in got if r.doc_id in (4, 5)} == {1}
    assert sharding.shards(awkward).select("row.*").columns == awkward.columns
    assert sharding.shards(nothing).count() == 0


def test_decontaminate(awkward, nothing, spark):
    item = "Juniper, larch and maple: an oak stands by the pine; rowan berries are red in autumn"
    edited = item.replace("stands", "stood").upper()
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame([(50, f"before {edited} after"), (51, item), (52, item[:40])], "doc_id long, text string"))
    items = spark.createDataFrame([(1, item), (2, None), (None, ""), (3, "?!"), (None, item)], "item_id long, text string").withColumn("distance", F.lit(1))
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(50, 1): 3, (50, None): 3, (51, 1): 0, (51, None): 0}
    kept = decontaminate.clean(docs, items)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id and r.doc_id >= 50) == [52] and kept.count() == docs.count() - 2
    assert decontaminate.contaminated(nothing, items).count() == 0 and decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.clean(docs, items.limit(0)).count() == docs.count()


def test_decontaminate_short_items(spark):
    """Short items are found as whole words, longer ones lose an edit for each end inside a word."""
    docs = spark.createDataFrame([(1, "a category of its own"), (2, "the cat"), (3, "Cat! sat"), (4, "xthe quick brown fox jumps overx")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "cat"), (2, "the quick brown fox jumps over")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.distance, r.end_at, r.chars) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(2, 1): (0, 7, 3), (3, 1): (0, 3, 3), (4, 2): (2, 30, 30)}
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [1]
