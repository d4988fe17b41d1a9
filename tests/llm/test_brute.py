"""Operators that SQL cannot express, against brute force on whole small tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelspark.llm import decontaminate, lmscore, neardup, sharding, tokencount, topk, toxicity
from voxelspark.llm.common import table


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def groups(docs, size, percent=80):
    """doc_id -> (set size, smallest id reachable), by counting shared shingles of all pairs."""
    sets = {}
    for d, t in docs:
        w = words(t)
        sets[d] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    holders = defaultdict(list)
    for d in sorted(sets):
        for s in sets[d]:
            holders[s].append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for e, n in Counter(e for x in s for e in holders[x] if e < d).items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.fixture(scope="module")
def docs(spark, sf):
    return [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]


def test_near_duplicates(spark, sf, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.op8_near_duplicates(spark, sf).collect()}
    assert got == groups(docs, 4)


def test_near_duplicates_of_a_large_group(spark):
    """A group of near copies that link only in part, through the bucket pivots and the exact way."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for d in range(260):
        w = list(base)
        for _ in range(rng.choice((0, 1, 2, 4, 7, 9))):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    shared = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + d, shared + " " + " ".join(f"q{d}_{i}" for i in range(rng.randrange(5, 60)))) for d in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, 4).collect()}
    assert got == groups(rows, 4)


def test_lm_base(spark, sf, docs):
    tokens = {d: [*words(t), "\0end"] for d, t in docs}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    c = Counter(w for d in tokens if not held[d] for w in tokens[d])
    n, v = sum(c.values()), len(c)
    out = lmscore.op1_lm_score(spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
    unseen = [r for r in out if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_filter_levels():
    """Counts read back are those entered, but for few errors, all upwards."""
    rng = np.random.default_rng(3)
    assert [int(q) for q in lmscore.level(np.array([1, 2, 3, 4, 5, 6, 8, 16]))] == [1, 3, 4, 5, 5, 6, 7, 9]
    keys = np.unique(rng.integers(1, (1 << 64) - 1, 4000, dtype=np.uint64))
    q = lmscore.level(rng.integers(1, 200, len(keys)))
    segments, piece = 4, 1 << 16
    bits = np.zeros((segments, piece * 8), dtype=bool)
    seg = lmscore.segment_of(keys, segments)
    for s in range(segments):
        own, level = lmscore.short(keys[seg == s]), q[seg == s]
        for k in range(1, int(level.max()) + 1):
            for at in lmscore.Filter.places(own[level >= k], k, piece * 8):
                bits[s, at] = True
    held = lmscore.Filter(np.packbits(bits.ravel(), bitorder="little"), segments, 0, 0)
    read = held.levels(keys)
    assert (read >= q).all() and (read > q).mean() < 0.05
    other = rng.integers(1, (1 << 64) - 1, 4000, dtype=np.uint64)
    assert (held.levels(other) > 0).mean() < 0.05


def test_token_counts():
    from tokenizers import Tokenizer, models

    v = tokencount.read_model()
    counter = tokencount.Counter(v)
    listed = [("<unk>", 0.0), *v.pieces.items(), *((f"<0x{i:02X}>", -2e9) for i in range(256))]
    exact = Tokenizer(models.Unigram(listed, 0, True))
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab  thé漢字😀\n\tngr.,") for _ in range(rng.randrange(60))) for _ in range(300)]
    for t in texts:
        assert counter.count(t) == len(exact.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) * bool(t)


def test_token_ties():
    """Equal scores: the path whose last piece starts first."""
    c = tokencount.Counter(tokencount.Vocabulary({"▁": -1.0, "a": -1.0, "b": -1.0, "ab": -2.0, "aab": -3.0, "▁a": -2.0}, False))
    assert c.best("▁aab") == (-4.0, 2)
    assert c.best("▁ab") == (-3.0, 2)
    assert c.count("zz z") == 4  # mark, one run of unknowns, mark, unknown


def test_top_k(spark, sf):
    e = {r.vec_id: np.floor(np.array(r.embedding, dtype=np.float64) * 1024).astype(np.int64) for r in table(spark, sf, "embeddings").collect()}
    want = []
    for q in sorted(e):
        if q % 100 == 0:
            best = sorted((-int(e[q] @ e[c]), c) for c in e if c != q)[:10]
            want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(best)]
    assert [tuple(r) for r in topk.op7_top_k(spark, sf).orderBy("query_id", "rank").collect()] == want


def test_threshold_search_stops_and_ties():
    rng = np.random.default_rng(1)
    for dims, values in ((3, 1000), (8, 2), (1, 3), (64, 400)):
        v = rng.integers(-values, values + 1, (700, dims))
        ids = rng.permutation(5000)[:700]
        for q, (scores, best) in zip(range(20), topk.threshold_search(v[:20], v, ids, ids[:20], 7), strict=True):
            want = sorted((-int(v[q] @ v[i]), int(ids[i])) for i in range(700) if i != q)[:7]
            assert [(-int(s), int(b)) for s, b in zip(scores, best, strict=True)] == want


@pytest.mark.parametrize("n", [0, 1, 2, 3, 15, 16, 17, 1000, 4097])
def test_permutation(n):
    p = sharding.permute(np.arange(n), n)
    assert sorted(p) == list(range(n))
    assert (sharding.permute(p, n, back=True) == np.arange(n)).all()
    if n > 100:
        assert abs(np.corrcoef(np.arange(n), p)[0, 1]) < 0.1
        assert all(sharding.unplace(int(x) % 8, int(x) // 8, n) == i for i, x in enumerate(p[:50]))


def distance(item, text):
    """Least edit distance of ``item`` to any passage of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def test_decontamination():
    rng = random.Random(4)
    item = " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8))) for _ in range(12))
    pattern = decontaminate.Pattern(1, item, 0.1)
    machine = decontaminate.automaton([pattern])
    for _ in range(150):
        s = list(item)
        for _ in range(rng.randrange(2 * pattern.budget)):
            j = rng.randrange(len(s))
            kind = rng.randrange(3)
            s[j : j + 1] = [[rng.choice("abc ")], [], [s[j], rng.choice("abc ")]][kind]
        text = "".join(rng.choice("abc de") for _ in range(40)) + "".join(s) + "".join(rng.choice("abc de") for _ in range(40))
        want = distance(item, text)
        got = decontaminate.matches(text, [pattern], machine)
        assert ({0: want} if want <= pattern.budget else {}) == {i: d for i, (d, _) in got.items()}


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    seen = [(r.score, labels[r.doc_id], r.held_out) for r in toxicity.op5_toxicity(spark, sf).collect() if r.doc_id in labels]
    pairs = [(a > b) + (a == b) / 2 for a, x, h in seen if x == 1 and h for b, y, g in seen if y == 0 and g]
    assert np.mean(pairs) > 0.75  # some 300 labelled rows to learn from


def test_lm_filter_errors_move_no_score(spark):
    """Per token within 0.01 of a filter that practically never errs, for two sizes; the way that the
    filter's answers come makes no difference."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    exact = {r.doc_id: r for r in lmscore.scored(docs, entry_bits=256).collect()}
    for bits, most in ((lmscore.ENTRY_BITS, lmscore.BROADCAST_BYTES), (lmscore.ENTRY_BITS, 0), (12, lmscore.BROADCAST_BYTES)):
        got = lmscore.scored(docs, entry_bits=bits, most=most).collect()
        apart = {held: sum(r.score - exact[r.doc_id].score for r in got if r.held_out == held) / sum(r.n_tokens for r in got if r.held_out == held) for held in (True, False)}
        assert max(map(abs, apart.values())) < 0.01, (bits, apart)
        if bits == lmscore.ENTRY_BITS:
            assert all(r.base_score == exact[r.doc_id].base_score for r in got)
            before = {r.doc_id: r.score for r in got} if most else before
            assert most or before == {r.doc_id: r.score for r in got}


def test_lm_keeps_rare_pairs(spark):
    """Pairs seen once stay in the model, however many there are."""
    train = [d for d in range(400) if zlib.crc32(str(d).encode()) % 7 != 2]
    held = [d for d in range(400) if zlib.crc32(str(d).encode()) % 7 == 2][:2]
    rows = [(d, f"a{d} b{d} c{d} d{d}") for d in train]
    rows += [(held[0], f"a{train[0]} b{train[0]} c{train[0]} d{train[0]}"), (held[1], "never seen these words")]
    got = {r.doc_id: r.score for r in lmscore.scored(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert got[held[0]] > got[held[1]] + 0.5


def test_lm_weights_use_all_training_rows(spark):
    """Pairs that stand only in the last training documents, by hash, weigh by how well they predict."""
    ids = [r.d for r in spark.range(2400).selectExpr("id AS d").orderBy(F.xxhash64("d"), "d").collect()]
    train = [d for d in ids if zlib.crc32(str(d).encode()) % 7 != 2]
    late = set(train[-100:])
    rows = [(d, " ".join(["zig zag"] * 5) if d in late else f"a{d} b{d}") for d in train]
    got = {r.doc_id: r.score for r in lmscore.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[d] > -8 for d in late)


def test_lm_score(spark):
    """The model's score by its definition, with exact levels of pairs in place of the filter's."""
    rng = random.Random(8)
    some = [f"w{int(rng.paretovariate(0.9)) % 60}" for _ in range(4000)]
    rows = [(d, " ".join(some[d * 13 % 3900 : d * 13 % 3900 + rng.randrange(0, 60)])) for d in range(150)]
    tokens = {d: [*words(t), "\0end"] for d, t in rows}
    train = [d for d in tokens if zlib.crc32(str(d).encode()) % 7 != 2]
    one, two = Counter(), Counter()
    pairs = {d: list(zip(["\0end", *t[:-1]], t, strict=True)) for d, t in tokens.items()}
    for d in train:
        one.update(tokens[d])
        two.update(pairs[d])
    n, v = sum(one.values()), len(one)
    level = lambda c: 1 + math.floor(2 * math.log2(c) + 1e-9) if c else 0
    mean = lambda c: lmscore._MEAN[level(c)]
    grid = defaultdict(float)
    for d in train:
        for a, b in pairs[d]:
            pair = max(mean(two[a, b]) - 1, 0) / max(mean(one[a]) - 1, 1)
            odds = min(max(round(2 * math.log2(max(pair, 1e-12) / (max(mean(one[b]), 1) / (n + v)))) + 32, 1), 63) if pair > 0 else 0
            grid[level(one[a]), odds] += 1
    weight = dict.fromkeys({q for q, _ in grid}, 0.1)
    for _ in range(30):
        top, all_ = defaultdict(float), defaultdict(float)
        for (q, odds), m in grid.items():
            ratio = 2 ** ((odds - 32) / 2) if odds else 0
            top[q] += m * weight[q] * ratio / (weight[q] * ratio + 1 - weight[q])
            all_[q] += m
        weight = {q: (top[q] + 0.1) / (all_[q] + 10) for q in weight}
    want = {}
    for d in tokens:
        p = [weight.get(level(one[a]), 0) * min(mean(two[a, b]) / max(mean(one[a]), 1), 1) + (1 - weight.get(level(one[a]), 0)) * (mean(one[b]) + 1) / (n + v + 1) for a, b in pairs[d]]
        want[d] = sum(math.log10(min(x, 1)) for x in p)
    got = {r.doc_id: r.score for r in lmscore.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got.values()) == pytest.approx(sum(want.values()), rel=0.02)
    assert all(got[d] == pytest.approx(want[d], rel=0.1, abs=0.5) for d in want)


def test_token_counts_of_documents(spark, sf, docs):
    from tokenizers import Tokenizer, models

    v = tokencount.read_model()
    exact = Tokenizer(models.Unigram([("<unk>", 0.0), *v.pieces.items(), *((f"<0x{i:02X}>", -2e9) for i in range(256))], 0, True))
    got = {r.doc_id: r.n_tokens for r in tokencount.op4_token_counts(spark, sf).collect()}
    for d, t in docs:
        assert got[d] == (len(exact.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) if t else 0)


def test_decontamination_of_documents(spark, sf, docs):
    """Every item against every document that could hold it, by plain edit distances."""
    items = [(r.item_id, decontaminate.normal(r.text)) for r in table(spark, sf, "benchmark").collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.op10_decontaminate(spark, sf).collect()}
    texts = {d: f" {decontaminate.normal(t)} " for d, t in docs}
    for (d, i), dist in got.items():
        assert distance(f" {dict(items)[i]} ", texts[d]) == dist
    exact = {(d, i) for d, t in texts.items() for i, item in items if item and f" {item} " in t}
    assert exact == {k for k, dist in got.items() if dist == 0}


def least_distance(item, text):
    """The least edit distance of the item to any passage of the text; rows of the table at a time."""
    a, b = (np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in (item, text))
    row, step = np.zeros(len(b) + 1, np.int32), np.arange(len(b) + 1, dtype=np.int32)
    for c in a:
        below = np.append(row[0] + 1, np.minimum(row[:-1] + (b != c), row[1:] + 1))
        row = np.minimum.accumulate(below - step) + step
    return int(row.min())


def test_decontamination_misses_nothing(spark, sf, docs):
    """All pairs of an item and a document, some of which hold items with more and more edits."""
    rng = random.Random(11)
    items = [(r.item_id, decontaminate.normal(r.text)) for r in table(spark, sf, "benchmark").collect()]
    edited = []
    for i, item in items:
        s = list(item)
        for _ in range(rng.randrange(len(s) // 6 + 2)):
            j = rng.randrange(len(s))
            kind = rng.randrange(3)
            s[j : j + 1] = [[rng.choice("abc ")], [], [s[j], rng.choice("abc ")]][kind]
        edited.append((10_000 + i, f"some words before {''.join(s)} and some after"))
    every = [*docs, *edited]
    found = decontaminate.contaminated(spark.createDataFrame(every, "doc_id long, text string"), table(spark, sf, "benchmark"))
    got = {(r.doc_id, r.item_id): r.distance for r in found.collect()}
    texts, want = [(d, f" {decontaminate.normal(t)} ") for d, t in every], {}
    for i, item in items:
        for d, text in texts:
            if item and (least := least_distance(f" {item} ", text)) <= min(len(item) // 10, len(item) - 1):
                want[d, i] = least
    assert want == got and len([d for d in got.values() if d]) > 10


def test_toxicity_score_is_the_models(spark, sf, docs):
    """Scores by single words and plain sums."""
    import pyarrow as pa

    from voxelspark.llm import textscan as ts

    labels = table(spark, sf, "labels")
    model = toxicity.fit(table(spark, sf, "documents"), labels)
    assert model.fitted
    known = dict(zip(model.vocabulary.tolist(), model.weights.tolist(), strict=True))
    got = {r.doc_id: r.score for r in toxicity.score(table(spark, sf, "documents"), model).collect()}
    for d, t in docs[:60]:
        held = set()
        for w in re.findall(r"[A-Za-z\x80-\U0010ffff]+", t or ""):
            one = ts.scan(pa.array([w]), ts.NOT_LETTERS)
            held.add(int(one.hash[0]))
            held |= {int(h) for size in toxicity.PREFIXES for h in one.prefixes(size)[1]}
        assert got[d] == pytest.approx(1 / (1 + math.exp(-sum(known.get(h, 0) for h in held) - model.bias)), rel=1e-5)
