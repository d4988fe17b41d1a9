"""Each stage of the pipeline on what its predecessor kept, against brute force."""

import re
from collections import Counter

import corpus_pipeline
from test_brute import distance, groups

from voxelspark.llm import decontaminate, mixing
from voxelspark.llm.common import table


def test_stages(spark, sf, tmp_path):
    documents = table(spark, sf, "documents")
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == documents.columns
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        kept[name + " rows"] = Counter(r.doc_id for r in docs.select("doc_id").collect())
    before = kept["toxicity"]
    assert len(before) >= 0.75 * documents.count()
    want = groups(list(before.items()), 5)
    assert set(kept["near_duplicates"]) == {d for d, (_, c) in want.items() if c == d}
    items = [decontaminate.normal(r.text) for r in table(spark, sf, "benchmark").collect()]
    for d, t in kept["near_duplicates"].items():
        n = decontaminate.normal(t)
        exact = any(i and i in n for i in items)
        if d in kept["decontamination"]:
            assert not exact
        elif not exact:
            assert any(i and distance(i, n) <= 0.1 * len(i) for i in items)
    copies = kept["mixing rows"]
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in kept["decontamination"].items()}
    assert set(copies) <= set(size) and max(copies.values()) <= 2
    assert abs(sum(size[d] * n for d, n in copies.items()) - 1.5 * sum(size.values())) < 0.35 * sum(size.values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted((r.shard, r.slot) for r in last) == sorted((p % 8, p // 8) for p in range(len(last)))
    assert Counter(r.doc_id for r in last) == copies


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == [*table(spark, sf, "documents").columns, "shard", "slot"] and out.count() > 0


def test_run_on_awkward_tables(spark, awkward, nothing, tmp_path):
    """Nulls, repeats, long and empty texts, clashing names, and tables without rows."""
    items = spark.createDataFrame([(1, "juniper0 larch maple oak"), (None, None), (2, "")], "item_id long, text string")
    labels = spark.createDataFrame([(1, None, 1), (2, 0, None), (None, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    for name, docs, few in (("some", awkward, False), ("none", nothing, True)):
        folder = tmp_path / name
        docs.write.parquet(str(folder / "documents.parquet"))
        (labels.limit(0) if few else labels).write.parquet(str(folder / "labels.parquet"))
        (items.limit(0) if few else items).write.parquet(str(folder / "benchmark.parquet"))
        out = corpus_pipeline.run(spark, str(folder))
        assert sorted(out.columns) == sorted(awkward.columns)
        got = out.collect()
        assert few == (not got)
        assert sorted((r.shard, r.slot) for r in got) == sorted((p % 8, p // 8) for p in range(len(got)))
        assert max(Counter((r.doc_id, r.text) for r in got).values(), default=0) <= 2
    stages = dict(corpus_pipeline.STAGES)
    kept = [(r.doc_id, r.text) for r in stages["near_duplicates"](spark, awkward, str(tmp_path / "some")).collect()]
    assert sorted(d for d, _ in kept if d) == [1, 4, 5, 6, 7, 9, 10, 11, 12] and sum(d is None for d, _ in kept) == 1


def test_rows_that_only_a_number_tells_apart(spark, sf, tmp_path):
    """Values that move between columns where the other is null, maps, and names used inside."""
    text = " ".join(f"{w}{i}" for i in range(40) for w in ("ash", "birch"))
    names = ["__a", "__b", "__rows", "__copies", "__copy", "__gone", "__whole", "__twice", "at", "row", "path", "copies", "file", "_metadata", "i"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, m map<string, int>, " + ", ".join(f"`{n}` int" for n in names)
    rest = (1, {"x": 1, "y": None}, *range(len(names)))
    rows = [(7, "a b c", "en", None), (7, "a b c", None, "en"), (5, text, None, "s"), (5, None, text, "s"), (1, text, None, "s"), (9, text, None, None), (9, None, text, None)]
    docs = spark.createDataFrame([(*r, *rest) for r in rows], schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES:
        for source in (docs, spark.read.parquet(str(tmp_path / "documents.parquet"))):
            out = stage(spark, source, sf)
            assert [c for c in out.columns if c not in ("shard", "slot")] == docs.columns
            got = out.collect()
            assert got and all(tuple(r)[5:21] == rest[1:] for r in got), name
    left = sorted((r.doc_id, r.text, r.lang, r.source) for r in stages["near_duplicates"](spark, docs, sf).collect() if r.doc_id != 7)
    assert left == [(1, text, None, "s"), (5, None, text, "s"), (9, None, text, None)]
    assert stages["near_duplicates"](spark, docs, sf).filter("doc_id = 7").count() == 1
    drawn = Counter((r.lang, r.source) for r in stages["mixing"](spark, docs, sf).collect() if r.doc_id == 7)
    want = {(r.source,): r.copies for r in mixing.copies(docs).collect() if r.doc_id == 7}
    assert drawn == Counter({("en", None): want[(None,)], (None, "en"): want[("en",)]})
