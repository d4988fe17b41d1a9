"""The prefix trie against a plain trie, for sequences that share much and for many partitions."""

import hashlib
import random
import zlib

import pytest

from voxelspark.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuild(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: tuple(own.get(c - c % 100, [])[: h[c]] + own[c][h[c] :]) for c in own}


def plain(rows):
    whole, members = rebuild(rows), {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if whole[c] == node)
        up = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), up, len(convs), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows):
    own = prefixtrie.sequences(spark.createDataFrame(rows, SCHEMA))
    return sorted((tuple(r) for r in prefixtrie.nodes(prefixtrie.points(prefixtrie.shared_heads(own))).collect()), key=repr)


def some(seed, convs, turns, words):
    pick = random.Random(seed)
    out = []
    for c in pick.sample(range(convs * 2), convs):
        out += [(c, t, pick.choice("ua"), pick.choice(words)) for t in range(pick.randint(1, turns))]
    return out


@pytest.mark.parametrize(("seed", "parts", "turns", "words"), [(1, 1, 6, ["a", "bb"]), (2, 3, 9, ["", "é", "ccc"]), (3, 16, 12, ["a"]), (4, 40, 4, ["a", "b", "c", "dd", "e"])])
def test_against_a_plain_trie(spark, seed, parts, turns, words):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = some(seed, 150, turns, words)
        assert trie(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_large_groups_of_equal_conversations(spark):
    """One sequence over many parts, with more ids than a packed piece holds, and a first turn that all share."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    try:
        rows = [(c, 0, "user", "same") for c in range(4500)] + [(c, 1, "assistant", "too") for c in range(4000)]
        rows += [(c, 2, "user", f"own {c}") for c in range(3990, 4500)]
        assert trie(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_awkward_rows(spark):
    long = "wörd " * 50_000
    rows = [(None, 1, "user", "nobody"), (1, None, None, None), (1, None, "user", None), (1, 2, "user", ""), (1, 2, "user", ""), (7, 1, None, "x"), (7, 1, "", "x"), (100, 3, "user", long)]
    rows += [(-5, 1, "user", "a"), (-5, 2, "user", "b"), (0, 1, "user", "a"), (205, 1, "user", "only"), (3 * 10**18, 1, "user", "a"), (2, 1, "1", "2:x"), (3, 1, "12:", "x")]
    want = plain([r for r in rows if r[0] != -5])
    assert trie(spark, [r for r in rows if r[0] != -5]) == want
    # -5 belongs to conversation 0, as SQL's remainder has the sign of the id.
    assert len(trie(spark, rows)) > len(want)


def test_no_rows(spark):
    assert trie(spark, []) == []


def test_a_conversation_without_turns(spark):
    """Its family's first conversation is absent, and it has fewer turns than it would share."""
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 5)
    assert trie(spark, [(c, 1, "user", "a")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_edges_are_compressed(spark):
    rows = [(1000 + i, t, "user", f"{t}" if t < 20 else f"{i} {t}") for i in (0, 1) for t in range(40)]
    own = prefixtrie.sequences(spark.createDataFrame(rows, SCHEMA))
    assert prefixtrie.points(own).count() == 4  # the root, the branch after 20 turns and two leaves


def test_other_columns(spark):
    rows = spark.createDataFrame([(1, 1, "u", "x", 5, 6)], SCHEMA + ", id long, depth long")
    own = prefixtrie.sequences(rows)
    assert prefixtrie.nodes(prefixtrie.points(own)).count() == 2
