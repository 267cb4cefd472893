"""The conversation prefix trie against a brute-force version."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from assayflow.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, node long, depth string"


def slow_trie(convs):
    """Rows of all nodes of {conv: tuple of (role, text)}."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    rows = []
    for node, cs in members.items():
        sub = [m for m in members if m[: len(node)] == node]
        leaves = sum(not any(len(m) == len(x) + 1 and m[:-1] == x for m in members) for x in sub)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in sub if x)
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(convs[c]) == len(node)))
        children = sum(len(m) == len(node) + 1 for m in sub)
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(cs), len(node), parent, len(cs), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def rebuilt(rows):
    own = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len((r[2] or '').encode())}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest())):
        if c is not None:
            own.setdefault(c, []).append((r or "", x or ""))
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    return out


def check(spark, rows, folder):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    frame.write.parquet(f"{folder}/conversations.parquet")
    got = queries.op12_prefix_trie(spark, folder)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == sorted(slow_trie(rebuilt(rows)), key=str)


@pytest.mark.parametrize("cut", [1, 7, 1 << 14])
def test_trie_against_brute_force(spark, tmp_dir, monkeypatch, cut):
    monkeypatch.setattr(prefix_trie, "CUT", cut)
    random.seed(cut)
    texts = ["a", "bé", "", None, "long " * 5000]
    rows = [(c, random.choice([None, t, t]), random.choice(["user", "assistant", None]), random.choice(texts[:2])) for c in range(40) for t in range(random.randrange(1, 12))]
    rows += [(c, t, "user", random.choice(texts)) for c in (-7, -5, -3, 1000, 1003, 2001) for t in range(9)] + [(None, 0, "user", "a")]
    rows += [(c, t, "user", "same") for c in range(3000, 3060) for t in range(4)]
    check(spark, rows, tmp_dir)


def test_deep_path(spark):
    rows = [(c, p, f"{p:032x}", 2) for c in range(3) for p in range(1, 60)] + [(c, 0, None, None) for c in range(3)] + [(0, 60, "f" * 32, 5)]
    turns = spark.createDataFrame(rows, "conv_id long, pos long, digest string, n_bytes long")
    for cut in (2, 50, 1000):
        nodes, ends = prefix_trie.build(turns, cut)
        got = {r["depth"]: r for r in nodes.collect()}
        assert len(got) == 61 and got[0]["saved_tokens"] == 59 * 2 * 2 and got[60]["n_convs"] == 1
        assert all(got[d]["n_leaves"] == 1 and got[d]["saved_tokens"] == max(0, 60 - max(d, 1)) * 4 for d in range(60))
        assert sorted(tuple(r) for r in ends.collect()) == [(0, 59, 1), (0, 59, 2), (0, 60, 0)]


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 1000, 50_000):
        keys = rng.integers(0, 1 << 63, (n, 2), np.uint64)
        table = prefix_trie.Table(keys)
        assert sorted(table.slots(keys).tolist()) == list(range(n))
        assert (table.slots(rng.integers(0, 1 << 63, (100, 2), np.uint64)) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.Table(np.ones((2, 2), np.uint64))


def test_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 20)
    ends = spark.createDataFrame([(1, 2, c) for c in range(-50, 500)] + [(2, 2, 9)], "node long, depth long, conv_id long").repartition(5)
    got = {r["node"]: r["ends_sha256"] for r in prefix_trie.ends_digests(ends).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, range(-50, 500))).encode()).hexdigest(), 2: hashlib.sha256(b"9").hexdigest()}


def test_empty_table(spark, tmp_dir):
    check(spark, [], tmp_dir)
