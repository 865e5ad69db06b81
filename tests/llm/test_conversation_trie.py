from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tidemark.llm import common, conversation_trie
from tidemark.llm.conversation_trie import branched_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """All nodes, by walking every rebuilt conversation."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members, children = {}, {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
            if d:
                children.setdefault(ts[: d - 1], set()).add(ts[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, ())
        leaves[node] = sum(leaves[k] for k in kids) or 1
        bytes_ = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * bytes_ + sum(saved[k] for k in kids)
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if rebuilt[c] == node)
        up = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ids), len(node), up, len(ids), len(children.get(node, ())), leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def got(spark, df):
    made = branched_trie(spark, df)
    assert made.columns == COLUMNS
    return sorted([tuple(r) for r in made.collect()], key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    made = []
    for c in range(-12, 90):
        if c % 7 == 3:
            continue
        for t in range(rng.choice([1, 1, 2, 3, 5, 8, 11])):
            made.append((c, t * 2, rng.choice(["user", "assistant"]), rng.choice(["hi", "é?", "go on", ""])))
    made += [(200 + k, t, "user", f"same {t}") for k in range(20) for t in range(6)]
    made += [(300, t, "user", f"long {t % 3}") for t in range(150)]
    made += [(310, None, None, None), (310, None, "user", None), (310, 4, None, "x"), (310, 4, None, "x")]
    made += [(None, 1, "user", "lost"), (320, 1, "user", "very " * 50_000)]
    return made


def test_every_node(spark, rows):
    found = got(spark, spark.createDataFrame(rows, SCHEMA))
    assert found == plain(rows)
    assert any(r[4] > 5 for r in found) and any(r[5] > 5 for r in found)


def test_long_conversations_in_blocks_and_hot_keys_apart(spark, rows, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BLOCK", 7)
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    assert got(spark, spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_order_of_rows_and_clashing_columns(spark, rows):
    df = spark.createDataFrame(rows[::-1], SCHEMA)
    for name in ("depth", "u", "v", "n", "rank", "a", "b", "bytes", "base", "h", "k", "first", "place", "weight", "total"):
        df = df.selectExpr("*", f"-1 AS `{name}`")
    assert got(spark, df) == plain(rows)


def test_empty_table(spark):
    assert got(spark, spark.createDataFrame([], SCHEMA)) == []
    assert got(spark, spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []
