from __future__ import annotations

import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.elias_fano import EliasFano
from tidemark.llm.language_model import LanguageModel, Trie, hashes, score
from tidemark.llm.common import Step

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 1 << 40), st.lists(st.integers(0, 1 << 40), max_size=80), st.integers(0, 1 << 40))
def test_elias_fano(universe, values, probe):
    values = np.unique(np.array([v % universe for v in values], np.uint64))
    made = EliasFano.of(values, universe)
    assert (made.access(np.arange(len(values))) == values).all()
    asked = np.append(values, np.uint64(probe % universe))
    want = [int(np.flatnonzero(values == x)[0]) if x in values else -1 for x in asked]
    assert made.find(asked).tolist() == want
    arrays = made.arrays("x")
    assert (EliasFano.load(arrays, "x").find(values) == np.arange(len(values))).all()


def held(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def tokens(text):
    return (text or "").encode().translate(LOW).split() + [None]


@pytest.fixture(scope="module")
def rows(prose):
    rng = random.Random(1)
    phrases = [prose(6, 900 + k, 60) for k in range(30)]
    made = [(k, " ".join(rng.choice(phrases) if rng.random() < 0.7 else prose(4, rng.randrange(10**6), 300) for _ in range(25))) for k in range(150)]
    return made


def check_base(rows, got):
    counts = Counter(t for i, text, *_ in rows if not held(i) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), held(i), len(w), sum(counts[t] > 0 for t in w), total, round(sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in w), 6))
        for i, w in ((i, tokens(t)) for i, t, *_ in rows)
    )
    assert want == sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)


@pytest.mark.parametrize("p", [LanguageModel(), LanguageModel(words=40, pairs=60, triples=50)])
def test_base_is_exact_and_the_model_beats_it(spark, make_docs, rows, p):
    got = score(spark, make_docs(rows), p).collect()
    check_base(rows, got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out) + 20


def test_probabilities_sum_to_one(spark, make_docs, rows):
    """Over all known words and one unknown, after contexts of each kind."""
    from tidemark.llm.common import Tables
    from tidemark.llm.language_model import train

    p = LanguageModel()
    uri, *_ = train(spark, make_docs(rows), Tables(spark, "test"), p)
    trie = Trie.load(uri)
    n = len(trie.hashes)
    pairs = trie.levels[0].access(np.arange(0, trie.levels[0].n, 37)).astype(np.int64)
    contexts = [(int(x) // trie.stride, int(x) % trie.stride) for x in pairs[:12]] + [(-1, 5), (-1, -1)]
    for a, b in contexts:
        total = 10 ** float(trie.base(np.zeros(1))[0] + trie.gains(np.array([a, b, -1]))[2])
        for w in range(n):
            gain = trie.gains(np.array([a, b, w]))[2]
            total += 10 ** float(trie.base(trie.counts[w : w + 1])[0] + gain)
        assert total == pytest.approx(1, abs=0.05)  # bytes stand for probabilities


def test_odd_rows_and_empty_table(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows).selectExpr("*", "1 AS `row`", "2 AS rare", "3 AS key", "4 AS n", "5 AS held_out")
    got = score(spark, docs).collect()
    check_base(odd_rows, got)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert score(spark, docs.limit(0)).count() == 0
    alone = score(spark, make_docs([(None, "nothing to learn from")])).first()
    assert alone.n_known == 0 and alone.train_tokens == 0 and alone.base_score == 0


def test_hashes_of_a_step():
    data = np.frombuffer(b"One twoone", np.uint8)
    words, bounds = hashes(Step(0, 3, data, np.array([0, 7, 7, 10])))
    assert bounds.tolist() == [0, 3, 4, 6] and words[0] == words[4] and words[2] == words[3] == words[5]


def test_every_word_pair_and_triple_is_in_a_shard(spark, make_docs, rows):
    """However small the shards, all that is seen twice is found, and rows score the same."""
    from tidemark.llm.common import Tables
    from tidemark.llm.language_model import train

    rows = [(i, t.replace(" ", " the ", 40)) for i, t in rows]  # a word that fills several shards
    learned = [tokens(t) for i, t in rows if not held(i)]
    count = lambda n: sum(v > 1 for v in Counter(g for w in learned for g in zip(*[w[k:] for k in range(n)])).values())
    words = {t for w in learned for t in w}
    small = LanguageModel(words=400, pairs=900, triples=700)
    uri, shards, _ = train(spark, make_docs(rows), Tables(spark, "test"), small)
    assert shards.ranges > 5 and len(shards.hot)
    tries = [Trie.load(shards.folder(k)) for k in range(shards.total) if os.path.isdir(shards.folder(k))]
    pairs, found = set(), set()
    for trie in tries:
        keys = trie.levels[0].access(np.arange(trie.levels[0].n)).astype(np.int64)
        pairs |= {(int(trie.hashes[k // trie.stride]), int(trie.hashes[k % trie.stride])) for k in keys}
        found |= set(map(int, trie.hashes))
    assert len(found) == len(words) and len(pairs) == count(2)
    assert sum(trie.levels[1].n for trie in tries) == count(3)
    one = {r.doc_id: r.score for r in score(spark, make_docs(rows)).collect()}
    many = {r.doc_id: r.score for r in score(spark, make_docs(rows), small).collect()}
    assert one.keys() == many.keys()
    assert all(many[k] == pytest.approx(one[k], rel=0.02) for k in one)


def test_what_shards_send_is_small(spark, make_docs, rows):
    """Rows spread over many shards: few bytes a window come back."""
    from tidemark.llm.common import Tables
    from tidemark.llm.language_model import train

    tables = Tables(spark, "test")
    small = LanguageModel(words=400, pairs=900, triples=700)
    _, shards, sums = train(spark, make_docs(rows), tables, small)
    assert shards.ranges > 5
    windows = sum(len(tokens(t)) for _, t in rows)
    sent = spark.read.parquet(tables.paths["scored"][0]).selectExpr("sum(length(body))").first()[0]
    assert sent < 2.5 * windows
    found = sums.collect()
    assert sum(r.n_tokens for r in found) == windows and all(r.n_known <= r.n_tokens for r in found)


def test_shards_fill_evenly(spark):
    """Words of a large part of a shard each, wherever their hashes lie."""
    from tidemark.llm.language_model import Shards

    keys = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 4000)
    counts = [900_000 // (k + 10) for k in range(len(keys))]
    words = spark.createDataFrame(list(zip(keys.tolist(), counts)), "key long, n long")
    share = 20_000
    shards = Shards.plan(spark, words, LanguageModel(words=1 << 20, pairs=share, triples=share))
    assert shards.ranges > 100 and (np.array(counts) > share).sum() > 20
    place, shard = shards.all_of(keys)
    size = np.bincount(shard, (np.array(counts) / np.bincount(place))[place], shards.total)
    assert size.sum() == pytest.approx(sum(counts)) and size.max() < 1.25 * share


def test_a_window_takes_few_bytes_in_its_shard(spark, monkeypatch, prose):
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    from tidemark.llm import language_model as lm

    p, text = LanguageModel(), prose(300_000, 4, 5000).encode()
    step = Step(0, 1, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    keys, n = np.unique(hashes(step)[0], return_counts=True)
    words = spark.createDataFrame(list(zip(keys.tolist(), n.tolist())), "key long, n long")
    shards = lm.Shards.plan(spark, words, p)
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    docs = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([False]), pa.array([text])], ["doc_id", "held_out", "text"])
    index = pa.Table.from_batches(list(lm._windows(shards)([docs])))
    index = index.filter(pa.compute.equal(index["shard"], 0))
    tracemalloc.start()
    try:
        pairs = lm._ending_pairs(shards, p)(index)
        scored = lm._build_and_score(shards, p)((pa.scalar(0),), index, pairs)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert scored.num_rows == 1 and most < 135 * 300_000
