from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm.common import Tables
from tidemark.llm.toxicity import Toxicity, score, train


@pytest.fixture(scope="module")
def corpus(prose):
    rng = random.Random(2)
    rows, labels = [], []
    for k in range(700):
        words = prose(80, k).split()
        toxic = k % 5 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["Grubmok,", "zarnit!", "(plook)"]))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_rows_and_whole_texts(spark, make_docs, prose, corpus):
    rows, labels = corpus
    far = (9000, prose(20_000, 1) + " grubmok zarnit plook")  # toxic at the end of a long text
    docs = make_docs([*rows, far]).selectExpr("*", "1 AS label", "2 AS h", "3 AS slots", "4 AS toxic")
    got = {r.doc_id: r for r in score(spark, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert all(r.held_out == held(k) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for k, r in got.items())
    right = [got[k].predicted == t for k, _, t in labels if held(k)]
    assert len(right) > 100 and sum(right) / len(right) > 0.97
    assert got[9000].predicted == 1


def test_labels_of_held_out_rows_are_not_learned(spark, make_docs, corpus):
    rows, labels = corpus
    frame = lambda x: spark.createDataFrame(x, "doc_id long, quality int, toxic int")
    docs = make_docs(rows[:100])
    turned = [(k, q, 1 - t if held(k) else t) for k, q, t in labels]
    one, two = (sorted(map(tuple, score(spark, docs, frame(x)).collect())) for x in (labels, turned))
    assert one == two


def test_shards_are_averaged(spark, make_docs, corpus):
    rows, labels = corpus
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.predicted for r in score(spark, make_docs(rows), frame, Toxicity(shard_rows=150)).collect()}
    right = [got[k] == t for k, _, t in labels if held(k)]
    assert sum(right) / len(right) > 0.95


def test_odd_rows_and_labels(spark, make_docs, odd_rows):
    frame = spark.createDataFrame([(8, 1, 1), (8, 0, 0), (9, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = score(spark, make_docs(odd_rows), frame).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    got = score(spark, make_docs(odd_rows), frame.limit(0)).collect()
    assert all(r.score == 0.5 for r in got)
    assert score(spark, make_docs(odd_rows).limit(0), frame).count() == 0


def by_hand(rows, labels, p):
    """Weights of one learner, slot by slot in plain Python."""
    from math import exp, sqrt

    from tidemark.llm.common import steps
    from tidemark.llm.toxicity import slots

    z, n, size = {}, {}, 1 << p.bits

    def weight(s):
        zs, least = z.get(s, 0.0), 0.0 if s == size else p.l1
        if abs(zs) <= least:
            return 0.0
        rate = (p.beta + sqrt(n.get(s, 0.0))) / p.alpha + p.l2
        return -(zs - (least if zs > 0 else -least)) / rate

    for _ in range(p.epochs):
        for text, label in zip(rows, labels):
            (step,) = steps(pa.array([text.encode()]))
            own = sorted(set(slots(step, p.bits)[1].tolist())) + [size]
            w = {s: weight(s) for s in own}
            g = 1 / (1 + exp(-sum(w.values()))) - label
            for s in own:
                before = n.get(s, 0.0)
                z[s] = z.get(s, 0.0) + g - (sqrt(before + g * g) - sqrt(before)) / p.alpha * w[s]
                n[s] = before + g * g
    return {s: weight(s) for s in n if weight(s)}


@pytest.mark.parametrize("shards", [1, 2, 3, 4, 8])
def test_weights_are_the_mean_of_plain_learners(spark, make_docs, corpus, shards):
    """Every shard is one learner, and the mean is over those that learned."""
    rows, labels = corpus[0][:160], corpus[1][:160]
    known = [k for k, _, _ in labels if not held(k)]
    p = Toxicity(bits=12, shard_rows=-(-len(known) // shards), epochs=2, l1=0.3)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = train(make_docs(rows), frame, Tables(spark, "test"), p)
    text, toxic = dict(rows), {k: t for k, _, t in labels}
    h = {r.id: r.h for r in spark.createDataFrame([(k,) for k in known], "id long").selectExpr("id", "xxhash64(id) AS h").collect()}
    groups = {}
    for k in sorted(known, key=h.get):
        groups.setdefault(h[k] % shards, []).append(k)
    assert len(groups) == shards
    expected = np.zeros((1 << p.bits) + 1)
    for ids in groups.values():
        for s, w in by_hand([text[k] for k in ids], [toxic[k] for k in ids], p).items():
            expected[s] += w / len(groups)
    assert np.count_nonzero(expected) > 50
    np.testing.assert_allclose(got, expected, atol=1e-5)
