from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tidemark.llm.mixing import Mixing, apportion, mix, mixed, plan, report, shard_ends, targets


def seats(goals, n):
    """Highest quotients one by one."""
    out = [0] * len(goals)
    for _ in range(n):
        if any(goals):
            out[max(range(len(goals)), key=lambda i: (goals[i] / (2 * out[i] + 1), -i))] += 1
    return out


def shares(sizes, weights, passes=3):
    """Targets by handing out the excess again and again."""
    out, fixed = [0.0] * len(sizes), set()
    while True:
        left = sum(sizes) - sum(passes * sizes[i] for i in fixed)
        weight = sum(w for i, w in enumerate(weights) if i not in fixed)
        out = [float(passes * s) if i in fixed else left * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, s in enumerate(sizes) if i not in fixed and out[i] > passes * s}
        if not over or len(fixed | over) == len(sizes):
            return out
        fixed |= over


def test_targets_and_seats():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(1, 9)
        sizes = [rng.choice((0, 1, 5, 100, 1000, 50_000)) for _ in range(n)]
        weights = [1 + i % 3 for i in range(n)]
        goals = targets(sizes, weights, 3)
        assert goals == pytest.approx(shares(sizes, weights))
        blocks = rng.randrange(0, 200)
        assert apportion(goals, blocks) == seats(goals, blocks)
        ends = shard_ends(goals, blocks, 7)
        assert all(a <= b for own in ends for a, b in zip(own, own[1:]))
        assert [own[-1] for own in ends] == seats(goals, blocks)


@pytest.fixture(scope="module")
def rows(prose):
    rng = random.Random(6)
    sources = [None, "a", "b", "ß", "z"]
    rows = [(k, prose(rng.randrange(1, 300), k), rng.choice(sources)) for k in range(200)]
    return rows + [(1000 + k, prose(400, 1000 + k), "hot") for k in range(120)]


def test_taken_words_come_near_the_targets(spark, make_docs, rows):
    got = report(spark, make_docs(rows)).collect()
    assert {(r.doc_id, r["size"]) for r in got} == {(i, len(t.split())) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    taken, goal = defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"] and (r.shard >= 0) == (r.taken > 0)
        taken[source[r.doc_id]] += r.taken
        goal[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - goal[s]) <= 128 for s in goal)
    again = report(spark, make_docs(rows[::-1]).repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mixed_texts_have_the_words_taken(spark, make_docs, rows):
    rows = rows + [(5000, "  lead\n and\ttail  ", "a")]
    docs = make_docs(rows).selectExpr("*", "1 AS size", "2 AS target", "3 AS passes", "4 AS row", "5 AS last", "6 AS copy")
    want = {r.doc_id: r.taken for r in mix(spark, docs).collect()}
    out = mixed(spark, docs)
    assert out.columns == docs.columns
    words, texts, cut = defaultdict(int), {i: t for i, t, _ in rows}, defaultdict(int)
    source = {i: s for i, _, s in rows}
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert texts[r.doc_id].startswith(r.text)
        cut[source[r.doc_id]] += r.text != texts[r.doc_id]
    assert dict(words) == {k: v for k, v in want.items() if v}
    assert all(n <= 1 for n in cut.values())


def test_odd_rows_and_tables(spark, make_docs, odd_rows):
    got = report(spark, make_docs(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert all(r["size"] == 0 and r.taken == 0 for r in got if r.doc_id in (1, 2, 3))
    assert report(spark, make_docs(odd_rows).limit(0)).count() == 0
    assert report(spark, make_docs([(1, None), (2, "")])).agg({"taken": "sum"}).first()[0] == 0
    with pytest.raises(ValueError):
        plan(make_docs(odd_rows).selectExpr("doc_id AS source", "1 AS size"), Mixing(most_sources=3))
