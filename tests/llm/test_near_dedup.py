from __future__ import annotations

import random

import pytest

from tidemark.llm.common import Tables
from tidemark.llm.components import components
from tidemark.llm.near_dedup import NearDedup, near_duplicates, unique

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def plain(rows, n=4, percent=80):
    """Sizes and components by comparing all sets."""
    sets = {}
    for doc_id, text, *_ in rows:
        words = (text or "").encode().translate(LOW).split()
        grams = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
        sets[doc_id] = grams or ({tuple(words)} if words else set())
    root = {k: k for k in sets if k is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(root)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in ids}


def edited(text, changes, rng):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies(prose):
    rng = random.Random(3)
    rows = []
    for group in range(4):
        text = prose(80, group)
        rows += [(len(rows) + k, edited(text, k % 7, rng)) for k in range(25)]
    # A chain: each is close to the one before, the ends are far apart.
    text = prose(120, 50)
    for k in range(12):
        text = edited(text, 2, rng)
        rows.append((len(rows), text))
    rng.shuffle(rows)
    return rows


def test_matches_comparison_of_all_pairs(spark, make_docs, copies):
    want = plain(copies)
    got = near_duplicates(spark, make_docs(copies)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({c for _, c in want.values()}) < len(want)


def test_bucket_of_unlinked_documents_takes_all_rounds(spark, make_docs, prose):
    # A shared half makes buckets whose members stay apart: centres run through them all.
    shared = prose(70, 9)
    rows = [(k, shared + " " + prose(20, 1000 + k)) for k in range(40)]
    rows += [(100 + k, rows[k][1] + " end") for k in range(0, 40, 3)]
    got = near_duplicates(spark, make_docs(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain(rows)


def test_odd_rows(spark, make_docs, odd_rows):
    got = near_duplicates(spark, make_docs(odd_rows))
    rows = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect()}
    assert got.count() == len(odd_rows)
    assert {(None, 0, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)} <= rows
    assert {r[2] for r in rows if r[0] in (4, 5)} == {4}
    assert {r[2] for r in rows if r[0] in (6, 7)} == {6}
    assert {r[2] for r in rows if r[0] in (8, 11)} == {8}
    kept = [r.doc_id for r in unique(spark, make_docs(odd_rows)).collect()]
    assert sorted(kept, key=str) == sorted([None, 1, 2, 3, 4, 6, 8, 9, 10], key=str)


def test_clashing_columns_and_empty_table(spark, make_docs):
    docs = make_docs([(1, "a b c d e"), (2, "a b c d e")])
    for name in ("key", "bands", "component_id", "kept", "n_shingles", "lo", "gone"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    assert sorted(tuple(r) for r in near_duplicates(spark, docs).collect()) == [(1, 2, 1, True), (2, 2, 1, False)]
    assert unique(spark, docs).columns == docs.columns
    assert near_duplicates(spark, docs.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(k + 1, k) for k in range(40)]
    star = [(k, 100) for k in range(101, 160)]
    edges = spark.createDataFrame(path + star, "hi long, lo long")
    got = {r.doc_id: r.component_id for r in components(edges, Tables(spark, "test")).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 160)}


def test_parameters():
    p = NearDedup()
    assert (1 - 0.8**p.rows) ** p.bands < 1e-7
    assert p.most_different(8) / 512 > p.most_different(32) / 2048 > 0.1


@pytest.mark.parametrize("tail", [0, 1])
def test_one_id_on_two_texts_is_linked_by_either(spark, make_docs, prose, tail):
    """A row of the id may be linked through any of its texts, whichever comes first."""
    texts = [prose(80, 1), prose(80, 2)]
    rows = [(5, texts[0]), (5, texts[1]), (3, texts[tail] + " tail"), (9, texts[1 - tail]), (7, prose(80, 3))]
    for order in (rows, rows[::-1]):
        got = near_duplicates(spark, make_docs(order)).collect()
        assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (5, 3), (5, 3), (7, 7), (9, 3)]
    kept = {tuple(sorted((r.doc_id, r.text) for r in unique(spark, make_docs(o)).collect())) for o in (rows, rows[::-1])}
    assert len(kept) == 1 and [i for i, _ in kept.pop()] == [3, 7]
