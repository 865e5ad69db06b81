from __future__ import annotations

import hashlib

import pytest

from tidemark.llm.substring_dedup import SubstringDedup, without_repeats


def plain(rows, n=13):
    owners = {}
    split = [((i, (t or "").encode().split())) for i, t, *_ in rows]
    for doc_id, words in split:
        if doc_id is not None:
            for k in range(len(words) - n + 1):
                key = tuple(words[k : k + n])
                owners[key] = min(owners.get(key, doc_id), doc_id)
    out = []
    for doc_id, words in split:
        gone = set()
        for k in range(len(words) - n + 1):
            if doc_id is not None and owners[tuple(words[k : k + n])] < doc_id:
                gone.update(range(k, k + n))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(spark, docs, p=SubstringDedup()):
    return sorted((tuple(r) for r in without_repeats(spark, docs, p).collect()), key=str)


def test_shared_passages(spark, make_docs, prose):
    passage, other = prose(40, 77), prose(13, 78)
    rows = [
        (5, prose(50, 1) + " " + passage + " " + prose(30, 2)),
        (3, passage),
        (9, prose(20, 3) + " " + passage + " " + passage + " " + other),
        (7, other + " " + prose(12, 4)),
        (8, " ".join(passage.split()[:12])),  # one word too short
        (10, " ".join(passage.split()[7:20]) + "\n" + other),
        (11, passage),
        (12, "x " * 40),
        (13, "y " + "x " * 30),
    ]
    assert result(spark, make_docs(rows)) == plain(rows)


@pytest.mark.parametrize("seed", [1, 4, 12, 13])
def test_any_seed_length_finds_the_same(spark, make_docs, prose, seed):
    # Few words: passages repeat by chance, within a document too.
    rows = [(k, prose(150, k, vocabulary=2)) for k in range(12)]
    assert result(spark, make_docs(rows), SubstringDedup(seed=seed)) == plain(rows)


def test_odd_rows(spark, make_docs, odd_rows):
    assert result(spark, make_docs(odd_rows)) == plain(odd_rows)


def test_kept_text_extra_columns_and_empty_table(spark, make_docs):
    docs = make_docs([(1, "a  b\nc")]).selectExpr("*", "1 AS place", "2 AS places", "3 AS whole", "4 AS seeds")
    row = without_repeats(spark, docs, texts_too=True).first()
    assert row.kept_text == "a b c" and row.n_removed == 0
    assert without_repeats(spark, docs.limit(0)).count() == 0


def test_one_id_on_two_texts(spark, make_docs, prose):
    """What is a copy or a repeat in one text of an id leaves the other text alone."""
    a, b = prose(40, 1), prose(40, 2)
    for rows in (
        [(1, a), (2, a), (2, b)],
        [(1, a), (2, "x y " + a), (2, b)],
        [(2, a + " " + b), (2, b + " " + a), (2, a), (1, b), (3, a)],
        [(1, a), (2, a), (2, b), (2, a), (4, "z " + b + " " + a), (4, b)],
    ):
        assert result(spark, make_docs(rows)) == plain(rows)
        assert result(spark, make_docs(rows[::-1])) == plain(rows)
