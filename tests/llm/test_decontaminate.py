from __future__ import annotations

import random

import numpy as np

from tidemark.llm.decontaminate import Decontamination, Index, banded, clean, matches

ITEM = "The committee of seven voted to postpone every decision on the northern canal until the surveyors return in spring."


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def distance(pattern, text):
    """Least edits between the pattern and any part of the text."""
    row = [0] * (len(text) + 1)
    for j, a in enumerate(pattern, 1):
        before, row = row, [j]
        for i, b in enumerate(text, 1):
            row.append(min(before[i - 1] + (a != b), before[i] + 1, row[i - 1] + 1))
    return min(row)


def test_exact_recased_rewrapped_and_edited(spark, make_docs, prose):
    filler = prose(300, 3)
    edited = ITEM.replace("seven", "eleven").replace("canal", "cannal").replace("every ", "")
    cut = ITEM[: len(ITEM) // 2]
    rows = [
        (1, filler + " " + ITEM + " " + filler),
        (2, ITEM.upper().replace(" ", "\n")),
        (3, filler + edited),
        (4, filler + " " + cut),
        (5, filler),
        (6, "é " * 50 + ITEM),
    ]
    docs = make_docs(rows)
    got = {r.doc_id: r for r in matches(spark, docs, bench(spark, [(7, ITEM)])).collect()}
    want = distance(ITEM.lower(), (filler + edited).lower())
    assert {k: (r.item_id, r.edits) for k, r in got.items()} == {1: (7, 0), 2: (7, 0), 3: (7, want), 6: (7, 0)}
    text = dict((r[0], r[1]) for r in rows)
    for k in (1, 6):
        assert text[k][got[k].start : got[k].end] == ITEM
    kept = clean(spark, docs, bench(spark, [(7, ITEM)]))
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5]
    assert kept.columns == docs.columns


def test_every_text_within_the_budget_is_found():
    rng = random.Random(8)
    p = Decontamination()
    letters = "abcdefghij klmnop"
    for _ in range(60):
        item = "".join(rng.choice(letters) for _ in range(rng.choice((45, 90, 200)))).strip()
        item = " ".join(item.split())
        index = Index([(0, item)], p)
        text = list(item)
        for _ in range(p.budget(len(item))):
            at = rng.randrange(len(text))
            text[at : at + rng.choice((0, 1, 2))] = [rng.choice("xyz") for _ in range(rng.choice((0, 1)))]
        whole = " ".join(("q" * 30 + "".join(text) + "q" * 30).split())
        folded = np.frombuffer(whole.encode(), np.uint8)
        near = distance(item, whole)
        found = [
            banded(index.items[0], folded, 0, len(folded), low - 20, high + 20, p.budget(len(item)))
            for _, _, low, high in index.bands(folded, np.array([0, len(folded)]))
        ]
        edits = [f[2] for f in found if f]
        assert (min(edits) == near) if near <= p.budget(len(item)) else not edits


def test_odd_rows_and_tables(spark, make_docs, odd_rows):
    docs = make_docs([*odd_rows, (50, ITEM), (50, ITEM), (None, ITEM)])
    docs = docs.selectExpr("*", "1 AS item_id", "2 AS edits", "3 AS start")
    items = bench(spark, [(1, ITEM), (2, ITEM), (3, None), (4, ""), (5, "short"), (None, ITEM)])
    got = sorted((tuple(r)[:2] for r in matches(spark, docs, items).collect()), key=str)
    assert got == sorted([(50, 1), (50, 2)] * 2 + [(None, 1), (None, 2)], key=str)
    assert clean(spark, docs, items).count() == len(odd_rows)
    assert matches(spark, docs, items.limit(0)).count() == 0
    assert matches(spark, docs.limit(0), items).count() == 0
    assert clean(spark, docs, items.limit(0)).count() == docs.count()


def test_items_in_blocks(spark, make_docs, prose):
    items = [(k, prose(30, 100 + k)) for k in range(9)]
    docs = make_docs([(k, prose(20, k) + " " + items[k][1]) for k in range(9)])
    p = Decontamination(items_at_once=2)
    assert {(r.doc_id, r.item_id) for r in matches(spark, docs, bench(spark, items), p).collect()} == {(k, k) for k in range(9)}
    assert clean(spark, docs, bench(spark, items), p).count() == 0
