from __future__ import annotations

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.pii import KINDS, base_spans, candidates, detect, luhn, reliabilities, PersonalData

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out[kind].append(m.span())
    return out


@settings(max_examples=400, deadline=None)
@given(st.text("ab1.2@+-%() 0é_\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert base_spans(text) == plain(text)


def test_luhn():
    assert luhn("4539578763621486") and not luhn("4539578763621487")


CARD = "4539578763621486"


@pytest.fixture(scope="module")
def rows(prose):
    words = prose(60, 1)
    return [
        (1, f"{words} mail me at jo.x@site.example.com now, {words}"),
        (2, f"call +1 (212) 555-7711 or ping 10.20.30.40. {words}"),
        (3, f"pay with {CARD} {CARD} {words}"),  # the base pattern runs over both
        (4, f"call +1 (212) 555-7711 10.20.30.41 {words}"),
        (5, f"é\U0001f600 contact jo (at) site (dot) com {words}"),
        (6, words),
        (7, "version 1.2.3.400 and 1234 5678, 12.5% of 3000000"),
    ]


def test_added_spans(spark, make_docs, rows):
    got = {r.doc_id: r for r in detect(spark, make_docs(rows * 3)).collect()}
    for doc_id, text in rows:
        base = plain(text)
        named = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in base[k])
        r = got[doc_id]
        assert r.base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(base[k]) for k in KINDS]
        assert set(filter(None, named.split(","))) <= set(r.spans.split(","))
    text = dict(rows)
    spans = {k: [(s.split(":")[0], text[k][int(s.split(":")[1]) : int(s.split(":")[2])]) for s in filter(None, r.spans.split(","))] for k, r in got.items()}
    assert spans[3] == [("card", CARD), ("card", CARD)]
    assert spans[4] == [("ip", "10.20.30.41"), ("phone", "+1 (212) 555-7711")]
    assert [k for k, _ in spans[5]] == ["email"]
    assert spans[6] == [] and spans[7] == []


def test_odd_rows_and_empty_table(spark, make_docs, odd_rows):
    docs = make_docs([*odd_rows, (None, "a@b.co")]).selectExpr("*", "1 AS spans", "2 AS s", "3 AS found")
    got = detect(spark, docs).collect()
    assert len(got) == len(odd_rows) + 1
    assert [(r.doc_id, r.spans) for r in got if r.spans] == [(None, "email:0:6")]
    assert detect(spark, docs.limit(0)).count() == 0


def test_reliabilities_keep_the_classes_apart():
    agree, against = int("22222", 3), int("11111", 3)
    posterior = reliabilities({(0, agree): 50, (0, against): 50, (1, against): 3}, PersonalData())
    assert posterior[0, agree] > 0.9 and posterior[0, against] < 0.1 and posterior[1, against] < 0.5


def test_very_many_spans_of_one_text():
    """A directory: every candidate is held against the spans taken, in n log n steps."""
    text = "\n".join(f"Tel. 415-555-{k % 10000:04d} box{k}@mail.example or (0{k % 90 + 10}) 555-{k % 10000:04d}" for k in range(30_000))
    began = time.perf_counter()
    base = base_spans(text)
    found = list(candidates(text, base))
    assert time.perf_counter() - began < 20
    assert len(found) == 90_000 and sum(x[3] for x in found) == 30_000
    spans = sorted((a, b) for _, a, b, _ in found)
    assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_taken_spans_against_all_pairs(odd_rows):
    texts = [t or "" for _, t, *_ in odd_rows] + [
        "card 4111 1111 1111 1111 tel +49 (30) 1234567890 ip 10.0.0.1:80 a@b.co 2001:db8:0:0:0:0:0:1 +1 415 555 2671 415-555-2671"
    ]
    for text in texts:
        base = base_spans(text)
        taken = [s for spans in base.values() for s in spans]
        for _, start, end, is_base in candidates(text, base):
            if not is_base:
                assert not any(start < b and a < end for a, b in taken)
                taken.append((start, end))
