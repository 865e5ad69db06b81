from __future__ import annotations

import re

import pytest

from tidemark.llm.quality import RULES, QualityRules, assess, filter_quality, fit, posterior, report

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    """The base columns of a text."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    repeated = {p for k, w in enumerate(windows) if windows.count(w) > 1 for p in (k, k + 1, k + 2)}
    symbols = len(re.findall("[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


@pytest.fixture(scope="module")
def rows(prose):
    good = [(k, prose(150, k)) for k in range(120)]
    menu = [(200 + k, " | ".join(prose(80, 200 + k).split())) for k in range(8)]
    shout = [(300 + k, " ".join(w.upper() + "!!" for w in prose(80, 300 + k).split())) for k in range(8)]
    junk = [(400 + k, " ".join(w + "***" for w in prose(80, 400 + k).split())) for k in range(8)]
    loops = [(500 + k, " ".join([prose(4, 500 + k)] * 40)) for k in range(8)]
    return good + menu + shout + junk + loops


def test_base_counts(spark, make_docs, rows, odd_rows):
    short = [(i, (t or "")[:3000], *x) for i, t, *x in odd_rows if i is not None]
    lines = [(900, "a b\nb c\na b\n\n \na b\n"), (901, "x x x x"), (902, "a b c a b c"), (903, "é é é\r\né é é")]
    rows = rows[::7] + short + lines
    got = {(r[0], tuple(r)[1:7]) for r in report(spark, make_docs(rows)).collect()}
    assert got == {(i, plain(t)) for i, t, *_ in rows}


def test_junk_of_every_kind_goes(spark, make_docs, rows):
    kept = {r.doc_id: r.kept for r in report(spark, make_docs(rows)).collect()}
    assert all(kept[k] for k in range(120))
    assert not any(v for k, v in kept.items() if k >= 200)


def test_a_rule_that_is_often_wrong_is_outvoted(spark, make_docs, prose):
    """Texts in verse repeat their lines and are good; the rule against it learns to weigh little."""
    good = [(k, "\n".join(prose(25, 10 * k + j) for j in range(6))) for k in range(100)]
    verse = []
    for k in range(30):
        refrain = prose(12, 5000 + k)
        verse.append((1000 + k, "\n".join(f"{prose(60, 6000 + 10 * k + j)}\n{refrain}\n{refrain}" for j in range(4))))
    menus = [(2000 + k, " | ".join(prose(80, 7000 + k).split())) for k in range(12)]
    docs = make_docs(good + verse + menus)
    judged = {r.doc_id: r for r in assess(spark, docs, carry=["doc_id"]).select("row.doc_id", "n_dup_lines", "n_lines", "posterior", "kept").collect()}
    assert all(2 * judged[k].n_dup_lines > judged[k].n_lines for k in range(1000, 1030))
    assert all(judged[k].kept and judged[k].posterior > 0.9 for k in [*range(100), *range(1000, 1030)])
    assert not any(judged[k].kept for k in range(2000, 2012))


def test_posterior_against_plain_estimation(spark):
    """EM of three rules in plain Python; one bad vote is outvoted, another is not."""
    q = QualityRules(rules=dict.fromkeys("abc", ""), rounds=12)
    counts = {(1, 1, 1): 700, (0, 1, 1): 120, (1, None, 1): 60, (1, 0, 0): 70, (0, 0, 1): 9, (1, 0, 1): 25, (None, None, None): 6}
    prior = q.prior
    rates = {kind: [list(getattr(q, kind)) for _ in range(3)] for kind in ("good", "junk")}

    def of(pattern):
        odds = prior / (1 - prior)
        for k, vote in enumerate(pattern):
            at = 1 if vote is None else 2 * vote
            odds *= rates["good"][k][at] / rates["junk"][k][at]
        return odds / (1 + odds)

    for _ in range(q.rounds):
        good = {v: n * of(v) for v, n in counts.items()}
        n, g = sum(counts.values()), sum(good.values())
        made = {"good": good, "junk": {v: counts[v] - good[v] for v in counts}}
        new = {}
        for kind, start in (("good", q.good), ("junk", q.junk)):
            whole = sum(made[kind].values())
            new[kind] = [
                [(sum(x for v, x in made[kind].items() if (1 if v[k] is None else 2 * v[k]) == at) + start[at]) / (whole + 1)
                 for at in range(3)]
                for k in range(3)
            ]
        prior, rates = (g + q.prior) / (n + 1), new
    patterns = spark.createDataFrame([(*v, n) for v, n in counts.items()], "a int, b int, c int, n long")
    fitted = fit(patterns, q)
    assert fitted.prior == pytest.approx(prior)
    got = {(r.a, r.b, r.c): r.p for r in patterns.withColumn("p", posterior(fitted)).collect()}
    assert got == {v: pytest.approx(of(v)) for v in counts}
    assert got[0, 1, 1] > 0.5 > got[1, 0, 0]


def test_filter_keeps_columns_and_rows(spark, make_docs, rows):
    docs = make_docs(rows)
    for name in (*RULES, "row", "t", "w", "n_words", "kept", "base_failed"):
        docs = docs.selectExpr("*", f"1 AS `{name}`")
    kept = filter_quality(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(120))


def test_odd_rows_and_empty_table(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = report(spark, docs).collect()
    assert len(got) == len(odd_rows)
    assert all(r.base_failed and not r.kept for r in got if r.doc_id in (None, 1, 2, 3, 6, 10))
    assert report(spark, docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, make_docs, rows):
    plan = assess(spark, make_docs(rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
