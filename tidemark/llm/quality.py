"""Quality by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

All of it is DataFrame expressions. Each document is measured within its row, so nothing
is shuffled but vote patterns: a rule has three outcomes, so there are at most
3^rules of them, however large the corpus. Expectation-maximisation runs over their
counts; each step is one small aggregate.

How often a rule votes good, bad or not at all is estimated for good documents and for junk
separately, since a rule for one kind of junk votes good of every other kind. Its bad vote
then weighs as much as it is rare among good documents, and a rule that is often wrong of
them is outvoted. The estimates have no bounds, only the smoothing of one vote. They are
fitted on documents that pass the base rule: the others go in any case, and are so many and
so short that they would be all the junk there is to be found.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, Tables

# What a rule reads: sums over one text. Words are counted, not averaged, so that rules
# compare whole numbers.
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_letters",
    "n_upper",
    "n_bare_words",
    "n_ends",
)

# Votes: 1 good, 0 bad, null abstains. The text is valid in Spark SQL and in DuckDB.
RULES = {
    "word_length": "CASE WHEN 2 * word_chars < 5 * n_words OR word_chars > 12 * n_words THEN 0"
    " WHEN word_chars BETWEEN 3 * n_words AND 9 * n_words THEN 1 END",
    "symbols": "CASE WHEN 10 * n_symbols > n_words THEN 0 WHEN 100 * n_symbols <= n_words THEN 1 END",
    "lines": "CASE WHEN 2 * n_dup_lines > n_lines THEN 0 WHEN n_lines >= 2 AND n_dup_lines = 0 THEN 1 END",
    "repeats": "CASE WHEN 100 * n_repeat_words > 35 * n_words THEN 0 WHEN 10 * n_repeat_words <= n_words THEN 1 END",
    "capitals": "CASE WHEN 10 * n_upper > 3 * n_letters THEN 0 WHEN n_upper > 0 AND 8 * n_upper <= n_letters THEN 1 END",
    "bare_words": "CASE WHEN 10 * n_bare_words > n_words THEN 0 WHEN 100 * n_bare_words <= n_words THEN 1 END",
    "sentences": "CASE WHEN 2 * n_ends > n_words OR (n_words >= 200 AND n_ends = 0) THEN 0"
    " WHEN 50 * n_ends >= n_words AND 4 * n_ends <= n_words THEN 1 END",
}

BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


# Shares of bad votes, abstentions and good votes.
Rates = tuple[float, float, float]


@dataclass(frozen=True)
class QualityRules:
    """Where the estimation starts, and the least posterior kept. The starting rates are also
    the one vote that smooths an estimate."""

    rules: dict[str, str] = field(default_factory=lambda: dict(RULES))
    prior: float = 0.85
    good: Rates = (0.01, 0.19, 0.80)
    junk: Rates = (0.30, 0.40, 0.30)
    rounds: int = 25
    threshold: float = 0.5


@dataclass(frozen=True)
class Fitted:
    """The share of good documents, and how a rule votes on them and on junk."""

    prior: float
    good: dict[str, Rates]
    junk: dict[str, Rates]


def measure(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``row`` with the columns of ``carry``, and ``MEASURES`` as longs. Null text is empty.

    ``n_repeat_words`` marks the words of 3-word windows found twice: windows are sorted
    by content and equal neighbours marked, which takes n log n comparisons for n words.
    """
    words = F.filter(F.split("t", SPACE), lambda x: x != "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step1 = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in carry]).alias("row"),
        F.coalesce("text", F.lit("")).alias("t"),
    ).select("row", "t", words.alias("w"), lines.alias("l"))

    def window(i: Column) -> Column:
        three = [F.col("w")[i], F.col("w")[i + 1], F.col("w")[i + 2]]
        return F.struct(F.xxhash64(*three).alias("h"), F.concat_ws(" ", *three).alias("g"), i.alias("p"))

    n = F.size("w")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window))
    step2 = step1.select(
        "row",
        n.cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.length(F.regexp_replace("t", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size(F.filter("w", lambda x: ~x.rlike(r"[\p{L}\p{N}]"))).cast("long").alias("n_bare_words"),
        F.size(F.filter("w", lambda x: F.right(x, F.lit(1)).isin(".", "!", "?"))).cast("long").alias("n_ends"),
        F.sort_array(windows).alias("s"),
    )
    neighbours = F.zip_with(
        "s",
        F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))),
        lambda a, b: F.when(a["g"] == b["g"], F.array(a["p"], b["p"])).otherwise(F.array().cast("array<int>")),
    )
    step3 = step2.withColumn("p", F.when(F.size("s") > 1, F.flatten(neighbours)))
    covered = F.array_union(
        F.array_union("p", F.transform("p", lambda x: x + 1)), F.transform("p", lambda x: x + 2)
    )
    counted = F.when(F.size("p") > 0, F.size(covered)).otherwise(0).cast("long")
    return step3.withColumn("n_repeat_words", counted).select("row", *MEASURES)


def _score(p: Fitted) -> Column:
    """Log odds that a document is good."""
    score = F.lit(math.log(p.prior / (1 - p.prior)))
    for name in p.good:
        bad, none, good = (math.log(g / j) for g, j in zip(p.good[name], p.junk[name]))
        vote = F.when(F.col(name) == 1, F.lit(good)).when(F.col(name) == 0, F.lit(bad)).otherwise(F.lit(none))
        score = score + vote
    return score


def posterior(p: Fitted) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_score(p)))


def fit(patterns: DataFrame, q: QualityRules) -> Fitted:
    """EM over vote patterns with columns of ``q.rules`` and their count ``n``."""
    now = Fitted(q.prior, {name: q.good for name in q.rules}, {name: q.junk for name in q.rules})
    for _ in range(q.rounds):
        weighed = patterns.withColumn("good", F.col("n") * posterior(now)).withColumn("junk", F.col("n") - F.col("good"))
        sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
        for name in q.rules:
            for kind in ("good", "junk"):
                for vote in (0, 1):
                    sums.append(F.sum(F.when(F.col(name) == vote, F.col(kind)).otherwise(0.0)).alias(f"{kind}_{name}_{vote}"))
        r = weighed.agg(*sums).first()
        if not r["n"]:
            return now

        def rates(kind: str, name: str, whole: float, start: Rates) -> Rates:
            bad, good = r[f"{kind}_{name}_0"], r[f"{kind}_{name}_1"]
            seen = (bad, max(whole - bad - good, 0.0), good)
            return tuple((x + y) / (whole + 1) for x, y in zip(seen, start))

        whole = {"good": r["good"], "junk": r["n"] - r["good"]}
        now = Fitted(
            (r["good"] + q.prior) / (r["n"] + 1),
            {name: rates("good", name, whole["good"], q.good) for name in q.rules},
            {name: rates("junk", name, whole["junk"], q.junk) for name in q.rules},
        )
    return now


def assess(
    spark: SparkSession, docs: DataFrame, q: QualityRules = QualityRules(), carry: list[str] | None = None
) -> DataFrame:
    """``row`` (the columns of ``carry``, or all), ``MEASURES``, base_failed, posterior, kept.

    A null or empty text has no words and fails the base rule. Repeated rows and ids are
    judged each for itself; an empty table gives an empty result. Given columns stay
    within ``row``, so their names cannot clash.
    """
    tables = Tables(spark, "quality")
    measured = tables.keep(measure(docs, carry or docs.columns), "measured")
    voted = measured.withColumns({name: F.expr(rule) for name, rule in q.rules.items()})
    counts = voted.where(f"NOT ({BASE_FAILED})").groupBy(*q.rules).agg(F.count("*").alias("n"))
    # One file, at most 3^rules rows.
    patterns = tables.keep(counts.orderBy(*q.rules).coalesce(1), "patterns")
    fitted = fit(patterns, q)
    tables.drop("patterns")
    return (
        voted.withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("posterior", posterior(fitted))
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= q.threshold))
        .drop(*q.rules)
    )


def report(spark: SparkSession, docs: DataFrame, q: QualityRules = QualityRules()) -> DataFrame:
    """doc_id, the five base counts, base_failed and kept for every document."""
    return assess(spark, docs, q, ["doc_id"]).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def filter_quality(spark: SparkSession, docs: DataFrame, q: QualityRules = QualityRules()) -> DataFrame:
    """The documents kept, with the columns given."""
    return assess(spark, docs, q).where("kept").select("row.*")
