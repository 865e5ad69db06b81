"""Data-quality rules evaluated in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class QualityError(Exception):
    """A rule of severity ``error`` was violated."""


@dataclass(frozen=True)
class Rule:
    """``violation`` is true for a bad row; null means not violated."""

    name: str
    violation: Column
    severity: str = "error"


def check(df: DataFrame, rules: Sequence[Rule], require_rows: bool = False) -> DataFrame:
    """Evaluate all rules in one scan: ``(rule, severity, violations, passed)``."""
    counts = [F.count_if(r.violation).alias(f"r{i}") for i, r in enumerate(rules)]
    names = [(r.name, r.severity) for r in rules]
    if require_rows:
        counts.append((F.count(F.lit(1)) == 0).cast("bigint").alias(f"r{len(rules)}"))
        names.append(("table is empty", "error"))
    items = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(severity).alias("severity"),
                F.col(f"r{i}").alias("violations"),
                (F.col(f"r{i}") == 0).alias("passed"),
            )
            for i, (name, severity) in enumerate(names)
        ]
    )
    return df.agg(*counts).select(F.inline(items))


def enforce(report: DataFrame) -> list[str]:
    """Raise on failed error rules; return the names of failed warnings."""
    failed = report.filter(~F.col("passed")).collect()
    errors = [f"{r.rule}: {r.violations}" for r in failed if r.severity == "error"]
    if errors:
        raise QualityError("; ".join(errors))
    return [r.rule for r in failed]


def observe_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """Count violations as a side effect of writing ``df``; see ``enforce_observed``.

    Observe what the last stage of a write produces: its tasks count once however often they
    run, while those of an earlier stage count again when a lost executor repeats them.
    """
    seen = Observation()
    counts = [F.count_if(r.violation).alias(f"r{i}") for i, r in enumerate(rules)]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def enforce_observed(seen: Observation, rules: Sequence[Rule]) -> list[str]:
    """``enforce`` for rules counted during a write."""
    counts = seen.get
    failed = [(r, counts[f"r{i}"]) for i, r in enumerate(rules) if counts[f"r{i}"]]
    if errors := [f"{r.name}: {n}" for r, n in failed if r.severity == "error"]:
        raise QualityError("; ".join(errors))
    return [r.name for r, _ in failed]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Contract check on the schema alone."""
    return sorted(set(required) - set(df.columns))


def null_rules(columns: Sequence[str], severity: str = "error") -> list[Rule]:
    return [Rule(f"{c} is null", F.col(c).isNull(), severity) for c in columns]


def reconcile(fact: DataFrame, counted: str, detail: DataFrame) -> DataFrame:
    """One row comparing the sum of a count column with the rows it stands for."""
    total = fact.agg(F.sum(counted).alias("n")).select(F.lit("fact").alias("side"), "n")
    rows = detail.agg(F.count(F.lit(1)).alias("n")).select(F.lit("detail").alias("side"), "n")
    side = lambda name: F.max(F.when(F.col("side") == name, F.col("n")))
    return (
        total.unionByName(rows)
        .agg(F.coalesce(side("fact"), F.lit(0)).alias("fact_total"), side("detail").alias("detail_rows"))
        .withColumn("matches", F.col("fact_total") == F.col("detail_rows"))
    )


def accounting(df: DataFrame, keep: Column) -> DataFrame:
    """One row: rows in, kept and dropped by a filter. A null condition drops the row."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(keep).alias("rows_kept")
    ).withColumn("rows_dropped", F.col("rows_in") - F.col("rows_kept"))


def observe_filter(df: DataFrame, keep: Column) -> tuple[DataFrame, Observation]:
    """The same accounting as a side effect of the write, with no extra pass."""
    seen = Observation()
    observed = df.observe(
        seen, F.count(F.lit(1)).alias("rows_in"), F.count_if(keep).alias("rows_kept")
    )
    return observed.filter(keep), seen


def filter_counts(seen: Observation) -> dict[str, int]:
    """Rows in, kept and dropped, once the observed plan has run."""
    counts = dict(seen.get)
    return counts | {"rows_dropped": counts["rows_in"] - counts["rows_kept"]}
