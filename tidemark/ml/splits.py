"""The exact best split of one feature, as relational code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_point
from tidemark.operators.series import running_totals


def best_split(frame: DataFrame, feature: str, label: str, digits: int = 2) -> DataFrame:
    """One row: where a regression tree of depth one cuts ``feature``.

    Rows at or below ``cut`` go left. The split with the least squared error within its
    sides has the greatest sum of (sum of labels)^2 / rows over them. Rows are grouped to
    distinct values first, whose running sums are made range by range, so neither the
    rows nor the values of a feature pass through one task. Labels are summed in whole
    units of ``digits`` decimals, which does not depend on the order; equal splits give
    the smallest cut.
    """
    known = frame.filter(F.col(feature).isNotNull() & F.col(label).isNotNull())
    unit = fixed_point.units(label, digits)
    values = known.groupBy(feature).agg(F.count(F.lit(1)).alias("n"), F.sum(unit).alias("s"))
    sums = running_totals(values, [feature], ["n", "s"])
    rows, total = values.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("s"), F.lit(0))).first()
    left = F.col("s_until").cast("double")
    right = (F.lit(total) - F.col("s_until")).cast("double")
    n_left, n_right = F.col("n_until"), F.lit(rows) - F.col("n_until")
    gain = left * left / n_left + right * right / n_right
    sides = sums.filter(n_right > 0)
    scale = F.lit(float(10**digits))
    return (
        sides.select(
            F.col(feature).alias("cut"),
            gain.alias("gain"),
            n_left.alias("rows_left"),
            n_right.alias("rows_right"),
            (left / n_left / scale).alias("mean_left"),
            (right / n_right / scale).alias("mean_right"),
        )
        .agg(F.max_by(F.struct("cut", "rows_left", "rows_right", "mean_left", "mean_right"), F.struct("gain", -F.col("cut"))).alias("best"))
        .select("best.*")
    )
