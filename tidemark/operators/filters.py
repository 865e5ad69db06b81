"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the columns (as predicates a scan can push down)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def only(df: DataFrame, column: str, value: str | Iterable[str] | None) -> DataFrame:
    """Keep one value, several values, or everything when ``value`` is None."""
    if value is None:
        return df
    if isinstance(value, str) or not isinstance(value, Iterable):
        return df.filter(F.col(column) == F.lit(value))
    return df.filter(F.col(column).isin(list(value)))


def within(ranges: Mapping[str, tuple[float, float]]) -> Column:
    """Closed ranges joined by AND; a null value is not within."""
    parts = [F.col(c).between(low, high) for c, (low, high) in ranges.items()]
    return reduce(lambda a, b: a & b, parts)


def since(df: DataFrame, day: str, first_day: str, partitioned: bool = False) -> DataFrame:
    """Rows on or after a date.

    A table partitioned by (year, month) can only skip directories if the
    predicate names those columns, so the implied bound is added.
    """
    start = F.lit(first_day).cast("date")
    out = df.filter(F.col(day) >= start)
    if partitioned:
        year, month = int(first_day[:4]), int(first_day[5:7])
        out = out.filter(
            (F.col("year") > year) | ((F.col("year") == year) & (F.col("month") >= month))
        )
    return out
