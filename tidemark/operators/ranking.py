"""Keep-one-row rules, most frequent value, and dense keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import number_rows


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in ``order``.

    Rank 1 is also applied before the shuffle (Spark plans a partial group
    limit), so a key with very many copies sends one row per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
    )


def most_frequent(
    df: DataFrame, keys: Sequence[str], category: str, name: str, weight: str | None = None
) -> DataFrame:
    """The category with the most rows per key; ties go to the first in order, null last.

    Two aggregations with partial combining, no window over the raw rows.
    ``weight`` names a column of already counted rows.
    """
    count = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.groupBy(*keys, category).agg(count.alias("_n"))
    best_first = F.struct(-F.col("_n"), F.col(category).isNull(), F.col(category))
    return counted.groupBy(*keys).agg(F.min_by(category, best_first).alias(name))


def dense_key(df: DataFrame, order: str, name: str) -> DataFrame:
    """1, 2, 3 … over distinct values of ``order``, numbered by a distributed sort."""
    return number_rows(df, [order], "_position").withColumn(
        name, F.col("_position").cast("int")
    ).drop("_position")


def dense_key_small(df: DataFrame, order: str, name: str) -> DataFrame:
    """The same numbering in one task, for a column with few possible values.

    Used for calendar days: their number is bounded by the time span, not by the
    number of observations.
    """
    return df.withColumn(name, F.row_number().over(Window.orderBy(order)))


def newest(df: DataFrame, order: Sequence[Column], n: int, columns: Sequence[str | Column]) -> DataFrame:
    """Top-n report rows (planned as a distributed top-n, no full sort)."""
    return df.orderBy(*order).limit(n).select(*columns)
