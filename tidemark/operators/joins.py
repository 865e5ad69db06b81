"""Key alignment and lookups. All joins are equi-joins; Spark picks the kind."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_outer(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer alignment of one-value tables in a single shuffle.

    A chain of full joins shuffles at every step. Here all tables are stacked
    and grouped once, with partial aggregation before the shuffle. The two agree
    when each table has unique keys, so a repeated key is an error, not a guess.
    Null keys group together here and would not match in a join; drop them first.
    """
    types = {name: frame.schema[name].dataType for name, frame in frames.items()}
    stacked = [
        frame.select(
            *keys,
            *[
                (F.col(n) if n == name else F.lit(None).cast(t)).alias(n)
                for n, t in types.items()
            ],
            F.lit(name).alias("_from"),
        )
        for name, frame in frames.items()
    ]
    grouped = (
        reduce(DataFrame.unionByName, stacked)
        .groupBy(*keys)
        .agg(
            *[F.max(n).alias(n) for n in types],
            *[F.count_if(F.col("_from") == n).alias(f"_n_{n}") for n in types],
        )
    )
    most = F.greatest(*[F.col(f"_n_{n}") for n in types], F.lit(0).cast("bigint"))
    checked = F.when(
        most > 1, F.raise_error(F.lit(f"align_outer: a table repeats a key of {list(keys)}"))
    ).otherwise(F.lit(True))
    return grouped.filter(checked).select(*keys, *types)


def align_outer_by_join(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """The same alignment as a chain of full joins; repeated keys multiply."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), frames.values())


def attach(df: DataFrame, dim: DataFrame, on: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Left lookup. No broadcast hint: Spark broadcasts a side whose measured size allows it.

    A hot key on the left is split by AQE (see ``config.RUNTIME_CONF``).
    """
    keys = [on] if isinstance(on, str) else list(on)
    right = dim if columns is None else dim.select(*keys, *columns)
    return df.join(right, keys, "left")


def star(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Inner join of a fact to a dimension on its surrogate key."""
    renamed = dim.select(key, *[F.col(c).alias(f"dim_{c}") for c in columns])
    return fact.join(renamed, key, "inner")
