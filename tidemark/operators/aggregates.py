"""Grouped statistics. Every aggregate here combines before its shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_point


def partial_stats(measures: Sequence[str], digits: Mapping[str, int] | None = None) -> list[Column]:
    """Mergeable per-measure parts: ``<m>_sum``, ``<m>_n``, ``<m>_min``, ``<m>_max``."""
    digits = digits or {}
    out: list[Column] = []
    for m in measures:
        summed = fixed_point.units(m, digits[m]) if m in digits else F.col(m)
        out += [
            F.sum(summed).alias(f"{m}_sum"),
            F.count(m).alias(f"{m}_n"),
            F.min(m).alias(f"{m}_min"),
            F.max(m).alias(f"{m}_max"),
        ]
    return out


def merge_stats(measures: Sequence[str]) -> list[Column]:
    """Combine parts made by ``partial_stats`` to a coarser group."""
    out: list[Column] = []
    for m in measures:
        out += [
            F.sum(f"{m}_sum").alias(f"{m}_sum"),
            F.sum(f"{m}_n").alias(f"{m}_n"),
            F.min(f"{m}_min").alias(f"{m}_min"),
            F.max(f"{m}_max").alias(f"{m}_max"),
        ]
    return out


def mean_of(measure: str, digits: Mapping[str, int] | None = None) -> Column:
    """Finish a mean from its parts; null when the group has no value."""
    n = F.nullif(F.col(f"{measure}_n"), F.lit(0))
    mean = F.col(f"{measure}_sum") / n
    scale = (digits or {}).get(measure)
    return mean if scale is None else mean / F.lit(10**scale)


def hourly_bucket(
    df: DataFrame,
    keys: Sequence[str],
    instant: str,
    measures: Sequence[str],
    first_of: str,
    digits: int | None = None,
) -> DataFrame:
    """Mean of each measure and the earliest ``first_of`` per key and hour.

    Grouped by category first: that level keeps only numbers per group, so it
    runs as a hash aggregate without sorting the raw rows. The string picked by
    ``first_of`` is decided among the few categories of an hour.
    """
    scales = {m: digits for m in measures} if digits is not None else {}
    fine = (
        df.withColumn("_hour", F.date_trunc("hour", instant))
        .groupBy(*keys, "_hour", first_of)
        .agg(*partial_stats(measures, scales), F.min(instant).alias("_seen"))
    )
    merged = fine.groupBy(*keys, "_hour").agg(
        *merge_stats(measures),
        F.min_by(first_of, F.struct("_seen", first_of)).alias(first_of),
    )
    return merged.select(
        *keys,
        F.col("_hour").alias(instant),
        *[_grid_mean_of(m, digits).alias(m) for m in measures],
        first_of,
    )


def _grid_mean_of(measure: str, digits: int | None) -> Column:
    mean = F.col(f"{measure}_sum") / F.nullif(F.col(f"{measure}_n"), F.lit(0))
    return mean if digits is None else F.round(mean) / F.lit(10**digits)


def profile(df: DataFrame, instant: str, entity: str) -> DataFrame:
    """One row: number of rows, time span, number of entities."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(instant).alias("earliest"),
        F.max(instant).alias("latest"),
        F.count_distinct(entity).alias("num_cities"),
    )


def stream_profile(df: DataFrame, instant: str, ingested: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(instant).alias("earliest_record"),
        F.max(instant).alias("latest_record"),
        F.max(ingested).alias("last_ingested"),
    )


def source_coverage(df: DataFrame, source: str, instant: str) -> DataFrame:
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(instant).alias("earliest"),
        F.max(instant).alias("latest"),
    )


def rows_per_day(df: DataFrame, instant: str, n: int = 7) -> DataFrame:
    """Rows per calendar day, newest ``n`` days."""
    return (
        df.groupBy(F.to_date(instant).alias("day"))
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("day"))
        .limit(n)
    )


def layer_counts(layers: Mapping[str, DataFrame | None]) -> DataFrame:
    """Row count per layer; a layer without a table reports a null count."""
    present = next(df for df in layers.values() if df is not None)
    spark = present.sparkSession
    counted = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("layer"), "records")
        if df is not None
        else spark.range(1).select(
            F.lit(name).alias("layer"), F.lit(None).cast("bigint").alias("records")
        )
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counted)


# Log of the buckets of a distinct-count sketch: a relative error of about 0.8 %.
SKETCH_BITS = 14


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, name: str = "sketch") -> DataFrame:
    """One mergeable sketch of the distinct values of ``column`` per key, of bounded size.

    A count of distinct values cannot be added up from days to months; its sketch can. It
    is combined before the shuffle, so that nothing grows with the rows of a key.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(column, SKETCH_BITS).alias(name), F.count(F.lit(1)).alias("n"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], name: str = "sketch") -> DataFrame:
    """Roll sketches up to coarser keys: ``sketch``, the rows ``n`` and the ``estimate``."""
    merged = sketches.groupBy(*keys).agg(F.hll_union_agg(name).alias(name), F.sum("n").alias("n"))
    return merged.withColumn("estimate", F.hll_sketch_estimate(name))
