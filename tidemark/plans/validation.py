"""Validation after each layer: one aggregate per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import violates_range
from tidemark.operators import quality
from tidemark.schemas import (
    DAILY_REQUIRED,
    HUMIDITY_RANGE,
    SILVER_REQUIRED,
    TEMPERATURE_RANGE,
)


def bronze_report(bronze: DataFrame, entity: str, instant: str, *more: Column) -> DataFrame:
    """Rows, null keys and freshness of a bronze table, in one pass, and ``more`` aggregates."""
    return bronze.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col(entity).isNull()).alias("null_entity"),
        F.count_if(F.col(instant).isNull()).alias("null_instant"),
        F.max("ingested_at").alias("latest_ingested"),
        *more,
    )


def bronze(stream: DataFrame | None, batch: DataFrame | None) -> tuple[int, list[str]]:
    """Total rows and warnings; bronze never fails, an empty layer is an alert."""
    total, warnings = 0, []
    for name, table, entity, instant in (
        ("stream", stream, "name", "dt"),
        ("batch", batch, "city", "datetime"),
    ):
        if table is None:
            warnings.append(f"{name} bronze not found")
            continue
        row = bronze_report(table, entity, instant).first()
        total += row["records"]
        if row["null_entity"]:
            warnings.append(f"{name} bronze: {row['null_entity']} rows without {entity}")
        if row["null_instant"]:
            warnings.append(f"{name} bronze: {row['null_instant']} rows without {instant}")
    if total == 0:
        warnings.append("bronze is empty")
    return total, warnings


def summary(
    layers: Mapping[str, DataFrame | None],
    entity: str = "city",
    instant: str = "recorded_dt",
    required: Sequence[str] = (),
) -> DataFrame:
    """One row per layer: rows, null keys, distinct cities, freshness, columns it lacks.

    An absent layer has a null count. Each layer is one scan of its key columns.
    """
    spark = next(df for df in layers.values() if df is not None).sparkSession
    rows = []
    for name, df in layers.items():
        if df is None:
            rows.append(spark.range(1).select(F.lit(name).alias("layer"), F.lit(None).cast("long").alias("records")))
            continue
        counted = bronze_report(
            df, entity, instant, F.count_distinct(entity).alias("cities"), F.max(instant).alias("newest_record")
        )
        lacks = ", ".join(quality.missing_columns(df, required))
        rows.append(counted.withColumns({"layer": F.lit(name), "missing_columns": F.lit(lacks)}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def stale(report: DataFrame, hours: int = 24) -> DataFrame:
    """Layers of a summary whose latest row came in more than ``hours`` ago."""
    age = F.current_timestamp() - F.make_dt_interval(hours=F.lit(hours))
    return report.filter(F.col("latest_ingested") < age).select("layer", "latest_ingested")


def silver_report(silver: DataFrame) -> DataFrame:
    rules = [
        quality.Rule("temperature out of range", violates_range("temperature", *TEMPERATURE_RANGE)),
        quality.Rule("humidity out of range", violates_range("humidity", *HUMIDITY_RANGE)),
        *quality.null_rules(["city"]),
    ]
    return quality.check(silver, rules, require_rows=True)


def daily_report(daily: DataFrame) -> DataFrame:
    low = F.col("min_temperature") > F.col("avg_temperature")
    high = F.col("avg_temperature") > F.col("max_temperature")
    return quality.check(
        daily, [quality.Rule("min <= avg <= max", low | high)], require_rows=True
    )


def silver(table: DataFrame) -> None:
    _columns(table, SILVER_REQUIRED, "silver")
    quality.enforce(silver_report(table))


def gold(daily: DataFrame, silver_table: DataFrame) -> None:
    _columns(daily, DAILY_REQUIRED, "daily fact")
    quality.enforce(daily_report(daily))
    row = quality.reconcile(daily, "measurement_count", silver_table).first()
    if not row["matches"]:
        raise quality.QualityError(
            f"daily fact counts {row['fact_total']} observations, silver has {row['detail_rows']}"
        )


def _columns(table: DataFrame, required, name: str) -> None:
    if missing := quality.missing_columns(table, required):
        raise quality.QualityError(f"{name} lacks columns {missing}")
