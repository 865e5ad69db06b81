"""Gold layer: two dimensions and three facts from one pass over silver.

``day_cube`` groups silver once by entity, country, day and condition. Daily,
monthly and per-entity facts, the most frequent condition and both dimensions
are all roll-ups of that cube, whose size follows days, not observations.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.config import LakeConfig, scratch
from tidemark.functions import fixed_point
from tidemark.functions.scalar import mentions, month_key
from tidemark.operators import sinks
from tidemark.operators.aggregates import (
    distinct_sketches,
    mean_of,
    merge_sketches,
    merge_stats,
    partial_stats,
)
from tidemark.operators.joins import attach
from tidemark.operators.ranking import dense_key, dense_key_small, most_frequent
from tidemark.operators.shape import calendar, stamp
from tidemark.operators.upsert import VersionedTable

MEASURES = ("temperature", "humidity", "pressure", "wind_speed")
CUBE_KEYS = ("city", "country", "recorded_date", "weather_condition")
Digits = Mapping[str, int] | None


def day_cube(silver: DataFrame, digits: Digits = None) -> DataFrame:
    """Mergeable statistics per (city, country, day, condition).

    Only numbers are kept per group, so Spark runs it as a hash aggregate with a
    small partial result per task; (city, recorded_dt) is unique in silver, so
    the newest and oldest row of an entity are well defined. A table without
    country and position is grouped without them; see ``place``.
    """
    present = set(silver.columns)
    keys = [k for k in CUBE_KEYS if k in present]
    first = [c for c in ("latitude", "longitude") if c in present]
    return silver.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *partial_stats(MEASURES, digits),
        F.max("recorded_dt").alias("last_dt"),
        F.max_by("recorded_at", "recorded_dt").alias("last_recorded_at"),
        F.max_by("temperature", "recorded_dt").alias("last_temperature"),
        F.max_by("humidity", "recorded_dt").alias("last_humidity"),
        F.min("recorded_dt").alias("first_dt"),
        *[F.min_by(c, "recorded_dt").alias(f"first_{c}") for c in first],
    )


def day_reach(silver: DataFrame) -> DataFrame:
    """Which cities reported, per day and condition, as mergeable sketches."""
    return distinct_sketches(silver, ["recorded_date", "weather_condition"], "city")


def monthly_reach(days: DataFrame) -> DataFrame:
    """Approximate number of cities that reported per month and condition, from the days alone."""
    by_month = days.withColumn("year_month", month_key("recorded_date"))
    return merge_sketches(by_month, ["year_month", "weather_condition"]).select(
        "year_month", "weather_condition", F.col("n").alias("measurements"), F.col("estimate").alias("cities")
    )


def place(cube: DataFrame, attributes: DataFrame) -> DataFrame:
    """Add country and position per city after grouping.

    The join then shuffles the cube, not the observations, so a hot city costs
    no more than another.
    """
    return attach(cube, attributes, "city").withColumnsRenamed(
        {"latitude": "first_latitude", "longitude": "first_longitude"}
    )


def daily_stats(cube: DataFrame, digits: Digits = None) -> DataFrame:
    merged = cube.groupBy("city", "country", "recorded_date").agg(
        *merge_stats(MEASURES), F.sum("n").alias("measurement_count")
    )
    return merged.select(
        "city",
        "country",
        "recorded_date",
        mean_of("temperature", digits).alias("avg_temperature"),
        F.col("temperature_min").alias("min_temperature"),
        F.col("temperature_max").alias("max_temperature"),
        *[mean_of(m, digits).alias(f"avg_{m}") for m in MEASURES[1:]],
        "measurement_count",
    )


def daily_dominant(cube: DataFrame) -> DataFrame:
    return most_frequent(
        cube, ["city", "recorded_date"], "weather_condition", "dominant_weather_condition", "n"
    )


def rolling_week(daily: DataFrame, digits: int | None = None) -> DataFrame:
    """Trailing seven rows per city. A city has at most one row per day and country,
    so its series is bounded by the calendar and fits one window task."""
    week = (
        Window.partitionBy("city").orderBy("recorded_date", F.asc_nulls_last("country")).rowsBetween(-6, 0)
    )
    return daily.withColumns(
        {
            "rolling_avg_temp": fixed_point.mean("avg_temperature", digits, week),
            "temp_volatility": fixed_point.sample_stddev("avg_temperature", digits, week),
        }
    )


def dim_city(cube: DataFrame, large: bool = True) -> DataFrame:
    """One row per city with its earliest country and position, and a dense key."""
    oldest = lambda c: F.min_by(c, F.struct("first_dt", "country"))
    cities = cube.groupBy("city").agg(
        oldest("country").alias("country"),
        oldest("first_latitude").alias("latitude"),
        oldest("first_longitude").alias("longitude"),
    )
    return (dense_key if large else dense_key_small)(cities, "city", "city_id")


def dim_date(cube: DataFrame) -> DataFrame:
    """One row per day with data; its number of rows is bounded by the calendar."""
    days = cube.select("recorded_date").distinct()
    return calendar(dense_key_small(days, "recorded_date", "date_id"), "recorded_date")


def daily_fact(
    cube: DataFrame,
    cities: DataFrame,
    dates: DataFrame,
    digits: Digits = None,
    rolling_digits: int | None = None,
) -> DataFrame:
    rolled = rolling_week(daily_stats(cube, digits), rolling_digits)
    named = attach(rolled, daily_dominant(cube), ["city", "recorded_date"])
    keyed = attach(named, cities, "city", ["city_id"])
    keyed = attach(keyed, dates, "recorded_date", ["date_id"])
    return calendar(keyed, "recorded_date", ("year", "month"))


def monthly_fact(cube: DataFrame, digits: Digits = None) -> DataFrame:
    """Monthly statistics with rainy and clear days.

    The cube has one row per day and condition, so a day is first marked and
    then counted: no distinct aggregate over observations.
    """
    marked = cube.groupBy("city", "country", "recorded_date").agg(
        *merge_stats(("temperature", "humidity", "wind_speed")),
        F.sum("n").alias("n"),
        _any(mentions("weather_condition", "rain")).alias("rainy"),
        _any(mentions("weather_condition", "clear")).alias("clear"),
    )
    return (
        marked.withColumn("year_month", month_key("recorded_date"))
        .groupBy("city", "country", "year_month")
        .agg(
            *merge_stats(("temperature", "humidity", "wind_speed")),
            F.sum("n").alias("total_measurements"),
            F.count_if("rainy").alias("rainy_day_count"),
            F.count_if("clear").alias("clear_day_count"),
        )
        .select(
            "city",
            "country",
            "year_month",
            mean_of("temperature", digits).alias("avg_temperature"),
            F.col("temperature_min").alias("min_temperature"),
            F.col("temperature_max").alias("max_temperature"),
            mean_of("humidity", digits).alias("avg_humidity"),
            mean_of("wind_speed", digits).alias("avg_wind_speed"),
            "total_measurements",
            "rainy_day_count",
            "clear_day_count",
        )
    )


def _any(condition: Column) -> Column:
    return F.coalesce(F.bool_or(condition), F.lit(False))


def city_summary(cube: DataFrame, digits: Digits = None) -> DataFrame:
    """Overall average, days tracked, latest reading and most frequent condition."""
    per_day = cube.groupBy("city", "country", "recorded_date").agg(
        *merge_stats(("temperature",)),
        F.min("first_dt").alias("first_dt"),
        F.min_by("first_latitude", "first_dt").alias("first_latitude"),
        F.min_by("first_longitude", "first_dt").alias("first_longitude"),
    )
    overall = (
        per_day.groupBy("city", "country")
        .agg(
            *merge_stats(("temperature",)),
            F.count("recorded_date").alias("total_days_tracked"),
            F.min_by("first_latitude", "first_dt").alias("latitude"),
            F.min_by("first_longitude", "first_dt").alias("longitude"),
        )
        .select(
            "city",
            "country",
            mean_of("temperature", digits).alias("avg_temperature_overall"),
            "total_days_tracked",
            "latitude",
            "longitude",
        )
    )
    latest = cube.groupBy("city").agg(
        F.max_by("last_temperature", "last_dt").alias("latest_temperature"),
        F.max_by("last_humidity", "last_dt").cast("double").alias("latest_humidity"),
        F.max_by("last_recorded_at", "last_dt").alias("latest_recorded_at"),
    )
    dominant = most_frequent(cube, ["city"], "weather_condition", "dominant_weather_overall", "n")
    return attach(attach(overall, latest, "city"), dominant, "city")


def cube_table(spark: SparkSession, lake: LakeConfig) -> VersionedTable:
    return VersionedTable(spark, lake.cube, list(CUBE_KEYS), lake.silver_partition)


def refresh_cube(spark: SparkSession, lake: LakeConfig, silver: VersionedTable) -> DataFrame | None:
    """Group again only the partitions of silver that changed since the last refresh."""
    cube = cube_table(spark, lake)
    version = silver.version()
    changed = silver.changed_since(cube.notes().get("silver_version", 0))
    rows = silver.read(changed) if changed else None
    if rows is not None:
        fresh = day_cube(rows)
        if lake.silver_partition == "recorded_month":
            fresh = fresh.withColumn("recorded_month", month_key("recorded_date"))
        cube.replace(fresh, changed, silver_version=version)
    return cube.read()


def run(spark: SparkSession, lake: LakeConfig, silver: VersionedTable) -> None:
    """Write dimensions and facts from the refreshed cube."""
    with scratch(spark):
        cube = refresh_cube(spark, lake, silver)
        if cube is not None:
            _write(spark, lake, cube)


def _write(spark: SparkSession, lake: LakeConfig, cube: DataFrame) -> None:
    sinks.overwrite(dim_city(cube), lake.table("dim_city"))
    sinks.overwrite(dim_date(cube), lake.table("dim_date"))
    cities = spark.read.parquet(lake.table("dim_city"))
    dates = spark.read.parquet(lake.table("dim_date"))
    daily = stamp(daily_fact(cube, cities, dates), "aggregated_at")
    sinks.overwrite_partitions(
        daily,
        lake.table("fact_weather_daily_stats"),
        ["year", "month"],
        cluster_by=["city_id", "date_id"],
    )
    sinks.overwrite(
        stamp(monthly_fact(cube), "aggregated_at"), lake.table("fact_weather_monthly_stats")
    )
    sinks.overwrite(
        stamp(city_summary(cube), "aggregated_at"), lake.table("fact_weather_city_summary")
    )
