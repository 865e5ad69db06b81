"""The fixed set of reports over the registered tables.

Each report takes the tables it reads and returns its rows. Top-n reports break
ties by key so that the same table always gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import fixed_point
from tidemark.functions.scalar import from_epoch
from tidemark.operators import aggregates
from tidemark.operators.filters import since
from tidemark.operators.joins import star
from tidemark.operators.ranking import newest


def newest_daily(daily: DataFrame, n: int = 10) -> DataFrame:
    return newest(
        daily,
        [F.desc("recorded_date"), F.asc("city"), F.asc("country")],
        n,
        ["city", "recorded_date", "avg_temperature", "min_temperature", "max_temperature",
         "dominant_weather_condition"],
    )


def newest_months(monthly: DataFrame, n: int = 12) -> DataFrame:
    return newest(
        monthly,
        [F.desc("year_month"), F.asc("city"), F.asc("country")],
        n,
        ["city", "year_month", "avg_temperature", "rainy_day_count", "clear_day_count",
         "total_measurements"],
    )


def summary(city_summary: DataFrame, n: int = 100) -> DataFrame:
    """Cities in the order of their names, at most ``n``."""
    return newest(city_summary, [F.asc("city"), F.asc("country")], n, city_summary.columns)


def trend(daily: DataFrame, first_day: str | None = None, partitioned: bool = False) -> DataFrame:
    """Daily temperatures in time order, optionally from a date on."""
    rows = since(daily, "recorded_date", first_day, partitioned) if first_day else daily
    return rows.select(
        "city", "recorded_date", "avg_temperature", "min_temperature", "max_temperature",
        "dominant_weather_condition",
    ).orderBy("recorded_date", "city")


def seasonal(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "city", "year_month", "avg_temperature", "rainy_day_count", "clear_day_count"
    ).orderBy("year_month", "city")


def by_year_month(
    daily: DataFrame, dates: DataFrame, n: int = 12, digits: int | None = None
) -> DataFrame:
    """Average of the daily averages per calendar month, through the date dimension."""
    joined = star(daily.select("date_id", "avg_temperature"), dates, "date_id", ["year", "month"])
    return (
        joined.groupBy(F.col("dim_year").alias("year"), F.col("dim_month").alias("month"))
        .agg(fixed_point.mean("avg_temperature", digits).alias("avg_temp"))
        .orderBy(F.desc("year"), F.desc("month"))
        .limit(n)
    )


def batch_profile(bronze: DataFrame, instant: str = "datetime") -> DataFrame:
    return aggregates.profile(bronze, instant, "city")


def newest_messages(bronze: DataFrame, n: int = 10) -> DataFrame:
    """Newest stream rows, reading only the nested leaves shown."""
    return newest(
        bronze,
        [F.desc("ingested_at"), F.desc("dt"), F.asc("name")],
        n,
        [
            F.col("name").alias("city"),
            F.col("main.temp").alias("temperature"),
            F.col("main.humidity").alias("humidity"),
            F.col("wind.speed").alias("wind_speed"),
            from_epoch("dt").alias("recorded_at"),
            "ingested_at",
        ],
    )


def messages_per_day(bronze: DataFrame, n: int = 7) -> DataFrame:
    return aggregates.rows_per_day(bronze, "ingested_at", n)


def stream_profile(bronze: DataFrame) -> DataFrame:
    return aggregates.stream_profile(
        bronze.withColumn("recorded_at", from_epoch("dt")), "recorded_at", "ingested_at"
    )


def newest_rows(silver: DataFrame, n: int = 10) -> DataFrame:
    return newest(
        silver,
        [F.desc("recorded_at"), F.asc("city")],
        n,
        ["city", "temperature", "humidity", "wind_speed", "weather_condition", "recorded_at",
         "source"],
    )


def layer_counts(
    batch: DataFrame | None, stream: DataFrame | None, silver: DataFrame | None
) -> DataFrame:
    return aggregates.layer_counts(
        {"bronze_batch": batch, "bronze_streaming": stream, "silver": silver}
    )


def source_coverage(silver: DataFrame) -> DataFrame:
    return aggregates.source_coverage(silver, "source", "recorded_at")


def year_average(monthly: DataFrame, year: str, digits: int | None = None) -> DataFrame:
    rows = monthly.filter(F.col("year_month").startswith(year))
    return rows.agg(fixed_point.mean("avg_temperature", digits).alias("avg_temperature"))


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("records"))


def table_list(spark: SparkSession) -> DataFrame:
    """Names of the registered tables."""
    return spark.sql("SHOW TABLES").filter(~F.col("isTemporary")).select(F.col("tableName").alias("name"))


def dump(table: DataFrame, order: str, n: int = 10) -> DataFrame:
    """First rows of a small table."""
    return table.orderBy(order).limit(n)
