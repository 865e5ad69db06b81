"""The given tables seen as observations.

``events`` become readings of an entity (the user), customer and nation supply
its attributes. Event types stand for weather conditions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import configure, materialise
from tidemark.functions.scalar import epoch_seconds, normalise
from tidemark.operators.joins import attach
from tidemark.plans import features, gold, silver

STREAM, BATCH = "stream", "batch"

CONDITIONS = {
    "click": "clear sky",
    "view": "few clouds",
    "signup": "light rain",
    "error": "heavy rain",
    "purchase": "mist",
}
STREAMED = ("click", "view")

# Temperatures have two decimals; other measures add up exactly as they are.
DIGITS = {"temperature": 2}
# Averages that are averaged again are kept to four decimals.
MEAN_DIGITS = 4
SERIES_DIGITS = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    parsed = events.withColumn("k", k.try_cast("int"))
    k, instant = F.col("k"), F.col("ts").cast("timestamp")
    return parsed.select(
        "event_id",
        F.col("user_id").alias("city"),
        F.col("value").alias("temperature"),
        k.alias("humidity"),
        (k + 950).cast("double").alias("pressure"),
        (k / 4).alias("wind_speed"),
        normalise("event_type", CONDITIONS).alias("weather_condition"),
        instant.alias("recorded_at"),
        epoch_seconds(instant).alias("recorded_dt"),
        instant.alias("ingested_at"),
        F.when(F.col("event_type").isin(*STREAMED), STREAM).otherwise(BATCH).alias("source"),
    )


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country and position per entity."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("city"), "c_nationkey", F.col("c_acctbal").alias("longitude")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    return attach(customers, nations, "c_nationkey").select(
        "city", "country", F.col("c_nationkey").cast("double").alias("latitude"), "longitude"
    )


def silver_plain(spark: SparkSession, sf_dir: str, days: Column | None = None) -> DataFrame:
    """Clean, unique rows without the attribute lookup. ``days`` is a condition on the date,
    which rows of one key share, so the others are left out at the scan."""
    rows = silver.clean(observations(spark, sf_dir))
    return silver.unique(rows if days is None else rows.where(days))


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped first, so the attribute lookup joins days, not observations."""
    return gold.place(
        gold.day_cube(silver_plain(spark, sf_dir), DIGITS), attributes(spark, sf_dir)
    )


def stored_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube written once, for queries that read it several times."""
    return materialise(cube(spark, sf_dir), "cube")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = stored_cube(spark, sf_dir)
    return gold.daily_fact(c, gold.dim_city(c), gold.dim_date(c), DIGITS, MEAN_DIGITS)


def daily_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistics with the most frequent condition, without surrogate keys."""
    c = stored_cube(spark, sf_dir)
    return attach(
        gold.daily_stats(c, DIGITS), gold.daily_dominant(c), ["city", "recorded_date"]
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.hourly_series(
        silver_plain(spark, sf_dir), digits=SERIES_DIGITS, batch=BATCH, stream=STREAM
    )


def hot(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """Entities too large for one task, counted on the scan of one column."""
    from tidemark.operators.series import hot_entities

    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("city"))
    return hot_entities(users, ["city"])


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.training_frame(
        hourly(spark, sf_dir), digits=SERIES_DIGITS, hot=hot(spark, sf_dir)
    )


def presented(df: DataFrame) -> DataFrame:
    """Plain output types: dates as text, timestamps without zone."""
    columns = []
    for field in df.schema.fields:
        kind, c = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind == "date":
            c = c.cast("string")
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(field.name))
    return df.select(*columns)
