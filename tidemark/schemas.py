"""Declared schemas of every layer; nothing is inferred at scale."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    """Parse ``"name type, name type"`` for flat schemas."""
    names = {
        "string": T.StringType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "double": T.DoubleType(),
        "timestamp": T.TimestampType(),
        "date": T.DateType(),
    }
    fields = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, names[kind]) for name, kind in fields])


# The message layout of the observation feed.
MESSAGE = T.StructType(
    [
        T.StructField("coord", _struct("lon double, lat double")),
        T.StructField(
            "weather",
            T.ArrayType(_struct("id int, main string, description string, icon string")),
        ),
        T.StructField("base", T.StringType()),
        T.StructField(
            "main",
            _struct(
                "temp double, feels_like double, temp_min double, temp_max double,"
                "pressure int, humidity int, sea_level int, grnd_level int"
            ),
        ),
        T.StructField("visibility", T.IntegerType()),
        T.StructField("wind", _struct("speed double, deg int, gust double")),
        T.StructField("clouds", _struct("all int")),
        T.StructField("dt", T.LongType()),
        T.StructField(
            "sys", _struct("type int, id int, country string, sunrise long, sunset long")
        ),
        T.StructField("timezone", T.IntegerType()),
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("cod", T.IntegerType()),
    ]
)

STREAM_BRONZE = T.StructType(
    MESSAGE.fields
    + [
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

CITY_FILE = _struct("City string, Country string, Latitude double, Longitude double")

# Attribute files of the landing zone and their value types.
ATTRIBUTES = {
    "temperature": T.DoubleType(),
    "humidity": T.DoubleType(),
    "pressure": T.DoubleType(),
    "wind_speed": T.DoubleType(),
    "wind_direction": T.DoubleType(),
    "weather_description": T.StringType(),
}

BATCH_BRONZE = _struct(
    "datetime timestamp, city string, temperature double, humidity double, pressure double,"
    "wind_speed double, wind_direction double, weather_description string, country string,"
    "latitude double, longitude double, source string, ingested_at timestamp"
)

SILVER_MAPPED = _struct(
    "city string, country string, latitude double, longitude double, temperature double,"
    "feels_like double, temp_min double, temp_max double, humidity int, pressure double,"
    "wind_speed double, wind_direction double, cloud_coverage int, visibility int,"
    "weather_condition string, weather_description string, recorded_at timestamp,"
    "recorded_dt long, ingested_at timestamp, source string"
)

SILVER = T.StructType(
    SILVER_MAPPED.fields
    + [
        T.StructField("recorded_date", T.DateType()),
        T.StructField("transformed_at", T.TimestampType()),
    ]
)

# Column contracts checked by the layer validations.
SILVER_REQUIRED = (
    "city", "country", "temperature", "humidity", "pressure",
    "wind_speed", "weather_condition", "recorded_at", "transformed_at",
)
DAILY_REQUIRED = (
    "city", "country", "recorded_date", "avg_temperature", "min_temperature",
    "max_temperature", "avg_humidity", "avg_pressure", "avg_wind_speed",
    "measurement_count", "aggregated_at",
)

# Source tags stored in the silver table.
STREAM_SOURCE = "openweather_api"
BATCH_SOURCE = "kaggle_csv"

# Accepted ranges of a clean observation.
TEMPERATURE_RANGE = (-80, 60)
HUMIDITY_RANGE = (0, 100)
