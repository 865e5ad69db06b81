"""Latest features per entity for a key-value store."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import keep_first
from tidemark.operators.sinks import newest_first, online_rows
from tidemark.plans.features import ORDER, WEEK_FRAME

# Fixed value: key prefix of the stored row.
KEY_PREFIX = "feature:hourly_weather:latest:"

# Rows that the frames of an entity's newest hour reach: the longest frame, the row before it
# at which a running sum starts, and a second row of the same hour (a file's and a stream's).
RECENT_ROWS = WEEK_FRAME + 3


def recent(hourly: DataFrame, rows: int = RECENT_ROWS) -> DataFrame:
    """The last ``rows`` hours of every entity.

    The rank is limited in every input task before the shuffle, so an entity sends a bounded
    number of rows however long its history is, and no series needs splitting after it.
    """
    latest_first = Window.partitionBy("city").orderBy(*[F.desc_nulls_last(c) for c in ORDER])
    known = hourly.filter(F.col("recorded_at").isNotNull())
    return known.withColumn("_rank", F.row_number().over(latest_first)).filter(F.col("_rank") <= rows).drop("_rank")


def latest_features(hourly: DataFrame) -> DataFrame:
    """The newest feature row per entity; one row per task and entity is shuffled."""
    order = [*newest_first("recorded_at"), F.asc_nulls_last("temp"), F.asc_nulls_last("humid")]
    return keep_first(hourly, ["city"], order)


def online_rows_of(latest: DataFrame) -> DataFrame:
    return online_rows(latest, "city", "recorded_at", ["recorded_date"], KEY_PREFIX)


def latest_rows(hourly: DataFrame) -> DataFrame:
    return online_rows_of(latest_features(hourly))
