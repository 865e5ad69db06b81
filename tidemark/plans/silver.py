"""Silver layer: one clean, unique row per entity and second."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.config import LakeConfig
from tidemark.functions.scalar import (
    epoch_seconds,
    first_item,
    from_epoch,
    kelvin_to_celsius,
    month_key,
    normalise,
    violates_range,
)
from tidemark.operators import quality
from tidemark.operators.filters import only, require, within
from tidemark.operators.ranking import keep_first
from tidemark.operators.shape import conform, flatten, stamp, tag, union_sources
from tidemark.operators.sinks import newest_first
from tidemark.operators.upsert import VersionedTable
from tidemark.schemas import (
    BATCH_BRONZE,
    BATCH_SOURCE,
    HUMIDITY_RANGE,
    SILVER_MAPPED,
    STREAM_BRONZE,
    STREAM_SOURCE,
    TEMPERATURE_RANGE,
)
from tidemark.sources.tables import exists, read_if_present
from tidemark.streaming.ingest import each_batch

_log = logging.getLogger(__name__)

KEYS = ["city", "recorded_dt"]
CLEAN_RANGES = {"temperature": TEMPERATURE_RANGE, "humidity": HUMIDITY_RANGE}

# Both feeds must agree on a country, or grouping by (city, country) splits a city.
COUNTRY_SPELLINGS = {"US": "United States", "CA": "Canada", "IL": "Israel"}


def map_stream(bronze: DataFrame) -> DataFrame:
    """Nested messages → the common schema."""
    flat = flatten(
        bronze,
        {
            "city": "name",
            "country": "sys.country",
            "latitude": "coord.lat",
            "longitude": "coord.lon",
            "temperature": "main.temp",
            "feels_like": "main.feels_like",
            "temp_min": "main.temp_min",
            "temp_max": "main.temp_max",
            "humidity": "main.humidity",
            "pressure": "main.pressure",
            "wind_speed": "wind.speed",
            "wind_direction": "wind.deg",
            "cloud_coverage": "clouds.all",
            "visibility": "visibility",
            "weather_condition": first_item("weather", "main"),
            "weather_description": first_item("weather", "description"),
            "recorded_at": from_epoch("dt"),
            "recorded_dt": "dt",
            "ingested_at": "ingested_at",
        },
    )
    return tag(conform(flat, SILVER_MAPPED), STREAM_SOURCE)


def map_batch(bronze: DataFrame) -> DataFrame:
    """Aligned file rows → the common schema; missing columns become typed nulls."""
    present = set(bronze.columns)
    derived = {}
    if "temperature" in present:
        derived["temperature"] = kelvin_to_celsius("temperature")
    if "datetime" in present:
        derived["recorded_at"] = F.col("datetime").cast("timestamp")
        derived["recorded_dt"] = epoch_seconds(F.col("datetime").cast("timestamp"))
    if "weather_description" in present:
        derived["weather_condition"] = F.col("weather_description")
    return tag(conform(bronze, SILVER_MAPPED, derived), BATCH_SOURCE)


def union_bronze(
    stream: DataFrame | None, batch: DataFrame | None, spellings: Mapping[str, str] = COUNTRY_SPELLINGS
) -> DataFrame | None:
    mapped = []
    if stream is not None:
        mapped.append(map_stream(stream))
    if batch is not None:
        mapped.append(map_batch(batch))
    if not mapped:
        return None
    return union_sources(mapped).withColumn("country", normalise("country", spellings))


def _cleaned(df: DataFrame, entity: str | None) -> DataFrame:
    """Known entity and record time; a row without either has no upsert key."""
    return only(require(df, KEYS), "city", entity)


def clean(df: DataFrame, entity: str | None = None) -> DataFrame:
    """Known entity, values in range, calendar date added."""
    kept = _cleaned(df, entity).filter(within(CLEAN_RANGES))
    return kept.withColumn("recorded_date", F.to_date("recorded_at"))


def clean_counted(df: DataFrame, entity: str | None = None) -> tuple[DataFrame, Observation]:
    """``clean`` that counts rows in and rows kept while its result is written.

    The plan has no shuffle, so a write of it counts every row once.
    """
    known = F.lit(True)
    for key in KEYS:
        known = known & F.col(key).isNotNull()
    kept, seen = quality.observe_filter(only(df, "city", entity), known & within(CLEAN_RANGES))
    return kept.withColumn("recorded_date", F.to_date("recorded_at")), seen


# Values that break the last ties; any other column follows in order of name.
TIES = ("source", "temperature", "humidity")


def newest_wins(columns: Sequence[str] = SILVER_MAPPED.names) -> list[Column]:
    """The order in which rows of one key win: latest ingest, then source and values.

    It is total on the values, so that neither the order of batches nor a replay changes
    which row is kept.
    """
    present = [c for c in TIES if c in columns]
    rest = sorted(set(columns) - {*KEYS, *present, "ingested_at"})
    return [*newest_first("ingested_at"), *[F.asc_nulls_last(c) for c in (*present, *rest)]]


def unique(df: DataFrame) -> DataFrame:
    """The most recently ingested row per entity and second."""
    return keep_first(df, KEYS, newest_wins(TIES))


def silver(df: DataFrame, entity: str | None = None) -> DataFrame:
    return stamp(unique(clean(df, entity)), "transformed_at")


def table(spark: SparkSession, lake: LakeConfig) -> VersionedTable:
    return VersionedTable(
        spark, lake.table("silver_weather_clean"), KEYS, lake.silver_partition, newest_wins()
    )


def rules() -> list[quality.Rule]:
    return [
        *quality.null_rules(["city", "temperature"]),
        quality.Rule("temperature out of range", violates_range("temperature", *TEMPERATURE_RANGE)),
        quality.Rule("humidity out of range", violates_range("humidity", *HUMIDITY_RANGE)),
    ]


def _partitioned(rows: DataFrame, lake: LakeConfig) -> DataFrame:
    if lake.silver_partition == "recorded_month":
        return rows.withColumn("recorded_month", month_key("recorded_date"))
    return rows


def upsert(target: VersionedTable, rows: DataFrame, lake: LakeConfig) -> tuple[int, dict[str, int]]:
    """Clean, merge, check, publish; returns the version and the rows in, kept and dropped.

    Cleaning is written without a shuffle, and the merge keeps the winner of new and stored
    rows in one. The rules are checked on what was written before it can be read.
    """
    cleaned, seen = clean_counted(rows, lake.entity)
    version = target.merge(_partitioned(stamp(cleaned, "transformed_at"), lake), rules())
    return version, quality.filter_counts(seen)


def run(spark: SparkSession, lake: LakeConfig) -> int | None:
    """Clean both bronze tables as a whole and upsert them; returns the committed version."""
    both = union_bronze(
        read_if_present(spark, lake.table("bronze_weather_streaming")),
        read_if_present(spark, lake.table("bronze_weather_batch")),
    )
    if both is None:
        return None
    version, counts = upsert(table(spark, lake), both, lake)
    _log.info("silver version %d: %s", version, counts)
    return version


def run_new(spark: SparkSession, lake: LakeConfig) -> int:
    """Upsert only the bronze rows that arrived since the last call.

    Each bronze table is read as a file stream until it is drained. The checkpoint
    remembers the files, so the cost follows the new rows, and a batch that is
    replayed after a failure merges to the same table, which is also the table that
    ``run`` would make of all rows. A batch that breaks a rule stops the stream unpublished.
    """
    target = table(spark, lake)
    for source, schema in (
        ("bronze_weather_batch", BATCH_BRONZE),
        ("bronze_weather_streaming", STREAM_BRONZE),
    ):
        if not exists(spark, lake.table(source)):
            continue
        rows = spark.readStream.schema(schema).parquet(lake.table(source))

        def merge(part: DataFrame, batch: bool = source.endswith("batch")) -> None:
            both = union_bronze(None, part) if batch else union_bronze(part, None)
            version, counts = upsert(target, both, lake)
            _log.info("silver version %d: %s", version, counts)

        each_batch(rows, merge, lake.silver_checkpoint(source), available_now=True).awaitTermination()
    return target.version()
