"""Bronze layer: wide attribute files and the message stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import LakeConfig
from tidemark.operators import sinks
from tidemark.operators.filters import require
from tidemark.operators.joins import align_outer, attach
from tidemark.operators.shape import conform, stamp, tag
from tidemark.schemas import ATTRIBUTES, BATCH_BRONZE, BATCH_SOURCE
from tidemark.sources import files, tables
from tidemark.streaming.ingest import append_stream, parse_messages


def batch_bronze(frames: Mapping[str, DataFrame], cities: DataFrame | None) -> DataFrame:
    """Align the attribute tables, add entity metadata and lineage columns."""
    keys = ["datetime", "city"]
    keyed = {name: require(frame, keys) for name, frame in frames.items()}
    aligned = align_outer(keyed, keys)
    if cities is not None:
        aligned = attach(aligned, cities, "city")
    return stamp(tag(conform(aligned, BATCH_BRONZE), BATCH_SOURCE), "ingested_at")


def run_batch(spark: SparkSession, lake: LakeConfig) -> int:
    """Ingest landing files the manifest does not know yet; returns rows written.

    Only those files are read, by their names; a file that holds no attribute is noted and
    passed over. The files of a run are claimed first, their rows are one partition of
    bronze named after them, and the manifest comes last: a run that dies anywhere in
    between is repeated with the same files into the same partition.
    """
    claimed = files.next_batch(spark, lake.landing, lake.manifest, lake.claims)
    if claimed is None:
        return 0
    rows = ingest(spark, lake, claimed)
    files.record_files(claimed, lake.manifest)
    return rows


def ingest(spark: SparkSession, lake: LakeConfig, claimed: DataFrame) -> int:
    """Write the rows of one batch of files in place of what the batch wrote before."""
    # Names of files, one for each attribute and delivery.
    named = sorted((r["path"], r["batch"]) for r in claimed.collect())
    frames: dict[str, DataFrame] = {}
    for attribute, dtype in ATTRIBUTES.items():
        for path, _ in named:
            # A file, or a part of a folder that is named like one.
            if f"{attribute}.csv" not in path.rsplit("/", 2)[-2:]:
                continue
            frame = files.read_attribute(spark, path, attribute, dtype)
            if frame is not None:
                known = frames.get(attribute)
                frames[attribute] = frame if known is None else known.unionByName(frame)
    if not frames:
        return 0
    cities = tables.read_cities(spark, f"{lake.landing}/city_attributes.csv")
    bronze, rows = _observed(batch_bronze(frames, cities))
    sinks.overwrite_partitions(
        bronze.withColumn("batch", F.lit(named[0][1])), lake.table("bronze_weather_batch"), ["batch"], replace_all=False
    )
    return rows.get["rows"]


def _observed(df: DataFrame):
    from pyspark.sql import Observation

    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def run_stream(messages: DataFrame, lake: LakeConfig, available_now: bool = False) -> StreamingQuery:
    """Parse and append the message stream."""
    return append_stream(
        parse_messages(messages),
        lake.table("bronze_weather_streaming"),
        lake.bronze_checkpoint,
        available_now,
    )
