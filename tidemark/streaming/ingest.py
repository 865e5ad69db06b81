"""Parse messages and append them; fold micro-batches into keyed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.shape import expand
from tidemark.operators.upsert import VersionedTable
from tidemark.schemas import MESSAGE


def parse_messages(
    messages: DataFrame, schema: T.StructType = MESSAGE, stamp: str = "kafka_timestamp"
) -> DataFrame:
    """``(value, timestamp)`` → the message fields, source time and ingest time.

    A pure DataFrame function, so batch and stream share it. A malformed message
    gives a row of nulls and a bad leaf nulls only itself.
    """
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("timestamp").cast("timestamp").alias(stamp),
    )
    return expand(parsed, "data", [stamp]).withColumn("ingested_at", F.current_timestamp())


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append to a Parquet table; the checkpoint and the sink log make it exactly-once."""
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def each_batch(
    rows: DataFrame,
    handle: Callable[[DataFrame], None],
    checkpoint: str,
    mode: str = "append",
    available_now: bool = False,
) -> StreamingQuery:
    """Hand every micro-batch to ``handle``, which must bear to see a batch again."""
    writer = (
        rows.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, _: handle(batch))
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def upsert_stream(
    rows: DataFrame,
    table: VersionedTable,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    mode: str = "append",
    available_now: bool = False,
) -> StreamingQuery:
    """Upsert every micro-batch. A replayed batch merges to the same table.

    ``prepare`` must leave one row per key unless the table has an order. ``mode="update"``
    feeds changed aggregates, so windows still open when a bounded run ends are kept as well.
    """
    return each_batch(rows, lambda batch: table.merge(prepare(batch)), checkpoint, mode, available_now)


def drop_repeats(rows: DataFrame, keys: list[str], instant: str, delay: str) -> DataFrame:
    """Drop repeated messages that arrive within ``delay``; the upsert stays authoritative."""
    return rows.withWatermark(instant, delay).dropDuplicatesWithinWatermark(keys)


def hourly_stream(
    rows: DataFrame,
    keys: list[str],
    instant: str,
    aggregates: list[Column],
    delay: str = "1 hour",
) -> DataFrame:
    """Tumbling one-hour roll-up; the watermark bounds the state kept per key."""
    return (
        rows.withWatermark(instant, delay)
        .groupBy(*keys, F.window(instant, "1 hour").alias("_window"))
        .agg(*aggregates)
        .withColumn(instant, F.col("_window.start"))
        .drop("_window")
    )
