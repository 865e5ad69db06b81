"""Message streams: a broker topic, or a folder of text files in its place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Kafka topic from the earliest offset; expired offsets do not stop the query."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    return reader.options(**options).load().select("value", "timestamp")


def read_folder(
    spark: SparkSession, path: str, archive: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """One message per line. ``timestamp`` is the file's modification time.

    The checkpoint of the query is the record of ingested files; with ``archive``
    finished files are moved away.
    """
    reader = spark.readStream.format("text")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(
        "value", F.col("_metadata.file_modification_time").alias("timestamp")
    )
