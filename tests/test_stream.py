import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from samples import message

from tidemark.config import LakeConfig
from tidemark.operators.upsert import VersionedTable
from tidemark.plans import bronze, silver
from tidemark.sources.messages import read_folder, read_topic
from tidemark.streaming.ingest import (
    drop_repeats,
    hourly_stream,
    parse_messages,
    upsert_stream,
)

START = 1667628000  # 2022-11-05 06:00 UTC


@pytest.fixture
def lake(tmp_path):
    (tmp_path / "in").mkdir()
    return LakeConfig(str(tmp_path))


def put(lake, name, *items):
    lines = [i if isinstance(i, str) else json.dumps(i) for i in items]
    path = f"{lake.root}/in/{name}.json"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(path, (START + int(name), START + int(name)))  # files are taken in time order


def run(spark, lake):
    source = read_folder(spark, f"{lake.root}/in", files_per_batch=1)
    bronze.run_stream(source, lake, available_now=True).awaitTermination()
    return spark.read.parquet(lake.table("bronze_weather_streaming"))


def test_restart_loses_and_repeats_nothing(spark, lake):
    put(lake, "1", message("Aldermoor", START), "{broken")
    assert run(spark, lake).count() == 2
    put(lake, "2", message("Aldermoor", START + 300), message("Brinkum", START))
    rows = run(spark, lake)
    assert rows.count() == 4
    assert sorted((r.name or "", r.dt or 0) for r in rows.collect()) == [
        ("", 0), ("Aldermoor", START), ("Aldermoor", START + 300), ("Brinkum", START)
    ]
    assert run(spark, lake).count() == 4
    assert rows.filter("kafka_timestamp IS NULL OR ingested_at IS NULL").count() == 0


def test_stream_equals_batch(spark, lake):
    put(lake, "1", message("Aldermoor", START, 1.0), message("Brinkum", START, 2.0))
    streamed = run(spark, lake)
    text = spark.read.text(f"{lake.root}/in").withColumn("timestamp", F.current_timestamp())
    batch = parse_messages(text)
    columns = [c for c in batch.columns if c not in ("kafka_timestamp", "ingested_at")]
    key = lambda df: sorted(map(repr, df.select(columns).collect()))
    assert key(streamed) == key(batch)


def test_topic_needs_the_connector(spark):
    """The connector is a package of the cluster; without it Spark says so."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_topic(spark, "localhost:9092", "observations", maxOffsetsPerTrigger="1000")


def test_finished_files_are_archived(spark, lake):
    put(lake, "1", message("Aldermoor", START))
    archive = f"{lake.root}/done"
    for name in ("2", "3"):
        source = read_folder(spark, f"{lake.root}/in", archive=archive)
        bronze.run_stream(source, lake, available_now=True).awaitTermination()
        put(lake, name, message("Aldermoor", START + int(name)))
    moved = [f for _, _, names in os.walk(archive) for f in names if f.endswith(".json")]
    assert "1.json" in moved


def upsert(spark, lake, table):
    source = parse_messages(read_folder(spark, f"{lake.root}/in", files_per_batch=1))

    def prepare(batch):
        return silver.silver(silver.map_stream(batch))

    upsert_stream(
        source, table, f"{lake.root}/ck", prepare, available_now=True
    ).awaitTermination()
    return {(r.city, r.recorded_dt): r.temperature for r in table.read().collect()}


def test_micro_batches_upsert(spark, lake):
    table = VersionedTable(spark, f"{lake.root}/silver", silver.KEYS, "recorded_date")
    put(lake, "1", message("Aldermoor", START, 1.0), message("Aldermoor", START, 1.0), message("Brinkum", START, 2.0))
    assert upsert(spark, lake, table) == {("Aldermoor", START): 1.0, ("Brinkum", START): 2.0}
    put(lake, "2", message("Aldermoor", START, 5.0), message("Brinkum", START + 86400, 3.0))
    expected = {("Aldermoor", START): 5.0, ("Brinkum", START): 2.0, ("Brinkum", START + 86400): 3.0}
    assert upsert(spark, lake, table) == expected
    # a replayed batch leaves the same rows
    table.merge(silver.silver(silver.map_stream(parse_messages(
        spark.read.text(f"{lake.root}/in/2.json").withColumn("timestamp", F.current_timestamp())
    ))))
    assert {(r.city, r.recorded_dt): r.temperature for r in table.read().collect()} == expected


def test_hourly_windows_close_behind_the_watermark(spark, lake):
    """Append mode writes a window once the watermark passes its end."""
    put(lake, "1", message("Aldermoor", START, 1.0), message("Aldermoor", START + 600, 3.0))
    put(lake, "2", message("Aldermoor", START + 4 * 3600, 9.0))
    put(lake, "3", message("Aldermoor", START + 8 * 3600, 9.0))

    def once():
        rows = silver.map_stream(parse_messages(read_folder(spark, f"{lake.root}/in", files_per_batch=1)))
        hourly = hourly_stream(
            rows, ["city"], "recorded_at", [F.avg("temperature").alias("temperature"), F.count("*").alias("n")]
        )
        (
            hourly.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{lake.root}/hck").trigger(availableNow=True)
            .start(f"{lake.root}/hourly").awaitTermination()
        )
        return {r.recorded_at.hour: (r.temperature, r.n) for r in spark.read.parquet(f"{lake.root}/hourly").collect()}

    got = once()
    assert got[6] == (2.0, 2)
    assert 14 not in got  # still open
    put(lake, "4", message("Aldermoor", START + 48 * 3600, 0.0))
    got = once()
    assert got[6] == (2.0, 2) and got[10] == (9.0, 1) and got[14] == (9.0, 1)


def test_repeats_within_the_watermark(spark, lake):
    put(lake, "1", message("Aldermoor", START, 1.0), message("Aldermoor", START, 1.0))
    put(lake, "2", message("Aldermoor", START, 1.0), message("Aldermoor", START + 60, 2.0))
    rows = silver.map_stream(parse_messages(read_folder(spark, f"{lake.root}/in", files_per_batch=1)))
    unique = drop_repeats(rows, ["city", "recorded_dt"], "recorded_at", "1 hour")
    (
        unique.writeStream.format("parquet").option("checkpointLocation", f"{lake.root}/dck")
        .trigger(availableNow=True).start(f"{lake.root}/unique").awaitTermination()
    )
    assert spark.read.parquet(f"{lake.root}/unique").count() == 2
