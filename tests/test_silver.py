import datetime
import json

import pytest
from pyspark.sql import functions as F
from samples import message

from tidemark import schemas
from tidemark.config import LakeConfig
from tidemark.operators import quality, sinks
from tidemark.operators.quality import QualityError
from tidemark.operators.shape import conform
from tidemark.plans import silver, validation
from tidemark.streaming.ingest import parse_messages


@pytest.fixture
def mapped(readings):
    at = F.timestamp_seconds("recorded_dt")
    return readings.withColumns(
        {"recorded_at": at, "ingested_at": at, "source": F.lit(schemas.BATCH_SOURCE)}
    )


def messages(spark, *items):
    text = [(i if isinstance(i, str) else json.dumps(i),) for i in items]
    return spark.createDataFrame(text, "value string").withColumn(
        "timestamp", F.lit("2022-11-05 06:00:00").cast("timestamp")
    )


@pytest.mark.parametrize(
    "change",
    [
        {"temperature": "100.0D"},
        {"humidity": "150"},
        {"city": "CAST(NULL AS STRING)"},
        {"recorded_dt": "CAST(NULL AS BIGINT)"},
        {"temperature": "CAST(NULL AS DOUBLE)"},
    ],
)
def test_bad_rows_are_removed(mapped, change):
    bad = mapped.limit(1).withColumns({c: F.expr(e) for c, e in change.items()})
    assert silver.clean(mapped.union(bad)).count() == 6


def test_boundaries_are_kept(mapped):
    edge = mapped.limit(1).withColumns({"temperature": F.lit(-80.0), "humidity": F.lit(100)})
    assert silver.clean(mapped.union(edge)).count() == 7


def test_date_and_entity(mapped):
    out = silver.silver(mapped, "Aldermoor")
    assert out.count() == 3
    days = {r.recorded_date for r in out.collect()}
    assert days == {datetime.date(2022, 11, 5), datetime.date(2022, 11, 6)}
    assert silver.clean(mapped, ["Aldermoor", "Brinkum"]).count() == 4


def test_stream_mapping(spark):
    rows = messages(
        spark,
        message("Aldermoor", 1667628000, 4.25, main="Rain", country="US"),
        message("Brinkum", 1667628000, -1.5, weather=[]),
        {**message("Corvalho", 1667628000), "unknown": {"x": 1}},
        "{not json",
    )
    bronze = parse_messages(rows)
    assert bronze.schema == schemas.STREAM_BRONZE or [f.name for f in bronze.schema] == schemas.STREAM_BRONZE.names
    assert bronze.count() == 4
    out = {r.city: r for r in silver.union_bronze(bronze, None).collect()}
    assert out["Aldermoor"].country == "United States"
    assert out["Aldermoor"].weather_condition == "Rain"
    assert out["Aldermoor"].source == "openweather_api"
    assert out["Aldermoor"].recorded_at == datetime.datetime(2022, 11, 5, 6, 0)
    assert out["Brinkum"].weather_condition is None
    assert out["Corvalho"].temperature == 11.5
    assert out[None].temperature is None


def test_bad_leaf_keeps_siblings(spark):
    bad = message("Aldermoor", 1)
    bad["main"]["pressure"] = 1010.5
    row = silver.map_stream(parse_messages(messages(spark, bad))).first()
    assert row.pressure is None and row.temperature == 11.5


def test_batch_mapping_fills_missing_columns(spark):
    batch = spark.createDataFrame(
        [("Boston", 300.15, "2012-10-01 13:00:00")], "city string, temperature double, datetime string"
    ).withColumn("datetime", F.col("datetime").cast("timestamp"))
    out = silver.map_batch(batch)
    assert out.schema.names == schemas.SILVER_MAPPED.names
    row = out.first()
    assert row.temperature == pytest.approx(27.0)
    assert row.humidity is None and row.weather_condition is None
    assert row.recorded_dt == 1349096400


def test_both_feeds_share_one_schema(spark, mapped):
    batch = mapped.select("city", "temperature", F.col("recorded_at").alias("datetime"))
    both = silver.union_bronze(parse_messages(messages(spark, message("Aldermoor", 1))), batch)
    assert both.schema["recorded_at"].dataType.typeName() == "timestamp"
    assert both.count() == 7
    assert silver.union_bronze(None, None) is None


def test_newest_ingest_wins(mapped):
    newer = mapped.withColumns(
        {"temperature": F.col("temperature") + 1, "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")}
    )
    out = silver.unique(mapped.union(newer))
    assert out.count() == 6
    assert out.filter("city = 'Brinkum'").first().temperature == pytest.approx(-0.5)


def test_validation(mapped):
    good = silver.silver(mapped)
    validation.silver(good)
    with pytest.raises(QualityError, match="out of range"):
        validation.silver(good.withColumn("temperature", F.lit(99.0)))
    with pytest.raises(QualityError, match="lacks columns"):
        validation.silver(good.drop("pressure"))
    with pytest.raises(QualityError, match="empty"):
        validation.silver(good.limit(0))


def test_bronze_validation_only_warns(spark, mapped):
    total, warnings = validation.bronze(None, None)
    assert total == 0 and "bronze is empty" in warnings
    holes = mapped.select(
        F.lit(None).cast("string").alias("city"), F.col("recorded_at").alias("datetime"), "ingested_at"
    )
    total, warnings = validation.bronze(None, holes)
    assert total == 6 and any("without city" in w for w in warnings)


def deliveries(spark):
    """Three deliveries of file rows that repeat keys; the second was taken in first, by its clock."""
    rows = [
        [("Boston", 0, 300.0, 5), ("Boston", 1, 301.0, 5), ("Denver", 0, 280.0, 5), ("Denver", 0, 279.0, 5)],
        [("Boston", 0, 290.0, 3), ("Boston", 2, 302.0, 3), ("Boston", 2, 302.0, 3), (None, 1, 290.0, 3)],
        [("Boston", 1, 310.0, 9), ("Denver", 30, 281.0, 9), ("Denver", 0, 999.0, 9)],
    ]
    for some in rows:
        made = spark.createDataFrame(some, "city string, hour int, temperature double, taken int").select(
            "city",
            "temperature",
            F.lit(50.0).alias("humidity"),
            F.expr("timestamp '2022-11-05 00:00:00' + make_interval(0, 0, 0, 0, hour)").alias("datetime"),
            F.expr("timestamp '2022-11-07 00:00:00' + make_interval(0, 0, 0, 0, taken)").alias("ingested_at"),
        )
        yield conform(made, schemas.BATCH_BRONZE)


def kept(spark, lake):
    rows = silver.table(spark, lake).read().drop("transformed_at")
    return sorted(map(repr, rows.select(sorted(rows.columns)).collect()))


def test_incremental_equals_full(spark, tmp_path):
    """Whatever the order of deliveries, the same rows win as in one run over all of them."""
    whole = LakeConfig(str(tmp_path / "whole"))
    for part in deliveries(spark):
        sinks.append(part, whole.table("bronze_weather_batch"))
    assert silver.run(spark, whole) == 1
    expected = kept(spark, whole)
    temperatures = {(r.city, r.recorded_at.hour): r.temperature for r in silver.table(spark, whole).read().collect()}
    assert temperatures[("Boston", 0)] == pytest.approx(26.85)
    assert temperatures[("Boston", 1)] == pytest.approx(36.85)
    assert temperatures[("Denver", 0)] == pytest.approx(5.85)
    for name, order in (("forth", (0, 1, 2)), ("back", (2, 1, 0))):
        lake, parts = LakeConfig(str(tmp_path / name)), list(deliveries(spark))
        for k in order:
            sinks.append(parts[k], lake.table("bronze_weather_batch"))
            silver.run_new(spark, lake)
        assert kept(spark, lake) == expected
        silver.run(spark, lake)
        assert kept(spark, lake) == expected


def test_rows_are_counted_by_the_write(spark, tmp_path):
    lake = LakeConfig(str(tmp_path))
    for part in deliveries(spark):
        sinks.append(part, lake.table("bronze_weather_batch"))
    bronze = silver.union_bronze(None, spark.read.parquet(lake.table("bronze_weather_batch")))
    _, counts = silver.upsert(silver.table(spark, lake), bronze, lake)
    assert counts == {"rows_in": 11, "rows_kept": 9, "rows_dropped": 2}


def test_bad_silver_is_not_published(spark, tmp_path, monkeypatch):
    lake, parts = LakeConfig(str(tmp_path)), list(deliveries(spark))
    sinks.append(parts[0], lake.table("bronze_weather_batch"))
    silver.run_new(spark, lake)
    before = kept(spark, lake)
    strict = [quality.Rule("warm", F.col("temperature") > 30)]
    monkeypatch.setattr(silver, "rules", lambda: strict)
    sinks.append(parts[2], lake.table("bronze_weather_batch"))
    with pytest.raises(Exception, match="warm: 1"):
        silver.run_new(spark, lake)
    with pytest.raises(QualityError, match="warm: 1"):
        silver.run(spark, lake)
    assert silver.table(spark, lake).version() == 1 and kept(spark, lake) == before
    monkeypatch.undo()
    silver.run_new(spark, lake)
    assert silver.table(spark, lake).version() == 2
