"""Physical plans: what is pushed down, combined early, split or broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from tidemark.checks import observations as obs
from tidemark.operators.filters import since
from tidemark.operators.joins import align_outer, align_outer_by_join, attach
from tidemark.operators.sinks import overwrite_partitions
from tidemark.plans import features, gold, silver

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_is_used(spark):
    text = obs.silver_plain(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(value" in text and "IsNotNull(user_id)" in text
    counted = plan(entry_point.queries()["rows_per_day"](spark, SF))
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz>", counted)


def test_dedup_limits_before_the_shuffle(spark):
    text = plan(obs.silver_plain(spark, SF))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_facts_combine_before_the_shuffle(spark):
    text = plan(gold.day_cube(obs.observations(spark, SF).withColumn("recorded_date", F.to_date("recorded_at"))))
    assert "SortAggregate" not in text and "partial_max_by" in text
    assert text.count("Exchange") == 1


def test_monthly_fact_has_no_expand(spark):
    assert "Expand" not in plan(gold.monthly_fact(obs.cube(spark, SF)))


def test_lookup_joins_the_cube_not_the_observations(spark):
    """The attribute join sits above the aggregate."""
    text = plan(obs.cube(spark, SF))
    assert text.index("Join") < text.index("HashAggregate")


def test_fused_alignment_shuffles_once(spark):
    frames = {
        n: spark.range(50).select(F.col("id").alias("k"), F.rand(1).alias(n)) for n in ("a", "b", "c", "d")
    }
    assert plan(align_outer(frames, ["k"])).count("Exchange") == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(align_outer_by_join(frames, ["k"])).count("Exchange") > 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_n_is_not_a_sort(spark):
    text = plan(entry_point.queries()["newest_rows"](spark, SF))
    assert "TakeOrderedAndProject" in text


def test_partition_pruning_by_implied_month(spark, tmp_path):
    days = spark.range(120).select(F.expr("date_add(DATE '2017-01-01', CAST(id AS INT))").alias("recorded_date"))
    keyed = days.withColumns({"year": F.year("recorded_date"), "month": F.month("recorded_date")})
    overwrite_partitions(keyed, str(tmp_path / "t"), ["year", "month"])
    stored = spark.read.parquet(str(tmp_path / "t"))
    late = since(stored, "recorded_date", "2017-04-10", partitioned=True)
    assert late.count() == 21
    assert {f.split("month=")[1][0] for f in late.inputFiles()} <= set("1234")
    assert re.search(r"PartitionFilters: \[[^\]]*month", plan(late))


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 2017, 1), (2, 2017, 2)], "v int, year int, month int")
    overwrite_partitions(rows, path, ["year", "month"])
    new = spark.createDataFrame([(9, 2017, 2)], "v int, year int, month int")
    overwrite_partitions(new, path, ["year", "month"], replace_all=False)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]
    overwrite_partitions(new, path, ["year", "month"])
    assert [r.v for r in spark.read.parquet(path).collect()] == [9]


@pytest.fixture
def small_skew(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def test_hot_lookup_key_is_split(spark, small_skew, tmp_path):
    """A third of the rows share one key; AQE splits that partition even though the
    aggregate above would reuse the join's partitioning."""
    rows = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("city"),
        F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    dim = spark.range(1000).select(F.col("id").alias("city"), (F.col("id") * 2).alias("twice"))
    joined = attach(rows, dim, "city").groupBy("city", "twice").agg(
        F.count(F.lit(1)).alias("n"), F.max("pad").alias("pad")
    )
    got = {r.city: (r.n, r.twice) for r in joined.collect()}
    assert got[7][1] == 14 and sum(n for n, _ in got.values()) == 60000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_silver_of_one_hot_copy_group(spark):
    """Very many copies of one key leave one row, limited before the shuffle."""
    rows = spark.range(20000).select(
        F.lit("a").alias("city"), F.lit(1).cast("long").alias("recorded_dt"), F.lit("s").alias("source"),
        F.timestamp_seconds("id").alias("ingested_at"), F.col("id").cast("double").alias("temperature"),
        F.lit(1).alias("humidity"),
    )
    out = silver.unique(rows)
    assert [r.temperature for r in out.collect()] == [19999.0]


def test_training_windows_share_one_shuffle_and_sort(spark):
    """Labels, running sums and lags use one partitioning and order."""
    rows = spark.range(10).select(
        F.lit("a").alias("city"), F.timestamp_seconds("id").alias("recorded_at"),
        F.current_date().alias("recorded_date"), F.lit("x").alias("weather_condition"),
        *[F.col("id").cast("double").alias(m) for m in features.MEASURES],
    )
    text = plan(features.training_frame(rows, digits=2, hot=None))
    assert text.count("Exchange") == 1 and text.count("Sort ") == 1


def test_a_late_day_is_cut_out_at_the_scan(spark):
    late = F.col("recorded_date") == F.lit("2024-01-15").cast("date")
    text = plan(obs.silver_plain(spark, SF, late))
    assert re.search(r"ts#\d+ >= 2024-01-15", text).start() > text.rindex("Exchange")
    got = obs.silver_plain(spark, SF, late).union(obs.silver_plain(spark, SF, ~late))
    assert got.exceptAll(obs.silver_plain(spark, SF)).isEmpty() and got.count() == obs.silver_plain(spark, SF).count()


def test_hourly_features_need_no_training_rows(spark, monkeypatch):
    from tidemark.checks import queries

    def never(*_, **__):
        raise AssertionError("training rows were built")

    monkeypatch.setattr(queries.features, "training_frame", never)
    assert entry_point.queries()["features_after_late_day"](spark, SF).count() > 0
