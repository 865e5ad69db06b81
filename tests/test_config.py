import os

import pytest

from tidemark.config import LakeConfig, materialise, scratch, shared_folder, size_shuffles

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_paths_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("LAKE_ROOT", "s3a://bucket/lake/")
    monkeypatch.setenv("ANALYSIS_CITY", "New York")
    monkeypatch.setenv("FEATURE_DIGITS", "4")
    monkeypatch.setenv("ROWS_PER_TASK", "500")
    lake = LakeConfig.from_env()
    assert lake.table("dim_city") == "s3a://bucket/lake/tables/dim_city"
    assert (lake.entity, lake.feature_digits, lake.horizon, lake.rows_per_task) == ("New York", 4, 24, 500)
    with pytest.raises(KeyError):
        lake.table("elsewhere")
    with pytest.raises(ValueError):
        LakeConfig("x", silver_partition="recorded_hour")


def test_scratch_goes_to_the_shared_folder_and_away(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    with scratch(spark):
        with scratch(spark):
            inner = materialise(spark.range(3), "inner").inputFiles()[0]
        outer = materialise(spark.range(3), "outer").inputFiles()[0]
        assert shared_folder(spark) in inner
        assert not os.path.exists(inner.removeprefix("file://"))
        assert os.path.exists(outer.removeprefix("file://"))
    assert not os.path.exists(outer.removeprefix("file://"))


def test_shuffles_follow_the_stored_size(spark, tmp_path):
    spark.range(200_000).selectExpr("uuid() AS u").write.parquet(str(tmp_path / "t"))
    try:
        assert size_shuffles(spark, str(tmp_path / "t"), bytes_per_task=100_000) > 100
        assert size_shuffles(spark, str(tmp_path / "missing")) == 4
    finally:
        spark.conf.unset(INITIAL)
