import datetime
import os

import pytest
from pyspark.sql import types as T

from tidemark.config import LakeConfig
from tidemark.operators.joins import align_outer, align_outer_by_join
from tidemark.plans import bronze
from tidemark.sources import files, tables

WIDE = "datetime,New York,Coeur d'Alene,Chicago\n2012-10-01 12:00:00,286.15,295.37,x\n2012-10-01 13:00:00,,295.4,284.9\n"


@pytest.fixture
def lake(tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "temperature.csv").write_text(WIDE)
    (landing / "humidity.csv").write_text(
        "datetime,New York,Chicago\n2012-10-01 12:00:00,50,60\n2012-10-01 14:00:00,51,61\n"
    )
    (landing / "weather_description.csv").write_text(
        "datetime,New York\n2012-10-01 12:00:00,light rain\n"
    )
    (landing / "city_attributes.csv").write_text(
        "City,Country,Latitude,Longitude\nNew York,United States,40.71,-74.0\nChicago,United States,41.85,-87.65\n"
    )
    return LakeConfig(str(tmp_path))


def test_unpivot_keeps_nulls_and_odd_names(spark, lake):
    long = files.read_attribute(
        spark, f"{lake.landing}/temperature.csv", "temperature", T.DoubleType()
    )
    rows = {(r.datetime.hour, r.city): r.temperature for r in long.collect()}
    assert rows == {
        (12, "New York"): 286.15, (12, "Coeur d'Alene"): 295.37, (12, "Chicago"): None,
        (13, "New York"): None, (13, "Coeur d'Alene"): 295.4, (13, "Chicago"): 284.9,
    }


def test_ingest_is_repeatable(spark, lake):
    assert bronze.run_batch(spark, lake) > 0
    first = tables.read_table(spark, lake.table("bronze_weather_batch"))
    rows = {(r.datetime, r.city): r for r in first.collect()}
    assert len(rows) == 8 == first.count()
    noon = datetime.datetime(2012, 10, 1, 12)
    row = rows[(noon, "New York")]
    assert (row.temperature, row.humidity, row.weather_description) == (286.15, 50.0, "light rain")
    assert row.country == "United States" and row.source == "kaggle_csv"
    assert row.pressure is None
    assert rows[(noon, "Coeur d'Alene")].country is None
    # nothing new: nothing is written
    assert bronze.run_batch(spark, lake) == 0
    assert tables.read_table(spark, lake.table("bronze_weather_batch")).count() == 8
    assert files.new_files(spark, lake.landing, lake.manifest).count() == 0


def test_later_files_add_only_their_own_rows(spark, lake):
    bronze.run_batch(spark, lake)
    with open(f"{lake.landing}/notes.csv", "w") as f:
        f.write("a,b\n1,2\n")
    assert bronze.run_batch(spark, lake) == 0
    with open(f"{lake.landing}/pressure.csv", "w") as f:
        f.write("datetime,Chicago\n2012-10-01 12:00:00,1010\n")
    assert bronze.run_batch(spark, lake) == 1
    assert bronze.run_batch(spark, lake) == 0
    assert tables.read_table(spark, lake.table("bronze_weather_batch")).count() == 9


def test_manifest_sees_only_new_files(spark, lake):
    found = files.new_files(spark, lake.landing, lake.manifest)
    assert found.count() == 4
    files.record_files(found, lake.manifest)
    with open(os.path.join(lake.landing, "pressure.csv"), "w") as f:
        f.write("datetime,Chicago\n2012-10-01 12:00:00,1010\n")
    new = files.new_files(spark, lake.landing, lake.manifest)
    assert [os.path.basename(r.path) for r in new.collect()] == ["pressure.csv"]


def test_missing_inputs(spark, tmp_path):
    assert files.read_attribute(spark, str(tmp_path / "no.csv"), "x", T.DoubleType()) is None
    assert tables.read_cities(spark, str(tmp_path / "no.csv")) is None
    (tmp_path / "only.csv").write_text("datetime\n2012-10-01 12:00:00\n")
    assert files.read_attribute(spark, str(tmp_path / "only.csv"), "x", T.DoubleType()) is None
    assert not tables.exists(spark, str(tmp_path / "nothing"))
    assert tables.read_if_present(spark, str(tmp_path / "nothing")) is None


def test_no_metadata_gives_null_columns(spark, lake):
    frame = files.read_attribute(
        spark, f"{lake.landing}/temperature.csv", "temperature", T.DoubleType()
    )
    row = bronze.batch_bronze({"temperature": frame}, None).first()
    assert row.country is None and row.latitude is None


def frames(spark):
    return {
        "a": spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "k int, c string, a double"),
        "b": spark.createDataFrame([(2, "y", "p"), (3, "z", None)], "k int, c string, b string"),
    }


def test_alignment_forms_agree(spark):
    key = lambda df: sorted((tuple(r) for r in df.select("k", "c", "a", "b").collect()), key=repr)
    fused = align_outer(frames(spark), ["k", "c"])
    assert key(fused) == key(align_outer_by_join(frames(spark), ["k", "c"]))
    assert fused.count() == 3


def test_repeated_key_is_an_error(spark):
    both = frames(spark)
    both["a"] = both["a"].union(both["a"])
    with pytest.raises(Exception, match="repeats a key"):
        align_outer(both, ["k", "c"]).collect()


def test_dead_run_is_repeated_with_its_own_files(spark, lake):
    """Rows are written, the manifest is not; more files land before the next run."""
    claimed = files.next_batch(spark, lake.landing, lake.manifest, lake.claims)
    assert bronze.ingest(spark, lake, claimed) == 8
    with open(f"{lake.landing}/pressure.csv", "w") as f:
        f.write("datetime,Chicago\n2012-10-01 12:00:00,1010\n")
    again = files.next_batch(spark, lake.landing, lake.manifest, lake.claims)
    assert {r.path for r in again.collect()} == {r.path for r in claimed.collect()}
    assert bronze.run_batch(spark, lake) == 8  # the same files, into the same partition
    stored = lambda: tables.read_table(spark, lake.table("bronze_weather_batch"))
    assert stored().count() == 8 and stored().select("batch").distinct().count() == 1
    assert bronze.run_batch(spark, lake) == 1  # then the file that came later
    assert bronze.run_batch(spark, lake) == 0
    assert stored().count() == 9 and stored().select("batch").distinct().count() == 2


def test_dead_claim_holds_nothing(spark, lake):
    """A run that dies right after its claim, before any row."""
    files.next_batch(spark, lake.landing, lake.manifest, lake.claims)
    assert not tables.exists(spark, lake.table("bronze_weather_batch"))
    assert bronze.run_batch(spark, lake) == 8
    assert bronze.run_batch(spark, lake) == 0


def test_changed_file_is_a_new_one(spark, lake):
    assert bronze.run_batch(spark, lake) == 8
    os.utime(f"{lake.landing}/humidity.csv", (2_000_000_000, 2_000_000_000))
    assert bronze.run_batch(spark, lake) == 4
    assert bronze.run_batch(spark, lake) == 0
