"""All layers in order, from files and messages to forecasts and reports."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from samples import message

from tidemark.config import TABLE_NAMES, LakeConfig
from tidemark.ml import training as models
from tidemark.operators import sinks
from tidemark.plans import bronze, features, gold, online, reports, silver, training, validation
from tidemark.sources.messages import read_folder
from tidemark.sources.tables import read_if_present

HOURS = 24 * 12


def small_forest(train):
    from pyspark.ml.regression import RandomForestRegressor

    return RandomForestRegressor(labelCol="label_24h", numTrees=5, maxDepth=4, seed=42).fit(train)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = LakeConfig(str(root))
    start = datetime.datetime(2017, 1, 1)
    times = [start + datetime.timedelta(hours=h) for h in range(HOURS)]
    landing = root / "landing"
    landing.mkdir()
    cities = ["New York", "Coeur d'Alene"]
    for attribute, base in (("temperature", 280), ("humidity", 40), ("pressure", 1000), ("wind_speed", 3)):
        lines = ["datetime," + ",".join(cities)]
        lines += [f"{t},{base + t.hour},{base + t.hour / 2 + t.day % 3}" for t in times]
        (landing / f"{attribute}.csv").write_text("\n".join(lines) + "\n")
    lines = ["datetime," + ",".join(cities)]
    lines += [f"{t},{'light rain' if t.day % 2 else 'sky is clear'},mist" for t in times]
    (landing / "weather_description.csv").write_text("\n".join(lines) + "\n")
    (landing / "city_attributes.csv").write_text(
        "City,Country,Latitude,Longitude\nNew York,United States,40.71,-74.0\n"
    )
    first = int(datetime.datetime(2017, 1, 13, tzinfo=datetime.timezone.utc).timestamp())
    (root / "in").mkdir()
    with open(root / "in" / "1.json", "w") as f:
        for i in range(36):
            item = message("New York", first + 300 * i, 10.0 + i % 12, main="Clear", country="US")
            f.write(json.dumps(item) + "\n")

    assert bronze.run_batch(spark, lake) == HOURS * 2
    bronze.run_stream(read_folder(spark, f"{root}/in"), lake, available_now=True).awaitTermination()
    assert silver.run(spark, lake) == 1
    current = silver.table(spark, lake).read()
    gold.run(spark, lake, silver.table(spark, lake))
    features.run(spark, lake, silver.table(spark, lake))
    return lake


def table(spark, lake, name):
    if name in ("hourly_weather", "daily_weather", "training_data"):
        return features.table(spark, lake, name).read()
    return spark.read.parquet(lake.table(name))


def test_row_counts(spark, lake):
    current = silver.table(spark, lake).read()
    assert current.count() == HOURS * 2 + 36
    assert {r.country for r in current.select("country").distinct().collect()} == {"United States", None}
    daily = table(spark, lake, "fact_weather_daily_stats")
    assert daily.count() == 12 * 2 + 1
    assert table(spark, lake, "fact_weather_city_summary").count() == 2
    assert table(spark, lake, "dim_date").count() == 13
    # twelve five-minute rows make one hourly row
    assert table(spark, lake, "hourly_weather").count() == HOURS * 2 + 3
    assert table(spark, lake, "training_data").count() == HOURS * 2 + 3 - 48


def test_validation_passes(spark, lake):
    stream = read_if_present(spark, lake.table("bronze_weather_streaming"))
    batch = read_if_present(spark, lake.table("bronze_weather_batch"))
    assert validation.bronze(stream, batch) == (HOURS * 2 + 36, [])
    current = silver.table(spark, lake).read()
    validation.silver(current)
    validation.gold(table(spark, lake, "fact_weather_daily_stats"), current)


def test_running_again_changes_nothing(spark, lake):
    before = silver.table(spark, lake).read().drop("transformed_at")
    rows = sorted(map(repr, before.collect()))
    assert bronze.run_batch(spark, lake) == 0
    silver.run(spark, lake)
    after = silver.table(spark, lake).read().drop("transformed_at")
    assert sorted(map(repr, after.collect())) == rows


def test_month_partitions_hold_the_same_rows(spark, lake, tmp_path):
    by_month = LakeConfig(str(tmp_path), silver_partition="recorded_month")
    for name in ("bronze_weather_batch", "bronze_weather_streaming"):
        sinks.append(table(spark, lake, name), by_month.table(name))
    silver.run(spark, by_month)
    stored = silver.table(spark, by_month)
    assert list(stored._pointer(1)["partitions"]) == ["2017-01"]
    assert stored.read().count() == silver.table(spark, lake).read().count()


def test_single_entity(spark, lake):
    one = LakeConfig(lake.root + "/one", entity="New York")
    current = silver.table(spark, lake).read()
    features_of_one = features.hourly_series(current, one.entity)
    assert features_of_one.select("city").distinct().count() == 1


def test_lags_cross_the_source_border(spark, lake):
    hourly = table(spark, lake, "hourly_weather").filter("city = 'New York'").orderBy("recorded_at").collect()
    border = next(r for r in hourly if r.recorded_at == datetime.datetime(2017, 1, 13))
    assert border.temp == pytest.approx(sum(10.0 + i for i in range(12)) / 12)
    assert border.temp_lag_1h == pytest.approx(280 + 23 - 273.15)
    assert hourly[0].temp_lag_24h == hourly[0].temp and hourly[0].temp_24h_std == 0.0


def test_registered_tables_answer_sql(spark, lake):
    versioned = ("silver_weather_clean", "hourly_weather", "daily_weather", "training_data")
    plain = {n: lake.table(n) for n in TABLE_NAMES if n not in versioned}
    for name in versioned[1:]:
        assert features.table(spark, lake, name).register(name)
    done = sinks.register(spark, plain | {"absent": lake.root + "/absent"})
    assert not done.pop("absent") and all(done.values())
    assert all(sinks.register(spark, plain).values())  # again: nothing changes
    assert silver.table(spark, lake).register("silver_weather_clean")
    names = {t.name for t in spark.catalog.listTables()}
    assert set(TABLE_NAMES) <= names
    star = spark.sql(
        "SELECT d.year, d.month, count(*) AS n FROM fact_weather_daily_stats f "
        "JOIN dim_date d ON f.date_id = d.date_id GROUP BY d.year, d.month"
    ).collect()
    assert [(r.year, r.month, r.n) for r in star] == [(2017, 1, 25)]
    assert spark.sql("SELECT count(*) FROM silver_weather_clean").first()[0] == HOURS * 2 + 36
    nested = spark.sql("SELECT main.temp FROM bronze_weather_streaming ORDER BY dt DESC LIMIT 1")
    assert nested.first()[0] == 21.0


def test_reports(spark, lake):
    daily = table(spark, lake, "fact_weather_daily_stats")
    monthly = table(spark, lake, "fact_weather_monthly_stats")
    current = silver.table(spark, lake).read()
    stream = table(spark, lake, "bronze_weather_streaming")
    batch = table(spark, lake, "bronze_weather_batch")
    assert reports.newest_daily(daily).count() == 10
    assert reports.trend(daily, "2017-01-12", partitioned=True).count() == 3
    month = reports.newest_months(monthly).filter("city = 'New York'").first()
    assert (month.rainy_day_count, month.clear_day_count) == (6, 7)
    assert reports.seasonal(monthly).count() == 2
    assert reports.by_year_month(daily, table(spark, lake, "dim_date")).count() == 1
    assert reports.batch_profile(batch).first().num_cities == 2
    assert reports.newest_messages(stream).count() == 10
    assert reports.messages_per_day(stream).first().records == 36
    assert reports.stream_profile(stream).first().total_records == 36
    assert reports.newest_rows(current).first().source == "openweather_api"
    counts = {r.layer: r.records for r in reports.layer_counts(batch, None, current).collect()}
    assert counts == {"bronze_batch": HOURS * 2, "bronze_streaming": None, "silver": HOURS * 2 + 36}
    assert reports.source_coverage(current).count() == 2
    assert reports.year_average(monthly, "2017").first()[0] is not None
    assert reports.row_count(current).first()[0] == HOURS * 2 + 36
    assert reports.dump(table(spark, lake, "dim_city"), "city_id").count() == 2
    assert reports.summary(table(spark, lake, "fact_weather_city_summary")).count() == 2


def test_pushed_rows(spark, lake):
    rows = online.latest_rows(table(spark, lake, "hourly_weather"))
    got = {r.city: json.loads(r.features) for r in rows.collect()}
    assert set(got) == {"New York", "Coeur d'Alene"}
    assert got["New York"]["hour"] == 2 and "recorded_date" not in got["New York"]
    folder = lake.root + "/store"
    import os

    os.makedirs(folder)

    def put(partition):
        for row in partition:
            with open(f"{folder}/{row.city.replace(' ', '_')}", "w") as f:
                f.write(row.features)

    sinks.push_rows(rows, put)
    assert len(os.listdir(folder)) == 2


def test_training_and_forecast(spark, lake):
    requests = spark.createDataFrame(
        [("New York", 12.0, 50.0, 1010.0, 3.0, 14, 2, 1)],
        "city string, temperature double, humidity double, pressure double, wind_speed double,"
        "hour int, day_of_week int, month int",
    )
    made, rejected = training.forecast(spark, lake, requests.union(requests.withColumn("hour", F.lit(24))))
    assert [r.model_version for r in made.collect()] == ["fallback"]
    assert [r.rejected_by for r in rejected.collect()] == [["hour out of range"]]
    assert training.run(spark, LakeConfig(lake.root + "/empty")) is None
    algorithms = {"RandomForest": small_forest, "Ridge": models.ridge}
    winner = training.run(spark, lake, algorithms)
    assert winner.r2 > 0.5
    row = training.forecast(spark, lake, requests)[0].first()
    assert row.model_version == "1"
    # The stored category of the city is encoded by the saved pipeline.
    newest = online.latest_features(table(spark, lake, "hourly_weather")).where("city = 'New York'").first()
    known = table(spark, lake, "training_data").select("weather_condition").distinct().collect()
    codes = sorted(r[0] or "Unknown" for r in known)
    assert row.condition_encoded == (codes.index(newest.condition) if newest.condition in codes else len(codes))
    given = training.forecast(spark, lake, requests.withColumn("condition_encoded", F.lit(1)))[0].first()
    assert given.condition_encoded == 1.0
    assert row.confidence_lower <= row.predicted_temperature_24h <= row.confidence_upper
    training.run(spark, lake, algorithms)
    assert training.production_model(spark, lake)[1] == "2"


def test_incremental_runs_touch_only_what_is_new(spark, lake, tmp_path):
    """New bronze rows reach silver once; only their days are grouped again."""
    step = LakeConfig(str(tmp_path))
    batch, target = table(spark, lake, "bronze_weather_batch"), silver.table(spark, step)
    early = batch.filter("datetime < '2017-01-12'")
    sinks.append(early, step.table("bronze_weather_batch"))
    assert silver.run_new(spark, step) == 1
    gold.run(spark, step, target)
    first = gold.cube_table(spark, step)._pointer(1)["partitions"]
    assert silver.run_new(spark, step) == 1  # nothing new

    sinks.append(batch.filter("datetime >= '2017-01-12'"), step.table("bronze_weather_batch"))
    sinks.append(table(spark, lake, "bronze_weather_streaming"), step.table("bronze_weather_streaming"))
    assert silver.run_new(spark, step) == 3
    assert target.changed_since(1) == ["2017-01-12", "2017-01-13"]
    gold.run(spark, step, target)
    second = gold.cube_table(spark, step)._pointer(2)["partitions"]
    assert {d for d in second if first.get(d) != second[d]} == {"2017-01-12", "2017-01-13"}

    columns = ["city", "recorded_date", F.round("avg_temperature", 9), "measurement_count", "city_id", "date_id"]
    key = lambda at: sorted(map(repr, table(spark, at, "fact_weather_daily_stats").select(*columns).collect()))
    assert key(step) == key(lake)


def test_features_follow_what_changed(spark, lake, tmp_path):
    """A late day is computed again with the rows it reaches, the rest is kept; same as a rebuild."""
    step = LakeConfig(str(tmp_path))
    batch = table(spark, lake, "bronze_weather_batch")
    late = F.to_date("datetime") == F.lit("2017-01-04").cast("date")
    sinks.append(batch.where(~late), step.table("bronze_weather_batch"))
    sinks.append(table(spark, lake, "bronze_weather_streaming"), step.table("bronze_weather_streaming"))
    source = silver.table(spark, step)

    def bring_up():
        silver.run_new(spark, step)
        gold.run(spark, step, source)
        return features.run(spark, step, source)

    first = bring_up()
    assert "2017-01-04" not in first and len(first) > 10
    assert bring_up() == []
    sinks.append(batch.where(late), step.table("bronze_weather_batch"))
    again = bring_up()
    assert "2017-01-04" in again and len(again) < len(first)
    for name, keys in (("hourly_weather", ["city", "recorded_at"]), ("training_data", ["city", "recorded_at"]),
                       ("daily_weather", ["city", "recorded_date"])):
        rounded = lambda at: sorted(
            map(repr, (df := table(spark, at, name)).select(
                *keys, *[F.round(c, 9).alias(c) for c, t in sorted(df.dtypes) if t == "double"]).collect())
        )
        assert rounded(step) == rounded(lake), name
    # Other settings mean another table: everything is built again.
    other = LakeConfig(str(tmp_path), horizon=12)
    assert features.run(spark, other, source) == sorted({*first, "2017-01-04"})
