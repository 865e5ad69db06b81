import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.ml import prepare, scoring, training
from tidemark.ml.registry import ModelRegistry
from tidemark.ml.splits import best_split
from tidemark.operators.quality import QualityError, check, enforce


def small_forest(train):
    from pyspark.ml.regression import RandomForestRegressor

    return RandomForestRegressor(labelCol="label_24h", numTrees=5, maxDepth=4, seed=42).fit(train)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.range(400).select(
        F.lit("a").alias("city"),
        F.timestamp_seconds(F.col("id") * 3600).alias("recorded_at"),
        (F.sin(F.col("id") / 10) * 10).alias("temperature"),
        (F.col("id") % 50).cast("double").alias("humidity"),
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, "rain").otherwise("clear")).alias("weather_condition"),
        (F.sin((F.col("id") + 24) / 10) * 10 + F.col("id") % 50 / 25).alias("label_24h"),
        F.lit(1.0).alias("label_6h"),
    )


def test_codes_are_alphabetical_with_unknown(frame):
    coded = prepare.encode(frame, prepare.fit_encoder(frame))
    codes = {(r[0], r[1]) for r in coded.select("weather_condition", "condition_encoded").distinct().collect()}
    assert codes == {(None, 0.0), ("clear", 1.0), ("rain", 2.0)}


def test_input_columns_leave_out_labels_and_keys(frame):
    coded = prepare.encode(frame, prepare.fit_encoder(frame))
    assert prepare.input_columns(coded) == ["temperature", "humidity", "condition_encoded"]


def test_engineer_fills_forward_per_city(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1.0, None, 1.0), ("a", 2, 2.0, 5.0, 1.0), ("a", 3, 3.0, None, 1.0),
         ("b", 1, 4.0, None, 1.0), ("a", 4, None, 7.0, 1.0), ("a", 5, 4.0, 8.0, None)],
        "city string, t int, temperature double, humidity double, label_24h double",
    ).withColumn("weather_condition", F.lit("x"))
    out = prepare.engineer(rows, prepare.fit_encoder(rows), ["t"])
    got = {(r.city, r.t): r.humidity for r in out.collect()}
    assert got == {("a", 1): 0.0, ("a", 2): 5.0, ("a", 3): 5.0, ("b", 1): 0.0}


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    side = prepare.in_training(["id"])
    one = {r.id for r in df.repartition(1).filter(side).collect()}
    many = {r.id for r in df.repartition(13).filter(side).collect()}
    assert one == many and 0.77 < len(one) / 2000 < 0.83


def test_scaling_is_population_and_guards_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, c double")
    plain, exact = prepare.fit_scaling(df, ["x", "c"]), prepare.fit_scaling(df, ["x", "c"], {"x": 2, "c": 2})
    mean, sd = 7 / 3, math.sqrt(((1 - 7 / 3) ** 2 + (2 - 7 / 3) ** 2 + (4 - 7 / 3) ** 2) / 3)
    for s in (plain, exact):
        assert s.mean["x"] == pytest.approx(mean) and s.deviation["x"] == pytest.approx(sd)
        assert s.deviation["c"] == 1.0
    scaled = plain.transformer().transform(df).agg(F.avg("scaled_x"), F.stddev_pop("scaled_x")).first()
    assert scaled[0] == pytest.approx(0) and scaled[1] == pytest.approx(1)


def test_ridge_equals_closed_form(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 2))
    y = x @ [2.0, -1.0] + 3 + rng.normal(size=60)
    df = spark.createDataFrame(
        [(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, label_24h double"
    )
    model = training.ridge(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df))
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + np.eye(2), xc.T @ yc)
    assert list(model.coefficients) == pytest.approx(list(w), abs=1e-6)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ w, abs=1e-6)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "label double, prediction double")
    for digits in (None, 2):
        row = training.metrics(df, "label", digits=digits).first()
        assert row.mae == pytest.approx(0.5)
        assert row.rmse == pytest.approx(math.sqrt(1.25 / 3))
        assert row.r2 == pytest.approx(1 - 1.25 / (14 / 3))


def test_train_save_load_score(spark, frame, tmp_path):
    coded = prepare.encode(frame, prepare.fit_encoder(frame))
    columns = prepare.input_columns(coded)
    results = training.train_all(
        coded, columns, ["city", "recorded_at"], {"Forest": small_forest, "Ridge": training.ridge}
    )
    assert {r.algorithm for r in results} == {"Forest", "Ridge"}
    winner = training.best(results)
    assert winner.r2 == max(r.r2 for r in results) and winner.r2 > 0.5
    training.save(winner.model, str(tmp_path / "m"))
    loaded = training.load(str(tmp_path / "m"))
    requests = coded.select("city", "temperature", "humidity", F.lit(None).cast("int").alias("condition_encoded"))
    scored = scoring.score(requests, None, loaded, "7")
    row = scored.first()
    assert row.model_version == "7"
    assert row.confidence_lower <= row.predicted_temperature_24h <= row.confidence_upper
    assert scored.count() == 400


def test_registry(spark, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "r"))
    numbers = {"mae": 1.0, "rmse": 1.0, "r2": 0.5}
    assert registry.versions().count() == 0
    first = registry.register("Ridge", numbers, "p1")
    registry.promote(first)
    second = registry.register("RandomForest", numbers, "p2")
    registry.promote(second)
    stages = {r.version: (r.stage, r.algorithm) for r in registry.versions().collect()}
    assert stages == {1: ("Archived", "Ridge"), 2: ("Production", "RandomForest")}
    registry.transition(1, "Staging")
    assert {(r.version, r.stage) for r in registry.latest().collect()} == {(1, "Staging"), (2, "Production")}
    with pytest.raises(ValueError):
        registry.transition(1, "Elsewhere")
    with pytest.raises(KeyError):
        registry.promote(9)


REQUEST = "city string, temperature double, humidity double, pressure double, wind_speed double, hour int, day_of_week int, month int, temp_lag_1h double"


def test_default_chain(spark):
    requests = spark.createDataFrame(
        [("a", 10.0, 40.0, 1000.0, 1.0, 5, 1, 1, 9.0), ("a", 11.0, 40.0, 1000.0, 1.0, 5, 1, 1, None),
         ("b", 12.0, 41.0, 1000.0, 1.0, 5, 1, 1, None)],
        REQUEST,
    )
    latest = spark.createDataFrame([("a", 7.0, 3.5)], "city string, temp_lag_1h double, temp_24h_std double")
    rows = {r.temperature: r for r in scoring.with_defaults(requests, latest).collect()}
    assert [rows[t].temp_lag_1h for t in (10.0, 11.0, 12.0)] == [9.0, 7.0, 12.0]
    assert [rows[t].temp_24h_std for t in (10.0, 12.0)] == [3.5, 2.0]
    assert rows[12.0].humid_24h_ma == 41.0 and rows[12.0].condition_encoded == 0
    none = scoring.with_defaults(requests, None).filter("temperature = 11").first()
    assert none.temp_lag_1h == 11.0


def test_fallback_and_band(spark):
    requests = spark.createDataFrame(
        [("a", 10.0, 40.0, 1000.0, 1.0, h, 1, 1, None) for h in (12, 13)], REQUEST
    )
    rows = {r.hour: r for r in scoring.score(requests, None, None).collect()}
    assert rows[13].predicted_temperature_24h == 10.5 and rows[12].predicted_temperature_24h == 9.5
    assert (rows[13].confidence_lower, rows[13].confidence_upper) == (8.5, 12.5)
    assert rows[12].model_version == "fallback"
    band = scoring.with_band(requests.withColumn("prediction", F.lit(14.0))).first()
    assert (band.confidence_lower, band.confidence_upper) == (12.82, 15.18)


def test_row_scaling_matches_numpy(spark):
    import numpy as np

    values = [10.0, 40.0, 1000.0, 1.0]
    df = spark.createDataFrame([tuple(values)], "a double, b double, c double, d double")
    row = scoring.row_scaled(df, ["a", "b", "c", "d"]).first()
    x = np.array(values)
    assert [row[f"scaled_{c}"] for c in "abcd"] == pytest.approx(list((x - x.mean()) / (x.std() + 1e-8)))


def test_request_rules(spark):
    bad = spark.createDataFrame([("a", 10.0, 40.0, 1000.0, 1.0, 24, 0, None, None)], REQUEST)
    report = {r.rule: r.violations for r in check(bad, scoring.request_rules()).collect()}
    assert report["hour out of range"] == 1 and report["day_of_week out of range"] == 1
    assert report["month is missing"] == 1 and report["month out of range"] == 0
    with pytest.raises(QualityError):
        enforce(check(bad, scoring.request_rules()))


def test_best_split_against_all_cuts(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(40) / 4, rng.randrange(-500, 900) / 100) for _ in range(400)]
    rows = [(x, y + (3 if x > 6.25 else 0)) for x, y in rows] + [(None, 1.0), (2.0, None)]
    found = best_split(spark.createDataFrame(rows, "x double, y double"), "x", "y").first()
    known = [(x, y) for x, y in rows if x is not None and y is not None]

    def error(cut):
        sides = [[y for x, y in known if (x <= cut) is side] for side in (True, False)]
        return sum(sum((y - sum(s) / len(s)) ** 2 for y in s) for s in sides)

    cuts = sorted({x for x, _ in known})[:-1]
    assert found.cut == min(cuts, key=error)
    left = [y for x, y in known if x <= found.cut]
    assert found.rows_left == len(left) and found.rows_right == len(known) - len(left)
    assert found.mean_left == pytest.approx(sum(left) / len(left))
    assert best_split(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), "x", "y").first().cut is None


def test_rejected_requests_name_their_rules(spark):
    rows = [("a", 10.0, 40.0, 1000.0, 1.0, h, d, 1, None) for h, d in ((12, 1), (24, 1), (24, 9))]
    rows.append(("b", None, 40.0, 1000.0, 1.0, 3, 1, 1, None))
    accepted, rejected = scoring.split_requests(spark.createDataFrame(rows, REQUEST))
    assert accepted.count() == 1 and "rejected_by" not in accepted.columns
    assert sorted(map(tuple, (r.rejected_by for r in rejected.collect()))) == [
        ("hour out of range",), ("hour out of range", "day_of_week out of range"), ("temperature is missing",)
    ]


def test_category_of_a_request(spark):
    """The request's own code, then its category, then the stored one, then the constant."""
    frame = spark.createDataFrame([("clear",), ("rain",), (None,)], "weather_condition string")
    stages = PipelineModel(prepare.category_stages(prepare.fit_encoder(frame)))
    requests = spark.createDataFrame(
        [("a", None, None), ("b", None, None), ("a", "clear", None), ("a", "clear", 7), ("a", "hail", None)],
        "city string, weather_condition string, condition_encoded int",
    ).withColumns({"temperature": F.lit(1.0), "humidity": F.lit(1.0)})
    latest = spark.createDataFrame([("a", "rain")], "city string, condition string")
    coded = stages.transform(scoring.with_category(requests, latest)).collect()
    got = {(r.city, r.weather_condition, r.condition_given): r.condition_encoded for r in coded}
    assert got == {
        ("a", "rain", None): 2.0, ("b", None, 0.0): 0.0, ("a", "clear", None): 1.0, ("a", "clear", 7.0): 7.0, ("a", "hail", None): 3.0
    }


def test_a_forest_does_not_depend_on_the_files(spark, frame):
    """What it draws follows from the rows, however the frame is stored."""
    coded = prepare.encode(frame, prepare.fit_encoder(frame))
    columns, keys = prepare.input_columns(coded), ["city", "recorded_at"]
    rows = [
        training.train_all(coded.repartition(n), columns, keys, {"Forest": small_forest})[0].mae for n in (1, 3)
    ]
    assert rows[0] == pytest.approx(rows[1], rel=1e-9)


def test_rows_to_fit_lie_in_even_ordered_parts(spark, frame):
    train = frame.coalesce(1)
    found = training.dealt(train, ["temperature"], ["city", "recorded_at"]).select("temperature").rdd.glom().collect()
    assert len(found) == spark.sparkContext.defaultParallelism and sum(map(len, found)) == train.count()
    assert all(part == sorted(part) for part in found) and max(map(len, found)) < 100
