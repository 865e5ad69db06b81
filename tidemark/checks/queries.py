"""Every operator as a query over the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.checks import observations as obs
from tidemark.config import LakeConfig, materialise, scratch_path
from tidemark.functions.scalar import month_key, violates_range
from tidemark.ml import prepare, scoring, splits, training
from tidemark.ml.registry import ModelRegistry
from tidemark.operators import aggregates, quality, sinks
from tidemark.operators.joins import align_outer, align_outer_by_join, attach
from tidemark.operators.ranking import dense_key, keep_first
from tidemark.operators.series import forward_fill, over_series
from tidemark.operators.shape import conform, expand, tag, union_sources, unpivot
from tidemark.operators.upsert import VersionedTable, merge_rows
from tidemark.plans import bronze, features, gold, online, reports, silver, validation
from tidemark.plans import training as plans_training
from tidemark.schemas import HUMIDITY_RANGE, TEMPERATURE_RANGE
from tidemark.sources import files, tables
from tidemark.sources.messages import read_folder
from tidemark.streaming import ingest

# A day that arrives late, and that splits deliveries.
LATE_DAY = "2024-01-15"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return obs.presented(build(spark, sf_dir))

    QUERIES[build.__name__.removesuffix("_query")] = run
    return run


# --- silver -----------------------------------------------------------------


@query
def silver_clean(spark, d):
    return silver.clean(obs.observations(spark, d)).drop("source", "ingested_at")


@query
def drop_accounting(spark, d):
    """Counted while the cleaned rows are written, checked and published."""
    cleaned, seen = silver.clean_counted(obs.observations(spark, d))
    table = VersionedTable(
        spark, scratch_path(spark, "audited"), silver.KEYS, "recorded_date", silver.newest_wins(cleaned.columns)
    )
    table.merge(cleaned, silver.rules())
    counts = quality.filter_counts(seen)
    return spark.range(1).select(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()])


@query
def conform_union(spark, d):
    rows = obs.observations(spark, d)
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("city", T.StringType()),
            T.StructField("temperature", T.DoubleType()),
            T.StructField("humidity", T.IntegerType()),
            T.StructField("visibility", T.IntegerType()),
        ]
    )
    streamed = rows.filter(F.col("source") == obs.STREAM).drop("humidity")
    filed = rows.filter(F.col("source") == obs.BATCH).drop("temperature")
    left = tag(conform(streamed, schema), obs.STREAM)
    right = tag(conform(filed, schema, {"temperature": "pressure"}), obs.BATCH)
    return union_sources([left.drop("visibility"), right.withColumn("visibility", F.lit(1))])


@query
def json_extract(spark, d):
    events = obs.table(spark, d, "events")
    parsed = events.select("event_id", F.from_json("props", "k int, missing string").alias("p"))
    return expand(parsed, "p", ["event_id"])


@query
def unpivot_measures(spark, d):
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = obs.table(spark, d, "lineitem").select(*ids, *measures)
    return unpivot(lines, ids, "measure", "amount", T.DoubleType(), measures)


def _hourly_maxima(spark, d) -> dict[str, DataFrame]:
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    events = obs.table(spark, d, "events").select(
        F.col("user_id").alias("city"), hour.alias("hour"), "event_type", "value"
    )
    return {
        kind: events.filter(F.col("event_type") == kind)
        .groupBy("city", "hour")
        .agg(F.max("value").alias(kind))
        for kind in obs.CONDITIONS
    }


@query
def outer_align(spark, d):
    return align_outer(_hourly_maxima(spark, d), ["city", "hour"])


@query
def outer_align_joined(spark, d):
    return align_outer_by_join(_hourly_maxima(spark, d), ["city", "hour"])


@query
def city_file(spark, d):
    """Attributes of the entities written as the metadata file and read back."""
    path = scratch_path(spark, "cities")
    names = {"city": "City", "country": "Country", "latitude": "Latitude", "longitude": "Longitude"}
    obs.attributes(spark, d).withColumnsRenamed(names).write.option("header", True).csv(path)
    return tables.read_cities(spark, path)


@query
def entity_rows(spark, d):
    """Cleaned rows of one entity and of several."""
    rows = obs.observations(spark, d)
    one, some = silver.clean(rows, 7), silver.clean(rows, [11, 42, 101])
    return tag(one, "one", "asked").unionByName(tag(some, "some", "asked")).select("asked", "city", "event_id")


@query
def stored_tables(spark, d):
    """What the guards, the overwriting sink and the catalog say of present, empty and absent tables."""
    rows, root = obs.observations(spark, d), scratch_path(spark, "stored")
    feeds = {"checked_batch": obs.BATCH, "checked_stream": obs.STREAM}
    for name, feed in feeds.items():
        sinks.overwrite(rows, f"{root}/{name}")
        sinks.overwrite(rows.where(F.col("source") == feed), f"{root}/{name}")
    sinks.overwrite(rows.where(F.lit(False)), f"{root}/checked_empty")
    names = [*feeds, "checked_empty", "checked_absent"]
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    done = sinks.register(spark, {name: f"{root}/{name}" for name in names})
    listed = {r["name"] for r in reports.table_list(spark).collect()}
    found = []
    for name in names:
        path = f"{root}/{name}"
        records = spark.sql(f"SELECT count(*) FROM {name}").first()[0] if done[name] else None
        found.append((name, tables.exists(spark, path), tables.read_if_present(spark, path) is not None, name in listed, records))
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame(found, "name string, present boolean, usable boolean, listed boolean, records long")


@query
def entity_attributes(spark, d):
    rows = obs.observations(spark, d).select("event_id", "city")
    return attach(rows, obs.attributes(spark, d), "city")


def _corrections(spark, d) -> tuple[DataFrame, DataFrame]:
    """A table and a later batch that corrects one condition and adds new rows."""
    columns = ["city", "recorded_dt", "temperature", "weather_condition", "ingested_at", "source"]
    rows = silver.unique(obs.observations(spark, d)).select(*columns)
    later = F.col("ingested_at") + F.expr("INTERVAL 1 DAY")
    batch = rows.filter(F.col("weather_condition").endswith("rain")).withColumns(
        {"temperature": F.col("temperature") + 1, "ingested_at": later}
    )
    moved = rows.filter(F.col("weather_condition") == "mist").withColumns(
        {"recorded_dt": F.col("recorded_dt") + 86_400 * 365, "ingested_at": later}
    )
    return rows, batch.unionByName(moved)


@query
def dedup_latest(spark, d):
    rows, batch = _corrections(spark, d)
    order = [*sinks.newest_first("ingested_at"), F.asc_nulls_last("source")]
    return keep_first(rows.unionByName(batch), silver.KEYS, order)


@query
def upsert_twice(spark, d):
    rows, batch = _corrections(spark, d)
    once = merge_rows(rows, batch, silver.KEYS)
    return merge_rows(once, batch, silver.KEYS)


def _merged(spark, d, label: str, frames: Callable) -> DataFrame:
    """Frames made of a table and its corrections, merged one after another."""
    rows, batch = (
        f.withColumn("recorded_date", F.to_date(F.timestamp_seconds("recorded_dt")))
        for f in _corrections(spark, d)
    )
    order = silver.newest_wins(rows.drop("recorded_date").columns)
    table = VersionedTable(spark, scratch_path(spark, label), silver.KEYS, "recorded_date", order)
    for frame in frames(rows, batch):
        table.merge(frame)
    return table.read().drop("recorded_date")


@query
def upsert_versioned(spark, d):
    return _merged(spark, d, "upsert", lambda rows, batch: (rows, batch, batch))


@query
def upsert_out_of_order(spark, d):
    """Corrections arrive first, then the rows they correct, with keys repeated, then one feed again."""
    return _merged(
        spark,
        d,
        "unordered",
        lambda rows, batch: (batch, rows.unionAll(batch), rows.where(F.col("source") == obs.STREAM)),
    )


# --- gold -------------------------------------------------------------------


@query
def daily_stats(spark, d):
    return gold.daily_stats(obs.cube(spark, d), obs.DIGITS)


@query
def daily_dominant(spark, d):
    return gold.daily_dominant(obs.cube(spark, d))


@query
def daily_rolling7(spark, d):
    daily = gold.daily_stats(obs.cube(spark, d), obs.DIGITS)
    return gold.rolling_week(daily, obs.MEAN_DIGITS).select(
        "city", "country", "recorded_date", "rolling_avg_temp", "temp_volatility"
    )


@query
def daily_fact(spark, d):
    return obs.daily(spark, d)


@query
def monthly_fact(spark, d):
    return gold.monthly_fact(obs.cube(spark, d), obs.DIGITS)


@query
def city_summary(spark, d):
    return gold.city_summary(obs.stored_cube(spark, d), obs.DIGITS)


@query
def dim_entity(spark, d):
    return gold.dim_city(obs.cube(spark, d))


@query
def dim_date(spark, d):
    return gold.dim_date(obs.cube(spark, d))


@query
def dense_order_key(spark, d):
    orders = obs.table(spark, d, "orders").select("o_orderkey").distinct()
    return dense_key(orders, "o_orderkey", "order_id")


@query
def distinct_estimates(spark, d):
    """Cities per month and condition: day sketches rolled up, next to the exact count."""
    rows = obs.silver_plain(spark, d)
    days = materialise(gold.day_reach(rows), "reach")
    exact = rows.groupBy(month_key("recorded_date").alias("year_month"), "weather_condition").agg(
        F.count_distinct("city").alias("exact_cities")
    )
    both = attach(exact, gold.monthly_reach(days), ["year_month", "weather_condition"])
    near = F.abs(F.col("cities") - F.col("exact_cities")) <= F.col("exact_cities") * 0.05
    return both.select("year_month", "weather_condition", "measurements", "exact_cities", near.alias("within_5_percent"))


@query
def clustered_rewrite(spark, d):
    path = scratch_path(spark, "clustered")
    sinks.cluster(obs.daily(spark, d), path, ["city_id", "date_id"])
    return spark.read.parquet(path).select("city_id", "date_id", "city", "measurement_count")


@query
def partitioned_overwrite(spark, d):
    path = scratch_path(spark, "partitioned")
    daily = obs.daily(spark, d).select("city", "recorded_date", "measurement_count", "year", "month")
    sinks.overwrite_partitions(daily, path, ["year", "month"])
    return spark.read.parquet(path)


ATTRIBUTE_FILES = ("temperature", "humidity", "pressure")


def _wide(rows: DataFrame, attribute: str) -> DataFrame:
    """Readings as a wide file: one row a day, one column a condition."""
    days = rows.withColumn("datetime", F.date_trunc("day", "recorded_at").cast("string"))
    return (
        days.groupBy("datetime")
        .pivot("weather_condition", list(obs.CONDITIONS.values()))
        .agg(F.max(attribute))
    )


def _from_bronze(rows: DataFrame) -> DataFrame:
    return silver.map_batch(rows).select(
        "city", "temperature", "humidity", "pressure", "recorded_at", "recorded_dt"
    )


@query
def bronze_files(spark, d):
    """Wide files written from the events, read back, aligned and mapped to the silver schema."""
    rows, root, frames = obs.observations(spark, d), scratch_path(spark, "landing"), {}
    for attribute in ATTRIBUTE_FILES:
        _wide(rows, attribute).write.option("header", True).csv(f"{root}/{attribute}.csv")
        frames[attribute] = files.read_attribute(
            spark, f"{root}/{attribute}.csv", attribute, T.DoubleType()
        )
    return _from_bronze(bronze.batch_bronze(frames, None))


@query
def bronze_incremental(spark, d):
    """The same files in two deliveries with a stray one. Every run is repeated, and the second
    delivery is first taken in by a run that dies before it reaches the manifest."""
    rows, lake = obs.observations(spark, d), LakeConfig(scratch_path(spark, "deliveries"))
    early = F.col("recorded_at") < F.lit(LATE_DAY).cast("timestamp")

    def land(part: DataFrame, delivery: str) -> None:
        for attribute in ATTRIBUTE_FILES:
            wide = _wide(part, attribute).coalesce(1).write.option("header", True)
            wide.csv(f"{lake.landing}/{delivery}/{attribute}.csv")

    land(rows.where(early), "first")
    bronze.run_batch(spark, lake)
    bronze.run_batch(spark, lake)
    land(rows.where(~early), "second")
    rows.limit(1).select("event_id").write.option("header", True).csv(f"{lake.landing}/second/notes.csv")
    claimed = files.next_batch(spark, lake.landing, lake.manifest, lake.claims)
    bronze.ingest(spark, lake, claimed)
    bronze.run_batch(spark, lake)
    bronze.run_batch(spark, lake)
    return _from_bronze(spark.read.parquet(lake.table("bronze_weather_batch")))


# --- features ---------------------------------------------------------------


@query
def hourly_bucket(spark, d):
    streamed = obs.silver_plain(spark, d).filter(F.col("source") == obs.STREAM)
    return aggregates.hourly_bucket(
        streamed, ["city"], "recorded_at", features.MEASURES, "weather_condition", obs.SERIES_DIGITS
    )


@query
def hourly_series(spark, d):
    return obs.hourly(spark, d)


@query
def hourly_features(spark, d):
    return features.hourly_features(
        obs.hourly(spark, d), digits=obs.SERIES_DIGITS, hot=obs.hot(spark, d)
    )


@query
def fine_grain_lags(spark, d):
    return features.hourly_features(
        obs.hourly(spark, d), digits=obs.SERIES_DIGITS, rows_per_hour=12, hot=obs.hot(spark, d)
    ).select("city", "recorded_at", "temp", "temp_lag_1h", "temp_lag_3h", "temp_24h_ma", "temp_168h_ma")


# Rows per block: few enough that the conditions are split at every scale.
BLOCK_ROWS = 100


@query
def split_series_lags(spark, d):
    """A few very long series: each is cut into blocks and must read like one."""
    rows = obs.observations(spark, d).select(
        "weather_condition", "recorded_at", "event_id", "temperature"
    )

    def columns(window):
        frame = window.rowsBetween(-24, 0)
        return [{
            "previous": F.lag("temperature", 1).over(window),
            "next": F.lead("temperature", 2).over(window),
            "frame_rows": F.count(F.lit(1)).over(frame),
            "frame_max": F.max("temperature").over(frame),
        }]

    return over_series(
        rows,
        ["weather_condition"],
        ["recorded_at", "event_id"],
        columns,
        back=24,
        ahead=2,
        rows_per_task=BLOCK_ROWS,
    )


@query
def daily_features(spark, d):
    return features.daily_features(obs.daily_named(spark, d), digits=obs.MEAN_DIGITS)


@query
def training_frame(spark, d):
    return obs.training(spark, d)


def _after_late_day(spark, d, name: str) -> DataFrame:
    """Features of all days but one, then brought up to date when that day arrives. The
    training rows need the hourly ones beside them, which count the series; not the reverse."""
    late = F.col("recorded_date") == F.lit(LATE_DAY).cast("date")
    source = VersionedTable(spark, scratch_path(spark, "source"), silver.KEYS, "recorded_date")
    hourly, training = (
        VersionedTable(spark, scratch_path(spark, label), ["city", "recorded_at"], "recorded_date")
        for label in ("hourly", "training")
    )
    hot, week = obs.hot(spark, d), features.WEEK_FRAME
    build = {"digits": obs.SERIES_DIGITS, "hot": hot}
    derived = [features.Derived(hourly, lambda r: features.hourly_features(r, **build), week)]
    if name == "training":
        derived.append(features.Derived(training, lambda r: features.training_frame(r, **build), week, 24))

    def series(part: DataFrame) -> DataFrame:
        return features.hourly_series(part, digits=obs.SERIES_DIGITS, batch=obs.BATCH, stream=obs.STREAM)

    for days in (~late, late):
        source.merge(obs.silver_plain(spark, d, days))
        features.refresh(source, series, derived, hourly)
    return derived[-1].table.read()


@query
def features_after_late_day(spark, d):
    return _after_late_day(spark, d, "hourly")


@query
def training_after_late_day(spark, d):
    return _after_late_day(spark, d, "training")


def _gaps(spark, d) -> DataFrame:
    rows = obs.observations(spark, d)
    valid = F.when(F.col("temperature").between(*TEMPERATURE_RANGE), F.col("temperature"))
    return rows.select(
        "event_id", "city", "weather_condition", "recorded_at", valid.alias("temperature")
    )


@query
def forward_fill_query(spark, d):
    return forward_fill(_gaps(spark, d), ["city"], ["recorded_at"], ["temperature"])


@query
def forward_fill_split(spark, d):
    """Filling very long series block by block."""
    return forward_fill(
        _gaps(spark, d),
        ["weather_condition"],
        ["recorded_at", "event_id"],
        ["temperature"],
        rows_per_task=BLOCK_ROWS,
    )


# --- quality ----------------------------------------------------------------


def _rules():
    return [
        *quality.null_rules(["city", "temperature"]),
        quality.Rule("temperature out of range", violates_range("temperature", *TEMPERATURE_RANGE)),
        quality.Rule("humidity out of range", violates_range("humidity", *HUMIDITY_RANGE)),
    ]


@query
def quality_rules(spark, d):
    return quality.check(obs.observations(spark, d), _rules())


@query
def quality_bronze(spark, d):
    return validation.bronze_report(obs.observations(spark, d), "city", "recorded_dt")


@query
def layer_summary(spark, d):
    """Rows, null keys, cities, freshness and missing columns per layer; one layer is absent."""
    rows = obs.observations(spark, d)
    layers = {
        "bronze_batch": rows.where(F.col("source") == obs.BATCH),
        "bronze_streaming": rows.where(F.col("source") == obs.STREAM).drop("pressure"),
        "silver": obs.silver_plain(spark, d),
        "gold": None,
    }
    return validation.summary(layers, required=["city", "recorded_at", "pressure", "temperature"])


@query
def quality_silver(spark, d):
    return validation.silver_report(obs.silver_plain(spark, d))


@query
def quality_gold(spark, d):
    return validation.daily_report(gold.daily_stats(obs.cube(spark, d), obs.DIGITS))


@query
def quality_requests(spark, d):
    return quality.check(_requests(spark, d), scoring.request_rules())


@query
def reconcile(spark, d):
    daily = gold.daily_stats(obs.cube(spark, d), obs.DIGITS)
    return quality.reconcile(daily, "measurement_count", obs.silver_plain(spark, d))


# --- reports ----------------------------------------------------------------


@query
def newest_daily(spark, d):
    return reports.newest_daily(obs.daily_named(spark, d))


@query
def newest_months(spark, d):
    return reports.newest_months(gold.monthly_fact(obs.cube(spark, d), obs.DIGITS))


@query
def trend_all(spark, d):
    return reports.trend(obs.daily_named(spark, d))


@query
def trend_since(spark, d):
    return reports.trend(obs.daily_named(spark, d), "2024-01-15")


@query
def seasonal_pattern(spark, d):
    return reports.seasonal(gold.monthly_fact(obs.cube(spark, d), obs.DIGITS))


@query
def star_year_month(spark, d):
    c = obs.stored_cube(spark, d)
    dates = gold.dim_date(c)
    daily = attach(gold.daily_stats(c, obs.DIGITS), dates, "recorded_date", ["date_id"])
    return reports.by_year_month(daily, dates, digits=obs.MEAN_DIGITS)


@query
def table_profile(spark, d):
    return reports.batch_profile(obs.observations(spark, d), "recorded_at")


@query
def rows_per_day(spark, d):
    return reports.messages_per_day(obs.observations(spark, d))


@query
def newest_rows(spark, d):
    return reports.newest_rows(obs.silver_plain(spark, d))


@query
def layer_counts(spark, d):
    rows = obs.observations(spark, d)
    return reports.layer_counts(
        rows.filter(F.col("source") == obs.BATCH),
        rows.filter(F.col("source") == obs.STREAM),
        obs.silver_plain(spark, d),
    )


@query
def source_coverage(spark, d):
    return reports.source_coverage(obs.silver_plain(spark, d))


@query
def year_average(spark, d):
    monthly = gold.monthly_fact(obs.cube(spark, d), obs.DIGITS)
    return reports.year_average(monthly, "2024", obs.MEAN_DIGITS)


@query
def silver_row_count(spark, d):
    return reports.row_count(obs.silver_plain(spark, d))


@query
def dimension_dump(spark, d):
    return reports.dump(gold.dim_date(obs.cube(spark, d)), "date_id")


def _latest_features(spark, d) -> DataFrame:
    """The newest feature row of every entity, from as much history as its frames reach."""
    history = online.recent(obs.hourly(spark, d))
    hourly = features.hourly_features(history, digits=obs.SERIES_DIGITS, hot=None)
    return online.latest_features(hourly)


@query
def latest_online_row(spark, d):
    # Means as whole units: the text of a fraction differs between engines.
    means = ["temp_24h_ma", "temp_168h_ma", "humid_24h_ma", "temp_24h_std"]
    latest = _latest_features(spark, d).withColumns({m: F.round(F.col(m) * 10_000).cast("long") for m in means})
    return online.online_rows_of(latest)


# --- models -----------------------------------------------------------------


@query
def category_codes(spark, d):
    rows = obs.observations(spark, d).withColumn(
        "weather_condition",
        F.when(F.col("weather_condition") != "mist", F.col("weather_condition")),
    )
    coded = prepare.encode(rows, prepare.fit_encoder(rows))
    return coded.groupBy("weather_condition", F.col("condition_encoded").cast("int").alias("code")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def hash_split_counts(spark, d):
    rows = obs.observations(spark, d).withColumn("training", prepare.in_training(["event_id"]))
    return rows.groupBy("weather_condition", "training").agg(F.count(F.lit(1)).alias("n"))


@query
def scaled_features(spark, d):
    rows = obs.silver_plain(spark, d)
    digits = {"temperature": 2, "humidity": 0, "pressure": 0, "wind_speed": 2}
    scaling = prepare.fit_scaling(rows, list(digits), digits)
    return rows.select("event_id", *[F.round(scaling.column(c), 6).alias(f"scaled_{c}") for c in digits])


def _two_forecasts(spark, d) -> DataFrame:
    frame = obs.training(spark, d)
    rule = scoring.fallback(frame).withColumn("prediction", F.col("predicted_temperature_24h"))
    same = frame.withColumn("prediction", F.col("temperature"))
    columns = ["prediction", "label_24h"]
    return tag(rule.select(*columns), "rule", "algorithm").unionByName(
        tag(same.select(*columns), "persistence", "algorithm")
    )


@query
def eval_metrics(spark, d):
    return training.metrics(_two_forecasts(spark, d), "label_24h", digits=2, by=["algorithm"])


@query
def best_model(spark, d):
    compared = training.metrics(_two_forecasts(spark, d), "label_24h", digits=2, by=["algorithm"])
    return compared.agg(F.max_by("algorithm", "r2").alias("algorithm"), F.max("r2").alias("r2"))


@query
def ridge_fit(spark, d):
    """One-feature ridge: the closed form is the oracle."""
    frame = materialise(obs.training(spark, d).select("temperature", "label_24h"), "ridge")
    vectors = VectorAssembler(inputCols=["temperature"], outputCol="features").transform(frame)
    model = training.ridge(vectors)
    return vectors.agg(F.count(F.lit(1)).alias("n")).select(
        "n",
        F.round(F.lit(float(model.coefficients[0])), 6).alias("coefficient"),
        F.round(F.lit(float(model.intercept)), 6).alias("intercept"),
    )


@query
def tree_scores(spark, d):
    """Forest and boosting as trees of depth one, next to the exact best split."""
    frame = materialise(obs.training(spark, d).select("hour", "label_24h"), "stumps")
    vectors = VectorAssembler(inputCols=["hour"], outputCol="features").transform(frame)
    models = {
        "RandomForest": training.forest(vectors, numTrees=1, maxDepth=1, bootstrap=False),
        "GradientBoosting": training.boosting(vectors, maxIter=1, maxDepth=1),
    }
    error = F.abs(F.col("prediction") - F.col("label_24h"))
    found = []
    for name, model in models.items():
        sides = model.transform(vectors).groupBy("prediction").agg(
            F.max("hour").alias("upto"), F.count(F.lit(1)).alias("rows"), F.sum(error).alias("error")
        )
        first, last = F.min("upto"), F.max("upto")
        found.append(
            sides.agg(
                first.alias("cut"),
                F.min_by("rows", "upto").alias("rows_left"),
                F.max_by("rows", "upto").alias("rows_right"),
                F.min_by("prediction", "upto").alias("mean_left"),
                F.max_by("prediction", "upto").alias("mean_right"),
                (F.sum("error") / F.sum("rows")).alias("mae"),
            ).withColumn("algorithm", F.lit(name))
        )
    exact = splits.best_split(frame, "hour", "label_24h")
    row = exact.first()
    side = F.when(F.col("hour") <= row["cut"], F.lit(row["mean_left"])).otherwise(F.lit(row["mean_right"]))
    mae = frame.agg(F.avg(F.abs(side - F.col("label_24h")))).first()[0]
    found.append(exact.withColumns({"mae": F.lit(mae), "algorithm": F.lit("exact")}))
    rounded = ("mean_left", "mean_right", "mae")
    return union_sources(found).withColumns({c: F.round(c, 6) for c in rounded})


@query
def regressor_scores(spark, d):
    """All three regressors on the training frame, compared on held-out rows."""
    frame = materialise(obs.training(spark, d), "training")
    encoder = prepare.fit_encoder(prepare.usable(frame))
    ready = materialise(prepare.engineer(frame, encoder, features.ORDER), "ready")
    keys = ["city", "recorded_at"]
    results = training.train_all(ready, prepare.input_columns(ready), keys)
    held_out = ready.filter(~prepare.in_training(keys))
    scored = [
        tag(r.model.transform(held_out).select("prediction", "label_24h"), r.algorithm, "algorithm")
        for r in results
    ]
    return training.metrics(union_sources(scored), "label_24h", by=["algorithm"])


@query
def model_versions(spark, d):
    """Three versions registered with their measured errors; the first is promoted, then the best."""
    compared = training.metrics(_two_forecasts(spark, d), "label_24h", digits=2, by=["algorithm"])
    measured = {r["algorithm"]: r for r in compared.collect()}  # one row per algorithm
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    numbers = {}
    for name in ("rule", "persistence", "rule"):
        row = measured[name]
        numbers[name] = registry.register(name, {m: row[m] for m in ("mae", "rmse", "r2")}, f"models/{name}")
    registry.promote(1)
    registry.transition(numbers["rule"], "Staging")
    registry.promote(numbers["persistence"])
    newest = registry.latest().select("version", F.lit(True).alias("newest_in_stage"))
    return attach(registry.versions().drop("created_at"), newest, "version").fillna(False, ["newest_in_stage"])


@query
def forecast_requests(spark, d):
    """A one-feature ridge saved with its encoder, promoted, loaded and applied to requests."""
    lake = LakeConfig(scratch_path(spark, "models"))
    frame = materialise(obs.training(spark, d).select("temperature", "weather_condition", "label_24h"), "ridge")
    vector = VectorAssembler(inputCols=["temperature"], outputCol="features")
    fitted = PipelineModel([vector, training.ridge(vector.transform(frame))])
    path = f"{lake.models}/1"
    training.save(training.with_category(prepare.fit_encoder(frame), fitted), f"{path}/forecaster")
    registry = ModelRegistry(spark, lake.registry)
    registry.promote(registry.register("Ridge", {"mae": 0.0, "rmse": 0.0, "r2": 0.0}, path))

    # Requests of one feed name an hour that does not exist; misty ones bring their own code.
    rows = attach(
        _requests(spark, d), obs.silver_plain(spark, d).select("event_id", "source", "weather_condition"), "event_id"
    )
    rows = rows.withColumns(
        {
            "hour": F.when((F.col("source") == obs.STREAM) & (F.col("hour") > 21), F.lit(24)).otherwise(F.col("hour")),
            "condition_encoded": F.when(F.col("weather_condition") == "mist", F.lit(9)),
        }
    ).drop("source", "weather_condition")
    forecasts, rejected = plans_training.forecast(spark, lake, rows, _latest_features(spark, d))
    made = forecasts.select(
        "event_id",
        "predicted_temperature_24h",
        "confidence_lower",
        "confidence_upper",
        F.col("condition_encoded").cast("int").alias("condition_encoded"),
        "model_version",
        F.lit(None).cast("string").alias("rejected_by"),
    )
    refused = rejected.select("event_id", F.array_join("rejected_by", "; ").alias("rejected_by"))
    return made.unionByName(refused, allowMissingColumns=True)


def _requests(spark, d) -> DataFrame:
    """Every clean reading as a request; only misty ones know their last hour."""
    rows = obs.silver_plain(spark, d)
    misty = F.col("weather_condition") == "mist"
    return rows.select(
        "event_id",
        "city",
        "temperature",
        F.col("humidity").cast("double").alias("humidity"),
        "pressure",
        "wind_speed",
        F.hour("recorded_at").alias("hour"),
        F.dayofweek("recorded_at").alias("day_of_week"),
        F.month("recorded_at").alias("month"),
        F.when(misty, F.col("temperature") + 1).alias("temp_lag_1h"),
    )


@query
def request_defaults(spark, d):
    return scoring.with_defaults(_requests(spark, d), _latest_features(spark, d))


@query
def fallback_forecast(spark, d):
    return scoring.fallback(_requests(spark, d)).select(
        "event_id", "predicted_temperature_24h", "confidence_lower", "confidence_upper", "model_version"
    )


@query
def confidence_band(spark, d):
    line = F.col("temperature") * F.lit(0.8731547) + F.lit(1.5)
    scored = _requests(spark, d).withColumn("prediction", line)
    return scoring.with_band(scored).select(
        "event_id", "predicted_temperature_24h", "confidence_lower", "confidence_upper"
    )


@query
def row_standardise(spark, d):
    columns = ["temperature", "humidity", "pressure", "wind_speed", "hour", "day_of_week", "month"]
    scaled = scoring.row_scaled(_requests(spark, d), columns)
    return scaled.select("event_id", *[F.round(f"scaled_{c}", 6).alias(f"scaled_{c}") for c in columns])


# --- streams ----------------------------------------------------------------


def _message_folder(spark, d, folder: str | None = None, part: Column | None = None) -> str:
    """The events as JSON messages, with a malformed one next to each of them."""
    rows = obs.observations(spark, d)
    if part is not None:
        rows = rows.where(part)
    none = F.lit(None)
    message = F.struct(
        F.struct(none.cast("double").alias("lon"), none.cast("double").alias("lat")).alias("coord"),
        F.array(F.struct(F.col("weather_condition").alias("main"))).alias("weather"),
        F.struct(
            F.col("temperature").alias("temp"), F.col("humidity"), F.col("pressure").cast("int").alias("pressure")
        ).alias("main"),
        F.struct(F.col("wind_speed").alias("speed")).alias("wind"),
        F.col("recorded_dt").alias("dt"),
        F.struct(F.col("source").alias("country")).alias("sys"),
        F.col("city").cast("string").alias("name"),
    )
    text = F.to_json(message)
    cut = F.substring(text, 1, 20)
    folder = folder or scratch_path(spark, "messages")
    rows.select(F.explode(F.array(text, cut)).alias("value")).write.mode("append").text(folder)
    return folder


@query
def stream_parse(spark, d):
    target, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-ck")
    parsed = ingest.parse_messages(read_folder(spark, _message_folder(spark, d)))
    ingest.append_stream(parsed, target, checkpoint, available_now=True).awaitTermination()
    return silver.map_stream(spark.read.parquet(target)).select(
        "city", "country", "temperature", "humidity", "pressure", "wind_speed",
        "weather_condition", "recorded_at", "recorded_dt",
    )


@query
def stream_restart(spark, d):
    """Two landings, and a run after each and once more: the checkpoint loses and repeats nothing."""
    folder, target, checkpoint = (scratch_path(spark, f"restart-{x}") for x in ("in", "out", "ck"))
    early = F.col("recorded_at") < F.lit(LATE_DAY).cast("timestamp")
    for part in (early, ~early, F.lit(False)):
        _message_folder(spark, d, folder, part)
        parsed = ingest.parse_messages(read_folder(spark, folder))
        ingest.append_stream(parsed, target, checkpoint, available_now=True).awaitTermination()
    stored = spark.read.parquet(target)
    # Source time and ingest time of every message, in this order.
    stamped = (F.col("kafka_timestamp") <= F.col("ingested_at")).alias("stamped")
    return stored.select(
        F.col("name").alias("city"), F.col("dt").alias("recorded_dt"), F.col("main.temp").alias("temperature"), stamped
    )


def _stream_silver(batch: DataFrame) -> DataFrame:
    return silver.unique(silver.clean(silver.map_stream(batch)))


@query
def stream_silver(spark, d):
    """Micro-batches cleaned and upserted into a keyed table."""
    table = VersionedTable(spark, scratch_path(spark, "silver"), silver.KEYS, "recorded_date")
    parsed = ingest.parse_messages(read_folder(spark, _message_folder(spark, d)))
    ingest.upsert_stream(
        parsed, table, scratch_path(spark, "silver-ck"), _stream_silver, available_now=True
    ).awaitTermination()
    return table.read().select("city", "recorded_dt", "recorded_date", "temperature", "humidity")


@query
def stream_hourly(spark, d):
    """Hourly roll-up in update mode; changed windows are upserted by key."""
    parsed = ingest.parse_messages(read_folder(spark, _message_folder(spark, d)))
    rows = silver.clean(silver.map_stream(parsed))
    hourly = ingest.hourly_stream(
        rows,
        ["city"],
        "recorded_at",
        [F.count(F.lit(1)).alias("readings"), F.max("temperature").alias("max_temperature"),
         F.sum("humidity").alias("sum_humidity")],
    ).withColumn("recorded_date", F.to_date("recorded_at"))
    table = VersionedTable(
        spark, scratch_path(spark, "hourly"), ["city", "recorded_at"], "recorded_date"
    )
    ingest.upsert_stream(
        hourly, table, scratch_path(spark, "hourly-ck"), mode="update", available_now=True
    ).awaitTermination()
    return table.read().drop("recorded_date")


@query
def newest_messages(spark, d):
    messages = spark.read.text(_message_folder(spark, d)).select(
        "value", F.lit(0).cast("timestamp").alias("timestamp")
    )
    parsed = ingest.parse_messages(messages).filter(F.col("name").isNotNull())
    return reports.newest_messages(parsed.withColumn("ingested_at", F.timestamp_seconds("dt")))


@query
def stream_profile(spark, d):
    messages = spark.read.text(_message_folder(spark, d)).select(
        "value", F.lit(0).cast("timestamp").alias("timestamp")
    )
    parsed = ingest.parse_messages(messages).filter(F.col("name").isNotNull())
    return reports.stream_profile(parsed.withColumn("ingested_at", F.timestamp_seconds("dt")))


# Landings of the deduplicated stream, and how long a repeat is recognised.
LANDINGS = ("2024-01-11", "2024-01-21")
DEDUP_DELAY = "3 days"


def _landings(spark, d) -> list[DataFrame]:
    """Three landings of readings: each in time order, with repeats of two kinds.

    The second also has readings of the first two days, sent again under new ids, when the
    watermark has passed them. The third repeats ids of the second landing's first two
    days, sent again now that their state has expired.
    """
    rows = obs.observations(spark, d).select("event_id", F.col("recorded_at").alias("sent_at"), "temperature")
    first, second = (F.col("sent_at") < F.lit(day).cast("timestamp") for day in LANDINGS)
    one, two, three = rows.where(first), rows.where(~first & second), rows.where(~second)
    day = lambda a, b: F.col("sent_at").between(F.lit(a).cast("timestamp"), F.lit(b).cast("timestamp"))
    repeats = one.where(day("2024-01-09 12:00:00", "2024-01-10 23:59:59"))
    late = one.where(day("2024-01-01", "2024-01-02 23:59:59")).withColumn("event_id", -F.col("event_id") - 1)
    expired = two.where(day("2024-01-11", "2024-01-12 23:59:59")).withColumn(
        "sent_at", F.col("sent_at") + F.expr("INTERVAL 14 DAYS")
    )
    return [one.unionAll(one), two.unionAll(repeats).unionAll(late), three.unionAll(expired)]


@query
def stream_dedup(spark, d):
    """Repeats are dropped while the watermark keeps their key; the state stays bounded.

    Repeats within a landing and of its predecessor's last days go; a reading older than
    the watermark is lost, new or not; an id that comes back after its state expired counts
    as new.
    """
    folder, target, checkpoint = (scratch_path(spark, f"dedup-{x}") for x in ("in", "out", "ck"))
    for landing in _landings(spark, d):
        landing.write.mode("append").parquet(folder)
        rows = spark.readStream.schema(landing.schema).parquet(folder)
        unique = ingest.drop_repeats(rows, ["event_id"], "sent_at", DEDUP_DELAY)
        ingest.append_stream(unique, target, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(target)
