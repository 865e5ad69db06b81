"""Feature sets: hourly, daily and training frames."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.config import ROWS_PER_TASK, LakeConfig, materialise, scratch
from tidemark.functions import fixed_point
from tidemark.operators.aggregates import hourly_bucket
from tidemark.operators.filters import only
from tidemark.operators.joins import attach
from tidemark.operators.series import Hot, hot_entities, over_series
from tidemark.operators.upsert import VersionedTable
from tidemark.schemas import BATCH_SOURCE, STREAM_SOURCE

MEASURES = ("temperature", "humidity", "pressure", "wind_speed")

# Lags and trailing frames, in hours.
TEMPERATURE_LAGS = (1, 3, 6, 12, 24)
TRAINING_LAGS = (1, 3, 6, 24)
DAY_FRAME = 24
WEEK_FRAME = 168
LABEL_HOURS = (6, 12)


def hourly_series(
    silver: DataFrame,
    entity: str | None = None,
    digits: int | None = None,
    batch: str = BATCH_SOURCE,
    stream: str = STREAM_SOURCE,
) -> DataFrame:
    """Hourly rows: file rows as they are, stream rows averaged per hour."""
    rows = only(silver, "city", entity)
    columns = ["city", "recorded_at", *[F.col(m).cast("double") for m in MEASURES], "weather_condition"]
    from_files = rows.filter(F.col("source") == batch).select(*columns)
    from_stream = hourly_bucket(
        rows.filter(F.col("source") == stream), ["city"], "recorded_at", MEASURES,
        "weather_condition", digits,
    )
    return from_files.unionByName(from_stream.select(*columns)).withColumn(
        "recorded_date", F.to_date("recorded_at")
    )


# A file row and a stream bucket may share one hour; their values decide the order.
ORDER = ["recorded_at", "temperature", "humidity", "pressure"]


def _running(digits: int | None, window: WindowSpec) -> dict[str, Column]:
    return fixed_point.running("temperature", digits, window, squares=True) | fixed_point.running(
        "humidity", digits, window
    )


def _trailing(digits: int | None, day: int, week: int, window: WindowSpec):
    """Trailing statistics: name, value, and the column standing in for a missing value."""
    return (
        ("temp_24h_ma", fixed_point.trailing_mean("temperature", digits, day, window), "temperature"),
        ("temp_168h_ma", fixed_point.trailing_mean("temperature", digits, week, window), "temperature"),
        ("humid_24h_ma", fixed_point.trailing_mean("humidity", digits, day, window), "humidity"),
        ("temp_24h_std", fixed_point.trailing_stddev("temperature", digits, day, window), None),
    )


def hourly_features(
    hourly: DataFrame,
    digits: int | None = None,
    rows_per_hour: int = 1,
    rows_per_task: int = ROWS_PER_TASK,
    hot: Hot = "count",
) -> DataFrame:
    """Lags (falling back to the current value) and trailing statistics.

    ``rows_per_hour`` scales every offset for a finer grain: 12 for rows five
    minutes apart.
    """
    day, week = DAY_FRAME * rows_per_hour, WEEK_FRAME * rows_per_hour

    def lag(name: str, hours: int, window: WindowSpec) -> Column:
        return F.coalesce(F.lag(name, hours * rows_per_hour).over(window), F.col(name))

    def columns(window: WindowSpec) -> list[Mapping[str, Column]]:
        return [
            _running(digits, window),
            {
                **{f"temp_lag_{h}h": lag("temperature", h, window) for h in TEMPERATURE_LAGS},
                "humid_lag_1h": lag("humidity", 1, window),
                "pres_lag_1h": lag("pressure", 1, window),
            }
            | {
                name: F.coalesce(value, F.col(instead) if instead else F.lit(0.0))
                for name, value, instead in _trailing(digits, day, week, window)
            },
        ]

    rows = hourly.filter(F.col("recorded_at").isNotNull())
    featured = over_series(
        rows, ["city"], ORDER, columns, back=week + 1, rows_per_task=rows_per_task, hot=hot
    )
    return featured.select(
        "city",
        "recorded_at",
        "recorded_date",
        F.col("temperature").alias("temp"),
        F.col("humidity").alias("humid"),
        F.col("pressure").alias("pres"),
        F.col("wind_speed").alias("wind"),
        F.col("weather_condition").alias("condition"),
        F.hour("recorded_at").alias("hour"),
        F.dayofweek("recorded_at").alias("day_of_week"),
        F.month("recorded_at").alias("month"),
        F.weekofyear("recorded_at").alias("week_of_year"),
        *[f"temp_lag_{h}h" for h in TEMPERATURE_LAGS],
        "humid_lag_1h",
        "pres_lag_1h",
        "temp_24h_ma",
        "temp_168h_ma",
        "humid_24h_ma",
        "temp_24h_std",
    )


def daily_features(daily: DataFrame, entity: str | None = None, digits: int | None = None) -> DataFrame:
    """Day lags and trailing statistics. A city has one row per day and country, so a
    series is bounded by the calendar and stays in one window task."""
    series = Window.partitionBy("city").orderBy("recorded_date", F.asc_nulls_last("country"))
    week, month = series.rowsBetween(-7, 0), series.rowsBetween(-30, 0)
    rows = only(daily, "city", entity).filter(F.col("recorded_date").isNotNull())
    return rows.select(
        "city",
        "recorded_date",
        F.col("avg_temperature").alias("avg_temp"),
        F.col("min_temperature").alias("min_temp"),
        F.col("max_temperature").alias("max_temp"),
        F.col("avg_humidity").alias("avg_humid"),
        F.col("avg_pressure").alias("avg_pres"),
        F.col("avg_wind_speed").alias("avg_wind"),
        F.col("dominant_weather_condition").alias("condition"),
        "measurement_count",
        F.lag("avg_temperature", 1).over(series).alias("prev_day_temp"),
        F.lag("avg_temperature", 7).over(series).alias("prev_week_temp"),
        F.lag("avg_temperature", 14).over(series).alias("prev_2week_temp"),
        fixed_point.mean("avg_temperature", digits, week).alias("temp_7d_ma"),
        fixed_point.sample_stddev("avg_temperature", digits, week).alias("temp_7d_std"),
        fixed_point.mean("avg_temperature", digits, month).alias("temp_30d_ma"),
        F.count(F.lit(1)).over(month).alias("days_30d_count"),
    )


def training_frame(
    hourly: DataFrame,
    horizon: int = 24,
    digits: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    hot: Hot = "count",
) -> DataFrame:
    """Labels ahead of each row, then lags and trailing statistics without fallback.

    Rows without the main label are dropped before the lags are taken.
    """

    def labels(window: WindowSpec) -> list[Mapping[str, Column]]:
        main = {"label_24h": F.lead("temperature", horizon).over(window)}
        return [main | {f"label_{h}h": F.lead("temperature", h).over(window) for h in LABEL_HOURS}]

    def columns(window: WindowSpec) -> list[Mapping[str, Column]]:
        return [
            _running(digits, window),
            {
                **{f"temp_lag_{h}h": F.lag("temperature", h).over(window) for h in TRAINING_LAGS},
                "humid_lag_1h": F.lag("humidity", 1).over(window),
            }
            | {n: value for n, value, _ in _trailing(digits, DAY_FRAME, WEEK_FRAME, window)},
        ]

    if isinstance(hot, str):
        hot = hot_entities(hourly, ["city"], rows_per_task)
    split = {"rows_per_task": rows_per_task, "hot": hot}
    ahead = max(horizon, *LABEL_HOURS)
    labelled = over_series(hourly, ["city"], ORDER, labels, back=0, ahead=ahead, **split)
    labelled = labelled.filter(F.col("label_24h").isNotNull())
    featured = over_series(labelled, ["city"], ORDER, columns, back=WEEK_FRAME + 1, **split)
    return featured.select(
        "city",
        "recorded_at",
        "recorded_date",
        *MEASURES,
        "weather_condition",
        F.hour("recorded_at").alias("hour"),
        F.dayofweek("recorded_at").alias("day_of_week"),
        F.month("recorded_at").alias("month"),
        *[f"temp_lag_{h}h" for h in TRAINING_LAGS],
        "humid_lag_1h",
        "temp_24h_ma",
        "temp_168h_ma",
        "humid_24h_ma",
        "temp_24h_std",
        "label_24h",
        "label_6h",
        "label_12h",
    )


def spans(counts: DataFrame, back: int, ahead: int, entity: str = "city", day: str = "recorded_date") -> DataFrame:
    """Which days of a series to compute again, and which rows that takes.

    ``counts`` has one row per entity and day: ``n`` rows, and whether they ``changed``. A row
    depends on ``back`` rows before it and ``ahead`` rows after it. Returns the days that are
    ``affected``, and all that are ``needed`` because an affected row may reach them. The
    days of an entity are bounded by the calendar.
    """
    in_order = Window.partitionBy(entity).orderBy(day)
    until = in_order.rowsBetween(Window.unboundedPreceding, 0)
    onward = in_order.rowsBetween(0, Window.unboundedFollowing)

    def near(hit: str, before: int, after: int) -> Column:
        """Fewer rows than ``before`` lie between a hit and this day, or ``after`` on to the next."""
        earlier = F.col("first") - F.max(F.when(F.col(hit), F.col("end"))).over(until)
        later = F.min(F.when(F.col(hit), F.col("first"))).over(onward) - F.col("end")
        return F.coalesce(earlier < before, F.lit(False)) | F.coalesce(later < after, F.lit(False))

    placed = counts.withColumn("end", F.sum("n").over(until)).withColumn("first", F.col("end") - F.col("n"))
    return (
        placed.withColumn("affected", near("changed", back, ahead))
        # A running sum starts one row before its frame.
        .withColumn("needed", near("affected", ahead, back + 1))
        .where("needed")
        .select(entity, day, "affected")
    )


@dataclass(frozen=True)
class Derived:
    """A feature table kept up to date with the day partitions of another table.

    ``build`` makes its rows from series rows, each from at most ``back`` rows before and
    ``ahead`` rows after it in the series of its city.
    """

    table: VersionedTable
    build: Callable[[DataFrame], DataFrame]
    back: int
    ahead: int = 0


def refresh(
    source: VersionedTable,
    series: Callable[[DataFrame], DataFrame],
    derived: Sequence[Derived],
    counted: VersionedTable,
    settings: Mapping[str, int] | None = None,
) -> list[str]:
    """Bring feature tables to the newest version of ``source``; returns the days written.

    Only days that changed since the version a table was made from are computed again, with
    the days whose rows reach them; from ``source`` only the partitions of rows that those
    depend on are read. ``counted`` is the table among ``derived`` that has every row of the
    series, so that unchanged days need not be counted at their source. A run that dies
    between two tables is caught up by the next. Other ``settings`` than those stored mean
    that everything is built again.
    """
    version = source.version()
    notes = [d.table.notes() for d in derived]
    stored = dict(settings or {})
    full = any({k: v for k, v in n.items() if k != "made_from"} != stored for n in notes)
    seen = 0 if full else min(n.get("made_from", 0) for n in notes)
    changed = source.changed_since(seen)
    if not changed:
        return []
    keys = ["city", "recorded_date"]
    known = counted.read()
    if seen == 0 or known is None:
        rows, span = materialise(series(source.read()), "series"), None
        days = rewritten = _days(rows)
    else:
        fresh = series(source.read(changed)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        fresh = materialise(fresh.withColumn("changed", F.lit(True)), "fresh")
        old = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("changed", F.lit(False))
        old = old.join(fresh.select("recorded_date").distinct(), "recorded_date", "left_anti")
        back, ahead = max(d.back for d in derived), max(d.ahead for d in derived)
        span = materialise(spans(old.unionByName(fresh), back, ahead), "spans")
        days, rewritten = _days(span), _days(span.where("affected"))
        rows = series(source.read(_partitions(source, days)))
        rows = materialise(rows.join(span.select(*keys), keys, "left_semi"), "series")
    for d in derived:
        made = d.build(rows)
        if span is not None:
            again = span.where("affected").select(*keys)
            made = made.join(again, keys, "left_semi")
            kept = d.table.read(rewritten)
            if kept is not None:
                made = made.unionByName(kept.join(again, keys, "left_anti"))
        d.table.replace(made, rewritten, made_from=version, **stored)
    return rewritten


def _days(rows: DataFrame) -> list[str]:
    """Calendar days, as the partitions of a table are called."""
    return sorted(str(r[0]) for r in rows.select("recorded_date").distinct().collect())


def _partitions(source: VersionedTable, days: Sequence[str]) -> list[str]:
    if source.partition == "recorded_month":
        return sorted({day[:7] for day in days})
    return list(days)


def table(spark: SparkSession, lake: LakeConfig, name: str) -> VersionedTable:
    """A feature set of the lake; days are its partitions."""
    instant = "recorded_date" if name == "daily_weather" else "recorded_at"
    return VersionedTable(spark, lake.table(name), ["city", instant], "recorded_date")


def run(spark: SparkSession, lake: LakeConfig, silver: VersionedTable) -> list[str]:
    """Bring the three feature sets up to date; returns the days whose hours were written."""
    with scratch(spark):
        digits, long = lake.feature_digits, lake.rows_per_task
        hourly, training, daily = (
            table(spark, lake, n) for n in ("hourly_weather", "training_data", "daily_weather")
        )
        derived = [
            Derived(hourly, lambda rows: hourly_features(rows, digits, rows_per_task=long), WEEK_FRAME),
            Derived(training, lambda rows: training_frame(rows, lake.horizon, digits, long), WEEK_FRAME,
                    max(lake.horizon, *LABEL_HOURS)),
        ]
        settings = {"horizon": lake.horizon, "digits": -1 if digits is None else digits}
        days = refresh(silver, lambda rows: hourly_series(rows, lake.entity, digits), derived, hourly, settings)
        facts = spark.read.parquet(lake.table("fact_weather_daily_stats"))

        def of_days(rows: DataFrame) -> DataFrame:
            return attach(rows.select("city", "recorded_date").distinct(), facts, ["city", "recorded_date"])

        refresh(silver, of_days, [Derived(daily, lambda rows: daily_features(rows, lake.entity), 30)], daily)
        return days
