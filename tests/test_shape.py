import datetime
import os

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import scalar
from tidemark.operators import aggregates, filters, quality, shape, sinks

RELAXED = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@RELAXED
@given(
    names=st.lists(st.sampled_from(["a", "b c", "d'e", "f`g", "h.i"]), min_size=1, unique=True),
    values=st.lists(st.one_of(st.none(), st.integers(-9, 9)), min_size=10, max_size=10),
)
def test_pivot_undoes_unpivot(spark, names, values):
    rows = [(t, *[values[(t * 3 + i) % 10] for i in range(len(names))]) for t in range(4)]
    schema = T.StructType(
        [T.StructField("t", T.LongType())] + [T.StructField(n, T.LongType()) for n in names]
    )
    wide = spark.createDataFrame(rows, schema)
    long = shape.unpivot(wide, ["t"], "name", "value", T.LongType())
    assert long.count() == 4 * len(names)
    back = long.groupBy("t").pivot("name", names).agg(F.first("value", ignorenulls=True))
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows, key=lambda r: r[0])


def test_conform_casts_renames_and_fills(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType()),
                           T.StructField("c", T.StringType())])
    df = spark.createDataFrame([("7", "x"), ("no", "y")], "A string, other string")
    out = shape.conform(df, schema, {"c": "other"})
    assert [tuple(r) for r in out.collect()] == [(7, None, "x"), (None, None, "y")]
    assert out.schema.names == ["a", "b", "c"]


def test_union_fills_missing_columns(spark):
    a, b = spark.range(1).withColumn("x", F.lit(1)), spark.range(2).withColumn("y", F.lit("s"))
    out = shape.union_sources([a, b])
    assert out.count() == 3 and out.filter("x IS NULL").count() == 2


def test_calendar_counts_sunday_as_one(spark):
    day = spark.sql("SELECT DATE '2024-03-31' AS d")  # a Sunday
    row = shape.calendar(day, "d", ("year", "month", "day", "day_of_week", "week_of_year")).first()
    assert tuple(row)[1:] == (2024, 3, 31, 1, 13)


def test_scalars(spark):
    row = spark.sql("SELECT 'Light RAIN' AS t, CAST(NULL AS STRING) AS n, 'US' AS c, array() AS e").select(
        scalar.mentions("t", "rain").alias("rain"),
        scalar.mentions("n", "rain").alias("none"),
        scalar.normalise("c", {"US": "United States"}).alias("country"),
        scalar.normalise("t", {}).alias("same"),
        scalar.kelvin_to_celsius(F.lit(300.15)).alias("celsius"),
        scalar.epoch_seconds(F.lit("1969-12-31 23:59:59.5").cast("timestamp")).alias("floor"),
    ).first()
    assert row.rain is True and row.none is None and row.country == "United States"
    assert row.same == "Light RAIN" and row.celsius == pytest.approx(27.0) and row.floor == -1


def test_filters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5), (None, 9), ("a", None)], "k string, v int")
    assert filters.only(df, "k", None).count() == 4
    assert filters.only(df, "k", "a").count() == 2
    assert filters.only(df, "k", ["a", "b"]).count() == 3
    assert filters.require(df, ["k", "v"]).count() == 2
    assert df.filter(filters.within({"v": (1, 5)})).count() == 2


def test_rules_count_nulls_only_when_asked(spark):
    df = spark.createDataFrame([(1,), (None,), (99,)], "v int")
    rules = [
        quality.Rule("range", scalar.violates_range("v", 0, 10)),
        *quality.null_rules(["v"], "warn"),
    ]
    report = quality.check(df, rules)
    assert {(r.rule, r.violations, r.passed) for r in report.collect()} == {
        ("range", 1, False), ("v is null", 1, False)
    }
    with pytest.raises(quality.QualityError, match="range: 1"):
        quality.enforce(report)
    assert quality.enforce(quality.check(df.filter("v = 1 OR v IS NULL"), rules)) == ["v is null"]
    assert quality.enforce(quality.check(df.limit(0), rules)) == []


def test_accounting_during_the_write(spark, tmp_path):
    df = spark.range(10)
    kept, seen = quality.observe_filter(df, F.col("id") > 6)
    kept.write.parquet(str(tmp_path / "t"))
    assert quality.filter_counts(seen) == {"rows_in": 10, "rows_kept": 3, "rows_dropped": 7}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    row = quality.accounting(df, F.col("id") > 6).first()
    assert tuple(row) == (10, 3, 7)


def test_reconcile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "n long")
    assert quality.reconcile(empty, "n", empty).first().matches


def test_curve_clustering_skips_files_on_every_column(spark, tmp_path):
    """Same rows as before; a value of either column lies in a few of the files only."""
    n = 64
    grid = spark.range(n * n).select((F.col("id") % n).alias("a"), F.floor(F.col("id") / n).alias("b"), "id")
    grid = grid.orderBy(F.xxhash64("id"))
    sinks.cluster(grid, str(tmp_path / "curve"), ["a", "b"], files=16)
    stored = spark.read.parquet(str(tmp_path / "curve"))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, grid.collect()))
    parts = [f"{tmp_path}/curve/{f}" for f in os.listdir(tmp_path / "curve") if f.endswith(".parquet")]
    assert len(parts) >= 12

    def opened(column, value):
        """Files whose statistics admit the value."""
        count = 0
        for part in parts:
            meta = pq.ParquetFile(part).metadata
            at = [meta.schema.column(k).name for k in range(meta.num_columns)].index(column)
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            count += any(s.min <= value <= s.max for s in stats)
        return count

    for column in ("a", "b"):
        assert sum(opened(column, v) for v in range(n)) / n <= len(parts) / 2
        found = stored.where(F.col(column) == 17)
        assert found.select(F.input_file_name()).distinct().count() <= len(parts) / 2
        assert found.count() == n


def test_curve_takes_nulls_dates_and_constants(spark, tmp_path):
    rows = [(None, datetime.date(2024, 1, d), 1.5) for d in range(1, 20)] + [(7, None, 1.5)]
    df = spark.createDataFrame(rows, "x int, day date, same double").withColumn("none", F.lit(None).cast("int"))
    sinks.cluster(df, str(tmp_path / "odd"), ["x", "day", "same", "none"])
    stored = spark.read.parquet(str(tmp_path / "odd"))
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, df.collect()))
    with pytest.raises(ValueError, match="fit"):
        sinks.on_curve(df, ["x"] * 8, "at")


def test_sketches_roll_up(spark):
    rows = spark.range(30_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 7001).alias("who"))
    days = aggregates.distinct_sketches(rows, ["day"], "who")
    whole = aggregates.merge_sketches(days.withColumn("all", F.lit(1)), ["all"]).first()
    assert whole.n == 30_000 and abs(whole.estimate - 7001) < 7001 * 0.03
