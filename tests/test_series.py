"""Splitting a hot series must not change any row."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import fixed_point
from tidemark.operators.ranking import dense_key, dense_key_small
from tidemark.operators.series import forward_fill, hot_entities, number_rows, over_series

RELAXED = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
SERIES = st.lists(
    st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=60
)


def frame(spark, rows):
    data = [(k, i, None if v is None else float(v)) for i, (k, v) in enumerate(rows)]
    return spark.createDataFrame(data, "k string, t long, v double").repartition(5)


def columns(window):
    reach = window.rowsBetween(-3, 0)
    return [{
        "before": F.lag("v", 2).over(window),
        "after": F.lead("v", 1).over(window),
        "total": F.sum("v").over(reach),
        "rows": F.count(F.lit(1)).over(reach),
    }]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@RELAXED
@given(rows=SERIES, size=st.integers(1, 12))
def test_split_equals_plain(spark, rows, size):
    df = frame(spark, rows)
    plain = df.withColumns(columns(Window.partitionBy("k").orderBy("t"))[0])
    split = over_series(df, ["k"], ["t"], columns, back=3, ahead=1, rows_per_task=size)
    assert collected(split.select(plain.columns)) == collected(plain)


@RELAXED
@given(rows=SERIES, size=st.integers(1, 12))
def test_fill_split_equals_plain(spark, rows, size):
    df = frame(spark, rows)
    plain = forward_fill(df, ["k"], ["t"], ["v"], hot=None)
    split = forward_fill(df, ["k"], ["t"], ["v"], rows_per_task=size)
    assert collected(split.select(plain.columns)) == collected(plain)


def test_one_entity_with_a_third_of_the_rows(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("k"),
        F.col("id").alias("t"),
        F.col("id").cast("double").alias("v"),
    )
    assert [r.k for r in hot_entities(df, ["k"], 100).collect()] == ["hot"]
    assert hot_entities(df, ["k"], 1000) is None
    split = over_series(df, ["k"], ["t"], columns, back=3, ahead=1, rows_per_task=100)
    plain = df.withColumns(columns(Window.partitionBy("k").orderBy("t"))[0])
    assert collected(split.select(plain.columns)) == collected(plain)
    sizes = (
        number_rows(df.filter("k = 'hot'"), ["k", "t"])
        .groupBy(F.floor((F.col("_position") - 1) / 100)).count().select("count").collect()
    )
    assert {s[0] for s in sizes} == {100}


def test_equal_times_are_split_too(spark):
    """A burst of rows with one timestamp still makes blocks of bounded size."""
    df = spark.range(1000).select(F.lit("k").alias("k"), F.lit(1).alias("t"), F.col("id").alias("v"))
    out = over_series(
        df, ["k"], ["t"], lambda w: [{"n": F.count(F.lit(1)).over(w.rowsBetween(-9, 0))}], back=9, rows_per_task=50
    )
    assert out.count() == 1000
    assert sorted(r.n for r in out.collect()) == sorted([*range(1, 10), *[10] * 991])


@pytest.mark.parametrize("n", [1, 997])
def test_dense_keys_agree(spark, n):
    df = spark.range(n).select((F.col("id") * 7 % 1009).alias("x")).repartition(6)
    assert collected(dense_key(df, "x", "id")) == collected(dense_key_small(df, "x", "id"))


def test_short_series_and_single_row(spark):
    df = frame(spark, [("a", 1)])
    row = over_series(df, ["k"], ["t"], columns, back=3, ahead=1).first()
    assert row.before is None and row.after is None and row.rows == 1


@RELAXED
@given(rows=SERIES, size=st.integers(1, 12), digits=st.sampled_from([None, 2]))
def test_trailing_statistics(spark, rows, size, digits):
    """Differences of running sums equal sliding frames, whole and split."""
    df = frame(spark, rows)

    def trailing(window):
        return [
            fixed_point.running("v", digits, window, squares=True),
            {
                "mean": fixed_point.trailing_mean("v", digits, 3, window),
                "sd": fixed_point.trailing_stddev("v", digits, 3, window),
            },
        ]

    window = Window.partitionBy("k").orderBy("t").rowsBetween(-3, 0)
    plain = df.withColumns({"mean": F.avg("v").over(window), "sd": F.stddev_samp("v").over(window)})
    expected = {(r.k, r.t): (r.mean, r.sd) for r in plain.collect()}
    for hot in (None, "count"):
        out = over_series(df, ["k"], ["t"], trailing, back=4, rows_per_task=size, hot=hot)
        got = {(r.k, r.t): (r.mean, r.sd) for r in out.collect()}
        assert got.keys() == expected.keys()
        for key, (mean, sd) in expected.items():
            assert got[key][0] == (None if mean is None else pytest.approx(mean))
            assert got[key][1] == (None if sd is None else pytest.approx(sd, abs=1e-9))
