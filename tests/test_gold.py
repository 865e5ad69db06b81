import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityError
from tidemark.operators.ranking import most_frequent
from tidemark.plans import gold, validation


@pytest.fixture
def clean(readings):
    at = F.timestamp_seconds("recorded_dt")
    return readings.withColumns({"recorded_at": at, "recorded_date": F.to_date(at)})


def test_one_row_per_city_and_day(clean):
    daily = gold.daily_stats(gold.day_cube(clean))
    rows = {(r.city, r.recorded_date.day): r for r in daily.collect()}
    assert set(rows) == {("Aldermoor", 5), ("Aldermoor", 6), ("Brinkum", 5), ("Corvalho", 6)}
    first = rows["Aldermoor", 5]
    assert first.measurement_count == 2
    assert first.avg_temperature == pytest.approx(6.0)
    assert (first.min_temperature, first.max_temperature) == (4.25, 7.75)
    assert sum(r.measurement_count for r in rows.values()) == clean.count()
    assert all(r.min_temperature <= r.avg_temperature <= r.max_temperature for r in rows.values())


def test_exact_means_match_plain_means(clean):
    def means(cube, digits=None):
        return {(r.city, r.recorded_date): r.avg_temperature for r in gold.daily_stats(cube, digits).collect()}

    exact = means(gold.day_cube(clean, {"temperature": 2}), {"temperature": 2})
    assert exact == pytest.approx(means(gold.day_cube(clean)))


def test_daily_fact_columns_and_keys(clean):
    cube = gold.day_cube(clean)
    fact = gold.daily_fact(cube, gold.dim_city(cube), gold.dim_date(cube))
    rows = {(r.city, r.date_id): r for r in fact.collect()}
    assert {k: r.city_id for k, r in rows.items()} == {
        ("Aldermoor", 1): 1, ("Aldermoor", 2): 1, ("Brinkum", 1): 2, ("Corvalho", 2): 3,
    }
    assert rows["Aldermoor", 1].dominant_weather_condition == "Mist"  # a tie goes to the first name
    assert rows["Brinkum", 1].temp_volatility is None  # one day has no deviation
    assert (rows["Corvalho", 2].year, rows["Corvalho", 2].month) == (2022, 11)


def test_monthly_counts_days_not_rows(clean):
    month = {r.city: r for r in gold.monthly_fact(gold.day_cube(clean)).collect()}
    assert month["Aldermoor"].rainy_day_count == 2
    assert month["Aldermoor"].total_measurements == 3
    assert month["Corvalho"].clear_day_count == 1
    assert month["Corvalho"].year_month == "2022-11"


def test_missing_condition_is_no_rain(clean):
    blank = clean.withColumn("weather_condition", F.lit(None).cast("string"))
    row = gold.monthly_fact(gold.day_cube(blank)).first()
    assert row.rainy_day_count == 0 and row.clear_day_count == 0


def test_summary_takes_latest_and_first(clean):
    summary = {r.city: r for r in gold.city_summary(gold.day_cube(clean)).collect()}
    assert summary["Aldermoor"].latest_temperature == 3.5
    assert summary["Aldermoor"].latest_humidity == 88.0
    assert summary["Aldermoor"].latitude == 53.5
    assert summary["Aldermoor"].total_days_tracked == 2


def test_two_spellings_keep_one_latest_row(clean):
    """Grouping by country splits the city; the latest reading stays per city."""
    other = clean.filter("city = 'Aldermoor'").withColumns(
        {"country": F.lit("Britain"), "recorded_dt": F.col("recorded_dt") + 1}
    )
    rows = gold.city_summary(gold.day_cube(clean.union(other))).filter("city = 'Aldermoor'").collect()
    assert {r.country for r in rows} == {"GB", "Britain"}
    assert {r.latest_temperature for r in rows} == {3.5}


def test_place_after_grouping_equals_before(clean):
    bare = clean.drop("country", "latitude", "longitude")
    attributes = clean.select("city", "country", "latitude", "longitude").distinct()
    placed = gold.place(gold.day_cube(bare), attributes)
    columns = gold.daily_stats(placed).columns
    key = lambda df: sorted(tuple(r) for r in df.select(columns).collect())
    assert key(gold.daily_stats(placed)) == key(gold.daily_stats(gold.day_cube(clean)))


def test_most_frequent_counts_null_but_prefers_a_name(spark):
    rows = spark.createDataFrame(
        [(1, None), (1, None), (1, "a"), (2, None), (2, "b")], "k int, c string"
    )
    got = {r.k: r.m for r in most_frequent(rows, ["k"], "c", "m").collect()}
    assert got == {1: None, 2: "b"}


def test_reconciliation(clean):
    daily = gold.daily_stats(gold.day_cube(clean)).withColumn("aggregated_at", F.current_timestamp())
    validation.gold(daily, clean)
    with pytest.raises(QualityError, match="silver has 3"):
        validation.gold(daily, clean.limit(3))
    broken = daily.withColumn("avg_temperature", F.lit(500.0))
    with pytest.raises(QualityError, match="min <= avg <= max"):
        validation.gold(broken, clean)


def test_empty_table(clean):
    assert gold.daily_stats(gold.day_cube(clean.limit(0))).count() == 0
