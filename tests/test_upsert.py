import os
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityError, Rule
from tidemark.operators.upsert import VersionedTable, merge_in_order, merge_rows

SCHEMA = "k string, t long, v long, d string"
ROWS = st.dictionaries(
    st.tuples(st.sampled_from("abc"), st.integers(0, 5)), st.integers(0, 99), max_size=12
)


def frame(spark, rows):
    return spark.createDataFrame([(k, t, v, f"d{t % 3}") for (k, t), v in rows.items()], SCHEMA)


def content(df):
    return {(r.k, r.t): r.v for r in df.collect()}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=ROWS, new=ROWS)
def test_merge_is_an_update_and_repeatable(spark, old, new):
    target, source = frame(spark, old), frame(spark, new)
    once = merge_rows(target, source, ["k", "t"])
    twice = merge_rows(once, source, ["k", "t"])
    assert once.count() == twice.count() == len({**old, **new})
    assert content(once) == content(twice) == {**old, **new}


ARRIVALS = st.lists(
    st.tuples(st.sampled_from("ab"), st.integers(0, 3), st.integers(0, 4), st.integers(0, 99)), max_size=14
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(arrivals=ARRIVALS, cut=st.integers(0, 14))
def test_the_order_of_batches_does_not_matter(spark, arrivals, cut):
    """Latest version first, then the smaller value, whatever came when."""
    rows = [(k, t, n, v, f"d{t}") for k, t, n, v in arrivals]
    make = lambda some: spark.createDataFrame(some, "k string, t long, n long, v long, d string")
    order = [F.desc_nulls_last("n"), F.asc_nulls_last("v")]
    expected = {}
    for k, t, n, v, _ in rows:
        expected[k, t] = max(expected.get((k, t), (-1, 0)), (n, -v))
    for first, second in ((rows[:cut], rows[cut:]), (rows[cut:], rows[:cut]), (rows, rows)):
        once = merge_in_order(make([]), make(first), ["k", "t"], order)
        both = merge_in_order(once, make(second), ["k", "t"], order)
        assert {(r.k, r.t): (r.n, -r.v) for r in both.collect()} == expected
        assert both.count() == len(expected)


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"), ["k", "t"], "d")


def test_versions(spark, table):
    assert table.read() is None and table.version() == 0
    assert table.merge(frame(spark, {("a", 0): 1, ("a", 1): 2})) == 1
    assert table.merge(frame(spark, {("a", 1): 9, ("b", 4): 3})) == 2
    assert content(table.read()) == {("a", 0): 1, ("a", 1): 9, ("b", 4): 3}


def test_only_touched_partitions_are_rewritten(spark, table):
    table.merge(frame(spark, {("a", 0): 1, ("a", 1): 2}))
    before = table._pointer(1)["partitions"]
    table.merge(frame(spark, {("b", 1): 5}))
    after = table._pointer(2)["partitions"]
    assert after["d0"] == before["d0"] and after["d1"] != before["d1"]
    written = os.listdir(f"{table.root}/data/commit={after['d1']}")
    assert [w for w in written if w.startswith("d=")] == ["d=d1"]


def test_unfinished_commit_is_invisible(spark, table):
    table.merge(frame(spark, {("a", 0): 1}))
    with open(f"{table.root}/pointer/.aside", "w") as f:  # a writer died before the rename
        f.write("{")
    os.makedirs(f"{table.root}/data/commit=lost/d=d0")
    assert table.version() == 1
    assert content(table.read()) == {("a", 0): 1}
    assert table.merge(frame(spark, {("a", 0): 7})) == 2
    assert content(table.read()) == {("a", 0): 7}


def test_second_writer_is_refused(spark, table):
    table.merge(frame(spark, {("a", 0): 1}))
    other = VersionedTable(spark, table.root, ["k", "t"], "d")
    other.version = lambda: 0  # read the pointer before the first commit
    with pytest.raises(RuntimeError, match="another writer"):
        other.merge(frame(spark, {("b", 0): 2}))
    assert content(table.read()) == {("a", 0): 1}


@pytest.mark.parametrize(
    "rows, problem",
    [([("a", None, 1, "d0")], "missing"), ([("a", 1, 1, "d1"), ("a", 1, 2, "d1")], "repeated"),
     ([("a", 1, 1, None)], "missing")],
)
def test_bad_keys_are_refused(spark, table, rows, problem):
    with pytest.raises(ValueError, match=problem):
        table.merge(spark.createDataFrame(rows, SCHEMA))
    assert table.version() == 0


def test_new_columns_appear(spark, table):
    table.merge(frame(spark, {("a", 0): 1, ("a", 1): 1}))
    wider = frame(spark, {("a", 1): 2}).selectExpr("*", "'x' AS extra")
    table.merge(wider)
    assert {(r.t, r.extra) for r in table.read().collect()} == {(0, None), (1, "x")}


def test_empty_source(spark, table):
    assert table.merge(frame(spark, {("a", 0): 1}).limit(0)) == 0


def test_registered_table_follows_versions(spark, table):
    assert table.register("versioned_rows") is False
    table.merge(frame(spark, {("a", 0): 1, ("a", 1): 2}))
    assert table.register("versioned_rows")
    table.merge(frame(spark, {("a", 1): 5}))
    table.register("versioned_rows")
    assert spark.sql("SELECT sum(v) FROM versioned_rows").first()[0] == 6
    spark.sql("DROP TABLE versioned_rows")
    assert content(table.read()) == {("a", 0): 1, ("a", 1): 5}


def test_expired_commits_are_deleted(spark, table):
    for v in (1, 2, 3):
        table.merge(frame(spark, {("a", 0): v, ("b", v): v}))
    commits = lambda: {d for d in os.listdir(f"{table.root}/data") if d.startswith("commit=")}
    assert table.expire() == 0 and len(commits()) == 3  # all are younger than the retention
    before = content(table.read())
    assert table.expire(hours=-1) == 0  # every commit still holds a partition
    table.merge(frame(spark, {("a", 0): 9, ("b", 1): 9, ("b", 2): 9}))
    assert table.expire(hours=-1) == 3
    assert len(commits()) == 1 and os.listdir(f"{table.root}/pointer") != []
    assert content(table.read()) == before | {("a", 0): 9, ("b", 1): 9, ("b", 2): 9}
    assert table.merge(frame(spark, {("a", 0): 10})) == 5


def test_age_counts_from_the_next_version(spark, table):
    """A version replaced just now keeps its files, however old it is."""
    table.merge(frame(spark, {("a", 0): 1}))
    reader = table.read()
    week = time.time() - 8 * 86400
    for folder, _, names in os.walk(table.root):
        for path in [folder, *(os.path.join(folder, n) for n in names)]:
            os.utime(path, (week, week))
    table.merge(frame(spark, {("a", 0): 2}))
    assert table.expire() == 0
    assert content(reader) == {("a", 0): 1}
    assert table.changed_since(1) == table.changed_since(0) == table.changed_since(99) != []


def test_merge_leaves_no_scratch(spark, table):
    from tidemark.config import shared_folder

    folder = f"{shared_folder(spark)}/tidemark"
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    table.merge(frame(spark, {("a", 0): 1}))
    assert set(os.listdir(folder)) == before


def test_bad_batch_stays_unseen(spark, table):
    """Rules are counted on the staged files; readers never see what breaks them."""
    small = Rule("v is large", F.col("v") > 50)
    warning = Rule("v is odd", F.col("v") % 2 == 1, "warning")
    table.merge(frame(spark, {("a", 0): 1, ("a", 1): 2}), [small, warning])
    with pytest.raises(QualityError, match="v is large: 1"):
        table.merge(frame(spark, {("a", 0): 70, ("b", 1): 3}), [small, warning])
    assert table.version() == 1 and content(table.read()) == {("a", 0): 1, ("a", 1): 2}
    assert table.changed_since(1) == []
    table.merge(frame(spark, {("a", 0): 7}), [small])
    assert content(table.read()) == {("a", 0): 7, ("a", 1): 2}


def test_rules_see_the_whole_touched_partition(spark, table):
    table.merge(frame(spark, {("a", 0): 60}))
    with pytest.raises(QualityError, match="large"):
        table.merge(frame(spark, {("b", 3): 1}), [Rule("v is large", F.col("v") > 50)])


def test_ordered_table_takes_repeated_keys(spark, tmp_path):
    order = [F.desc_nulls_last("v")]
    table = VersionedTable(spark, str(tmp_path / "o"), ["k", "t"], "d", order)
    rows = [("a", 0, 5, "d0"), ("a", 0, 9, "d0"), ("a", 1, 1, "d1")]
    table.merge(spark.createDataFrame(rows, SCHEMA))
    table.merge(spark.createDataFrame([("a", 0, 7, "d0"), ("a", 1, 2, "d1"), ("a", 1, 2, "d1")], SCHEMA))
    assert content(table.read()) == {("a", 0): 9, ("a", 1): 2} and table.read().count() == 2
    with pytest.raises(ValueError, match="missing"):
        table.merge(spark.createDataFrame([("a", None, 7, "d0")], SCHEMA))
