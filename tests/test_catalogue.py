"""Every registered query against its oracle, without tolerance."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
SLOW = {"tree_scores"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = entry_point.queries()[name](spark, SF)
    assert differences(df, con, entry_point.oracle_sql()[name]) == []


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_hash_split_share(spark):
    counts = entry_point.queries()["hash_split_counts"](spark, "/root/testdata/sf0.01")
    rows = {}
    for r in counts.collect():
        rows[r["training"]] = rows.get(r["training"], 0) + r["n"]
    assert 0.78 < rows[True] / (rows[True] + rows[False]) < 0.82
