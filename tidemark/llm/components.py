"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Tables


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its closed neighbourhood."""
    both = edges.select("hi", "lo").union(edges.select(F.col("lo"), F.col("hi"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo")))


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """(doc_id, component_id) of every node that is not the smallest of its component.

    ``edges`` has columns hi and lo, hi above lo. Minima are combined before each
    shuffle and neighbours are joined, never gathered, so that a node with very many
    links stays cheap. Each round is a stored table, written and counted by one job.
    """
    check = {"check": F.xxhash64("hi", "lo").cast("decimal(38,0)")}
    now, seen = tables.keep_counted(edges.distinct(), "edges", **check)
    before = None
    while seen["rows"] and seen != before:
        before = seen
        now, seen = tables.keep_counted(_small_star(_large_star(now)).distinct(), "edges", **check)
    return now.select(F.col("hi").alias("doc_id"), F.col("lo").alias("component_id"))
