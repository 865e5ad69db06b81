"""Batch sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import exists


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    replace_all: bool = True,
    cluster_by: Sequence[str] = (),
) -> None:
    """Write partitioned by ``by``; without ``replace_all`` only touched partitions change.

    The rebalance hint lets AQE merge small partitions and split large ones, so a
    hot month becomes several files of normal size. ``cluster_by`` orders the rows
    within each file for row-group skipping.
    """
    spread = df.hint("rebalance", *by)
    if cluster_by:
        spread = spread.sortWithinPartitions(*by, *cluster_by)
    (
        spread.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


# Ranges of a column that the curve tells apart: two to this power.
CURVE_BITS = 8


def _range_number(column: str, bounds: Sequence, bits: int) -> Column:
    """How many of the ordered bounds lie at or below a value, by binary search."""
    listed = F.array(*[F.lit(v) for v in bounds])
    steps = F.array(*[F.lit(2**k) for k in reversed(range(bits))])

    def step_up(at: Column, step: Column) -> Column:
        return F.when(F.element_at(listed, at + step) <= F.col(column), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), step_up)


def on_curve(df: DataFrame, by: Sequence[str], name: str, bits: int = CURVE_BITS) -> DataFrame:
    """Add the place of a row on a space-filling curve through the ranges of several columns.

    Every column is cut at its own approximate quantiles, 2^bits - 1 values from one
    aggregate, and the bits of the range numbers are interleaved. Neighbours on the curve
    are then close in every column, whatever its type of number or date and its
    distribution. Null lies in the first range.
    """
    if len(by) * bits > 62:
        raise ValueError(f"{len(by)} columns of {bits} bits do not fit into a long")
    cuts = [k / 2**bits for k in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(c, cuts, 10_000).alias(f"c{i}") for i, c in enumerate(by)]).first()
    ranks = {
        f"_range{i}": _range_number(c, found[f"c{i}"], bits) if found[f"c{i}"] else F.lit(0) for i, c in enumerate(by)
    }
    key = F.lit(0).cast("long")
    for i in range(len(by)):
        for bit in range(bits):
            taken = F.shiftright(f"_range{i}", bit).bitwiseAND(F.lit(1)).cast("long")
            key = key + F.shiftleft(taken, bit * len(by) + i)
    return df.withColumns(ranks).withColumn(name, key).drop(*ranks)


def cluster(df: DataFrame, path: str, by: Sequence[str], files: int | None = None) -> None:
    """Rewrite compacted and clustered, so that file and row-group statistics can skip data.

    Several columns are clustered along a space-filling curve: a filter on any one of
    them skips files, where a plain sort would serve the first column only.
    """
    if len(by) > 1:
        df, order = on_curve(df, by, "_curve"), ["_curve", *by]
    else:
        order = list(by)
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).drop("_curve").write.mode("overwrite").parquet(path)


def register(spark: SparkSession, tables: Mapping[str, str]) -> dict[str, bool]:
    """Register paths as tables by name. Missing paths are skipped."""
    done = {}
    for name, path in tables.items():
        done[name] = exists(spark, path)
        if done[name]:
            location = path.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{location}'")
            if any(c.isPartition for c in spark.catalog.listColumns(name)):
                spark.catalog.recoverPartitions(name)
            spark.catalog.refreshTable(name)
    return done


def online_rows(
    latest: DataFrame, entity: str, instant: str, exclude: Sequence[str], prefix: str
) -> DataFrame:
    """Key-value form of the latest row per entity: key, features as JSON, time, entity."""
    names = [c for c in latest.columns if c not in {entity, instant, *exclude}]
    return latest.select(
        F.concat(F.lit(prefix), F.col(entity).cast("string")).alias("key"),
        F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("features"),
        F.col(instant).cast("string").alias("updated_at"),
        F.col(entity),
    )


def push_rows(rows: DataFrame, put: Callable[[Iterator[Row]], None]) -> None:
    """Hand each partition to a store client. ``put`` must be idempotent: tasks may rerun."""
    rows.foreachPartition(put)


def newest_first(*columns: str) -> list[Column]:
    return [F.desc_nulls_last(c) for c in columns]
