"""Row-ordered windows that survive a hot series.

``Window.partitionBy(entity)`` sends a whole entity to one task. That is right
for ordinary entities, but one entity may hold a third of all rows. Entities
above ``rows_per_task`` rows are therefore numbered by a distributed sort and cut
into blocks of equal size; each block also receives the few neighbouring rows its
frames reach, so every row sees exactly the rows it would see unsplit.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.config import ROWS_PER_TASK, materialise

# monotonically_increasing_id() holds the partition above this bit and the row
# index within the partition below it.
_PARTITION_SHIFT = 33

# Hot keys of a series: a table of them, None for "none", or "count" to find out.
Hot = DataFrame | None | Literal["count"]


def number_rows(df: DataFrame, order: Sequence[str], name: str = "_position") -> DataFrame:
    """1-based position in the global sort order, without a single-task sort.

    Range partitioning sorts in parallel; the layout is written out so that both
    passes over it see the same partitions; then each partition's first position
    is the running sum of the counts before it. There is one count per shuffle
    partition, so that small window and its broadcast do not grow with the data.
    """
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_at", _PARTITION_SHIFT)
    index = F.col("_at").bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .count()
        .select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + index + 1)
        .drop("_part", "_start", "_at")
    )


def running_totals(df: DataFrame, order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Add ``<name>_until``, the sum of each column up to and including a row in global order.

    ``order`` must be unique. The ranges of a distributed sort are summed first; each then
    adds what lies before it, one small row a range.
    """
    placed = materialise(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("_range").agg(*[F.sum(c).alias(c) for c in sums]).select(
        "_range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}_before") for c in sums]
    )
    so_far = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.join(F.broadcast(before), "_range")
        .withColumns({f"{c}_until": F.sum(c).over(so_far) + F.col(f"_{c}_before") for c in sums})
        .drop("_range", *[f"_{c}_before" for c in sums])
    )


def hot_entities(
    df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame | None:
    """Keys with more than ``rows_per_task`` rows, or None when there are none.

    Counts are combined before the shuffle, and at most N / rows_per_task keys
    can qualify. Calling a key hot only changes how it is computed, so the keys
    may be counted once on a source table that has at least as many rows.
    """
    hot = df.groupBy(*keys).count().filter(F.col("count") > rows_per_task).select(*keys)
    return None if hot.isEmpty() else materialise(hot, "hot")


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], Sequence[Mapping[str, Column]]],
    back: int,
    ahead: int = 0,
    rows_per_task: int = ROWS_PER_TASK,
    hot: Hot = "count",
) -> DataFrame:
    """Add window columns over each series.

    ``columns`` receives the window (partitioned and ordered) and returns the
    columns to add, in stages: a stage may use the columns of the one before.
    Values must depend on no more than ``back`` rows before and ``ahead`` rows
    after the current row.
    """
    plain = Window.partitionBy(*keys).orderBy(*order)
    if isinstance(hot, str):
        hot = hot_entities(df, keys, rows_per_task)
    if hot is None:
        return _add(df, columns(plain))
    cold = _add(df.join(hot, list(keys), "left_anti"), columns(plain))
    warm = df.join(hot, list(keys), "left_semi")
    return cold.unionByName(_in_blocks(warm, keys, order, columns, back, ahead, rows_per_task))


def _add(df: DataFrame, stages: Sequence[Mapping[str, Column]]) -> DataFrame:
    for stage in stages:
        df = df.withColumns(dict(stage)) if stage else df
    return df


def _in_blocks(df, keys, order, columns, back, ahead, rows_per_task) -> DataFrame:
    size = max(rows_per_task, back, ahead, 1)
    at = F.col("_position") - 1
    block = F.floor(at / size).cast("bigint")
    offset = at % size

    def copy(shift: int) -> Column:
        return F.struct((block + shift).alias("block"), F.lit(shift == 0).alias("home"))

    # A row goes to its own block, and to a neighbour whose frames reach it.
    late, early = offset >= size - back, offset < ahead
    copies = (
        F.when(late & early, F.array(copy(0), copy(1), copy(-1)))
        .when(late, F.array(copy(0), copy(1)))
        .when(early, F.array(copy(0), copy(-1)))
        .otherwise(F.array(copy(0)))
    )
    spread = number_rows(df, [*keys, *order]).withColumn("_copy", F.explode(copies))
    window = Window.partitionBy(*keys, F.col("_copy.block")).orderBy("_position")
    return (
        _add(spread, columns(window))
        .filter(F.col("_copy.home"))
        .drop("_copy", "_position")
    )


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    names: Sequence[str],
    default: float | None = 0,
    rows_per_task: int = ROWS_PER_TASK,
    hot: Hot = "count",
) -> DataFrame:
    """Carry the last non-null value forward within each series, then ``default``.

    The frame has no lower bound, so a hot series carries one value per block:
    the last non-null of every block is found by a grouped aggregate and carried
    over the blocks, of which there is one per ``rows_per_task`` rows.
    """
    so_far = (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    latest = {n: F.last(n, ignorenulls=True).over(so_far) for n in names}
    if isinstance(hot, str):
        hot = hot_entities(df, keys, rows_per_task)
    if hot is None:
        return _filled(df, names, latest, default)
    cold = _filled(df.join(hot, list(keys), "left_anti"), names, latest, default)

    block = F.floor((F.col("_position") - 1) / rows_per_task).cast("bigint")
    placed = number_rows(df.join(hot, list(keys), "left_semi"), [*keys, *order]).withColumn(
        "_block", block
    )
    last_in_block = placed.groupBy(*keys, "_block").agg(
        *[
            F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_position"))).alias(f"_carry_{n}")
            for n in names
        ]
    )
    before = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = last_in_block.withColumns(
        {f"_carry_{n}": F.last(f"_carry_{n}", ignorenulls=True).over(before) for n in names}
    )
    inside = (
        Window.partitionBy(*keys, "_block")
        .orderBy("_position")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    warm = _filled(
        placed.join(carried, [*keys, "_block"], "left"),
        names,
        {
            n: F.coalesce(F.last(n, ignorenulls=True).over(inside), F.col(f"_carry_{n}"))
            for n in names
        },
        default,
    ).drop("_position", "_block", *[f"_carry_{n}" for n in names])
    return cold.unionByName(warm)


def _filled(df, names, values, default) -> DataFrame:
    if default is not None:
        types = {n: df.schema[n].dataType for n in names}
        values = {n: F.coalesce(v, F.lit(default).cast(types[n])) for n, v in values.items()}
    return df.withColumns(values)
