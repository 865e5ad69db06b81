"""Mix sources to target weights: Sainte-Laguë quotas of equal-token blocks.

1. Each source's words are counted; weights become targets, limited to a few passes over
   a source, what exceeds the limit being shared out again.
2. The mix is a row of shards of equally many blocks of equally many words. Blocks go
   one by one to the source with the highest quotient target / (2 * given + 1), so every
   shard has a whole number of blocks of each source, close to its share.
3. Within a source, documents lie on a line in an order drawn from the seed and are cut
   into blocks; the mix takes whole passes, then the first blocks of the order.

Quotas need one row per source on the driver. Positions on a source's line come from two
levels of running sums, over slices of the order and within a slice, so a source with
most of the rows is as divided as any other.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import SPACE, Tables


@dataclass(frozen=True)
class Mixing:
    """``weights`` repeat over the sources in order of their names, null last.
    ``passes`` is how often a document may be taken. The mix has ``shards`` shards, fewer
    if there are fewer blocks of ``block_words`` words. More sources than ``most_sources``
    are refused: their quotas are worked out on the driver. ``slices`` divides a source's
    order into parts that are summed on their own."""

    weights: tuple[int, ...] = (1, 2, 3)
    passes: int = 3
    block_words: int = 64
    shards: int = 64
    seed: str = "mix"
    slices: int = 256
    most_sources: int = 100_000


@dataclass(frozen=True)
class Quota:
    """What a source gives: how many of its blocks lie in the shards up to each one."""

    source: str | None
    size: int
    target: float
    ends: list[int]


def targets(sizes: list[int], weights: list[int], passes: int) -> list[float]:
    """Shares of the total by weight, none above ``passes`` times its source's size.

    Sources reach their limit in order of limit / weight; the rest share what is left.
    """
    left, weight = sum(sizes), sum(weights)
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (Fraction(passes * sizes[i], weights[i]), i))
    for at, i in enumerate(order):
        if passes * sizes[i] * weight <= left * weights[i]:
            out[i] = float(passes * sizes[i])
            left -= passes * sizes[i]
            weight -= weights[i]
        else:
            for j in order[at:]:
                out[j] = left * weights[j] / weight
            break
    return out


def _given(targets: list[float], least: float) -> list[int]:
    """Blocks each source has once every quotient of at least ``least`` is served."""
    return [int((t / least + 1) / 2) if t > 0 else 0 for t in targets]


def apportion(targets: list[float], blocks: int) -> list[int]:
    """Sainte-Laguë: seats by highest quotients target / 1, / 3, / 5 and so on.

    The quotient of the last seat is found by halving an interval; the few seats left at
    that point go one by one, equal quotients to the earlier source.
    """
    if blocks <= 0 or not any(targets):
        return [0] * len(targets)
    low, high = 0.0, max(targets) * 2
    low = sum(targets) / (4.0 * blocks + 4 * len(targets))
    for _ in range(200):
        middle = (low + high) / 2
        if sum(_given(targets, middle)) > blocks:
            low = middle
        else:
            high = middle
    seats = _given(targets, high)
    while sum(seats) < blocks:
        best = max(range(len(targets)), key=lambda i: (targets[i] / (2 * seats[i] + 1), -i))
        seats[best] += 1
    return seats


def shard_ends(targets: list[float], blocks: int, shards: int) -> list[list[int]]:
    """For each source, its blocks in the shards up to each one. The differences are the
    quotas of a shard: seats are never taken back as their number grows."""
    each = max(1, -(-blocks // shards))
    ends = [apportion(targets, min(end, blocks)) for end in range(each, blocks + each, each)]
    return [list(x) for x in zip(*ends)] if ends else [[0] for _ in targets]


def words(text: Column) -> Column:
    """Number of words; null has none."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")
    inner = F.regexp_replace(spaced, "^ | $", "")
    gaps = F.length(inner) - F.length(F.replace(inner, F.lit(" "), F.lit("")))
    return F.when(inner == "", 0).otherwise(gaps + 1).cast("long")


def plan(docs: DataFrame, p: Mixing) -> list[Quota]:
    """Targets and quotas from (source, size) rows."""
    sums = docs.groupBy("source").agg(F.sum("size").cast("long").alias("size"))
    found = [tuple(r) for r in sums.limit(p.most_sources + 1).collect()]
    if len(found) > p.most_sources:
        raise ValueError(f"more than {p.most_sources} sources")
    # Code point order is the order of UTF-8 bytes, and of Python's strings.
    found.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [r[1] for r in found]
    weights = [p.weights[i % len(p.weights)] for i in range(len(found))]
    goals = targets(sizes, weights, p.passes)
    ends = shard_ends(goals, -(-sum(sizes) // p.block_words), p.shards)
    return [Quota(r[0], r[1], g, e) for r, g, e in zip(found, goals, ends)]


def _quota_table(spark: SparkSession, quotas: list[Quota], p: Mixing) -> DataFrame:
    rows = [
        (q.source, q.size, q.target, q.ends, min(q.ends[-1] * p.block_words, p.passes * q.size)) for q in quotas
    ]
    schema = "source string, source_size long, target double, ends array<long>, quota long"
    return spark.createDataFrame(rows, schema)


def mix(spark: SparkSession, docs: DataFrame, p: Mixing = Mixing(), carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``row`` with the columns of ``carry``, source,
    size, source_size, target, passes (how often it is taken whole), last (how many of its
    first words the last, unfinished pass takes), taken, and shard (of its first block; -1 if nothing is taken).

    A null or empty text has size 0 and nothing taken. A null source is one source, after
    all others. Rows that share an id are ordered by their text, and by nothing more if
    that is equal too: equal rows may change places. An empty table gives an empty result;
    given columns outside ``carry`` are ignored.
    """
    tables = Tables(spark, "mixing")
    order = F.md5(F.concat(F.lit(p.seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    extra = [F.struct(*[docs[f"`{c}`"] for c in carry]).alias("row")] if carry else []
    sized = docs.select(
        F.col("doc_id").cast(T.LongType()),
        "source",
        words(F.col("text")).alias("size"),
        order.alias("place"),
        F.xxhash64("text").alias("tie"),
        *extra,
    )
    sized = tables.keep(sized, "sized")
    slice_of = F.conv(F.substring("place", 1, 4), 16, 10).cast("int") * p.slices / 65536
    cut = sized.withColumn("slice", F.floor(slice_of).cast("int"))
    quotas = F.broadcast(_quota_table(spark, plan(cut.select("source", "size"), p), p))

    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("source", "slice")
        .agg(F.sum("size").alias("part"))
        .withColumn("offset", F.coalesce(F.sum("part").over(before), F.lit(0)))
        .select(F.col("source").alias("s"), F.col("slice").alias("k"), "offset")
    )
    within = Window.partitionBy("source", "slice").orderBy("place", "doc_id", "size", "tie")
    line = (
        cut.withColumn("end", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .join(offsets, F.expr("source <=> s AND slice = k"))
        .withColumn("end", F.col("end") + F.col("offset"))
        .drop("s", "k", "offset", "slice", "tie", "place")
    )
    quotas = quotas.withColumnRenamed("source", "s")
    out = line.join(quotas, F.expr("source <=> s"), "left").drop("s")
    rest = F.expr("quota - passes * source_size")
    return (
        out.withColumn("passes", F.expr("CASE WHEN source_size > 0 THEN quota DIV source_size ELSE 0 END"))
        .withColumn("last", F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("end") - F.col("size")))))
        .withColumn("taken", F.col("passes") * F.col("size") + F.col("last"))
        .withColumn("block", F.floor((F.col("end") - F.col("size")) / p.block_words))
        .withColumn("shard", F.when(F.col("taken") > 0, F.expr("size(filter(ends, e -> e <= block))")).otherwise(-1).cast("long"))
        .drop("end", "ends", "quota", "block")
    )


def report(spark: SparkSession, docs: DataFrame, p: Mixing = Mixing()) -> DataFrame:
    """doc_id, size, source_size, target, taken and shard of every document."""
    return mix(spark, docs, p).select("doc_id", "size", "source_size", "target", "taken", "shard")


def mixed(spark: SparkSession, docs: DataFrame, p: Mixing = Mixing()) -> DataFrame:
    """The mix as rows with the columns given: a document once for each whole pass, and its
    first words where the last pass ends within it; one row in each source can be so cut.
    Documents without words are in no block."""
    taken = mix(spark, docs, p, tuple(docs.columns))
    # Pieces end with the white space after a word; white space before all is one more.
    pieces = F.split("row.text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    blank = F.col("row.text").rlike(r"^[\x20\x09-\x0D]").cast("int")
    cut = F.array_join(F.slice(pieces, 1, F.col("last").cast("int") + blank), "")
    text = F.when((F.col("last") < F.col("size")) & (F.col("copy") == F.col("passes")), cut).otherwise(F.col("row.text"))
    copies = F.col("passes") + (F.col("last") > 0).cast("long")
    rows = taken.where((F.col("size") > 0) & (copies > 0)).withColumn(
        "copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))
    )
    return rows.select(
        *[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    )
