"""A Merkle manifest of a dataset, its nodes labelled with the leaf ranks they cover.

Rows are leaves, ranked within their group by a distributed sort. A node is an interval
[lo, hi) of those ranks, so ancestry is containment and nothing points anywhere. Six
levels are built at a time from blocks of 3^6 neighbouring items: a block is a bounded
group, a group of rows of any size is many blocks, and each band of levels has 729 times
fewer items than the one below.

To prove a leaf, a band's items meet their ancestors in one join: the bucket of a level
is the rank divided by the width of a node there, and the ancestor contains the item.
What the children of an ancestor cover beyond the item are its siblings, those before it
and those after it. Paths of higher bands are attached block by block, from the top down,
so that no key of a join has more than 729 rows on its larger side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Tables
from tidemark.operators.series import number_rows


@dataclass(frozen=True)
class Merkle:
    """Which columns a leaf covers, how rows are grouped and ordered, and the tree's shape."""

    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")
    group: str = "source"
    order: str = "doc_id"
    fan: int = 3
    levels: int = 6

    @property
    def width(self) -> int:
        """Items of a block."""
        return self.fan**self.levels


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """A value with its length in bytes, so that neighbouring values cannot run together."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(p: Merkle, **replaced: Column) -> Column:
    """The digest of a row; ``replaced`` gives other values for some fields."""
    return digest(*[framed(replaced.get(f, F.col(f))) for f in p.fields])


def _leaves(tables: Tables, docs: DataFrame, leaf: Column, other: Column, p: Merkle) -> DataFrame:
    """(source, doc_id, leaf, other, tree, lo, hi, n): ``tree`` is the position of the first
    row of a group, ``lo`` the rank in it, ``n`` the rows of the group."""
    made = docs.select(
        F.col(p.group).alias("source"), F.col(p.order).alias("doc_id"), leaf.alias("leaf"), other.alias("other")
    )
    placed = number_rows(tables.keep(made, "leaves"), ["source", "doc_id", "leaf", "other"], "place")
    groups = placed.groupBy(F.col("source").alias("of")).agg(F.min("place").alias("tree"), F.count("*").alias("n"))
    groups = tables.keep(groups, "groups")
    ranked = placed.join(groups, F.col("source").eqNullSafe(F.col("of"))).withColumn("lo", F.col("place") - F.col("tree"))
    return tables.keep(ranked.withColumn("hi", F.col("lo") + 1).drop("of", "place"), "ranked")


def _depth(unit: int, p: Merkle) -> Column:
    """Levels that a tree of n leaves has in the band whose items cover ``unit`` leaves each."""
    widths = F.array(*[F.lit(unit * p.fan**k).cast("long") for k in range(p.levels)])
    return F.size(F.filter(widths, lambda w: w < F.col("n")))


def _band(items: DataFrame, unit: int, p: Merkle) -> DataFrame:
    """Nodes (tree, n, level, lo, hi, digest, children) of one band, and the lone items of
    trees that end below it (level 0)."""
    children = "array<struct<lo:bigint,hi:bigint,digest:string>>"
    item = F.struct(
        F.lit(0).alias("level"), "lo", "hi", "digest", F.array().cast(children).alias("children")
    )
    blocks = (
        items.groupBy("tree", "n", F.expr(f"lo div {unit * p.width}").alias("block"))
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .withColumn("depth", _depth(unit, p))
    )

    def run(below: Column, level: Column, k: Column) -> Column:
        own = F.transform(
            F.slice(below, k * p.fan + 1, p.fan),
            lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest")),
        )
        return F.struct(
            level.alias("level"),
            F.element_at(own, 1)["lo"].alias("lo"),
            F.element_at(own, -1)["hi"].alias("hi"),
            F.sha2(F.array_join(F.transform(own, lambda x: x["digest"]), ""), 256).alias("digest"),
            own.alias("children"),
        )

    def rise(done: Column, level: Column) -> Column:
        below = F.element_at(done, -1)
        runs = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(below) - 1) / p.fan).cast("int")), lambda k: run(below, level, k)
        )
        return F.concat(done, F.array(runs))

    numbers = F.slice(F.array(*[F.lit(k + 1) for k in range(p.levels)]), F.lit(1), F.col("depth"))
    levels = F.aggregate(numbers, F.array("items"), rise)
    return (
        blocks.select("tree", "n", "depth", F.inline(F.flatten(levels)))
        .where("level > 0 OR depth = 0")
        .drop("depth")
    )


def _grow(tables: Tables, items: DataFrame, most: int, label: str, p: Merkle) -> tuple[list, DataFrame]:
    """Bands (unit, items, nodes) of trees with at most ``most`` leaves, and their roots."""
    bands, unit = [], 1
    while unit < most:
        nodes = tables.keep(_band(items, unit, p), f"{label}{len(bands)}")
        bands.append((unit, items, nodes))
        items = nodes.where(F.col("level") == _depth(unit, p)).select("tree", "n", "lo", "hi", "digest")
        unit *= p.width
    return bands, items


def _siblings(items: DataFrame, nodes: DataFrame, unit: int, number: int, p: Merkle) -> DataFrame:
    """(tree, lo, path): what stands before and after an item below each ancestor of a band."""
    widths = F.array(*[F.lit(unit * p.fan**k).cast("long") for k in range(p.levels + 1)])
    bucket = (F.col("lo") - F.col("lo") % F.element_at(widths, F.col("level") + 1)).alias("bucket")
    below = items.select("tree", "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(p.levels))).alias("level"))
    ancestors = nodes.where("level > 0").select(
        "tree", "level", bucket, F.col("lo").alias("from"), F.col("hi").alias("to"), "children"
    )
    met = below.select("tree", "level", bucket, "lo", "hi").join(ancestors, ["tree", "level", "bucket"])

    def side(outside) -> Column:
        names = F.transform(F.filter("children", outside), lambda x: x["digest"])
        return F.unhex(F.array_join(names, ""))

    step = F.struct(
        (F.col("level") + number * p.levels).alias("level"),
        side(lambda x: x["hi"] <= F.col("lo")).alias("before"),
        side(lambda x: x["lo"] >= F.col("hi")).alias("after"),
    )
    return (
        met.where("from <= lo AND hi <= to")
        .select("tree", "lo", step.alias("step"))
        .groupBy("tree", "lo")
        .agg(F.array_sort(F.collect_list("step")).alias("path"))
    )


_NO_STEPS = "array<struct<level:int,before:binary,after:binary>>"


def _attach(tables: Tables, bands: list, above: DataFrame, label: str, p: Merkle) -> DataFrame:
    """(tree, lo, path, and what ``above`` carries) of the lowest items; ``above`` has one
    row for each root: tree, lo = 0 and the path beyond it."""
    for number in reversed(range(len(bands))):
        unit, items, nodes = bands[number]
        own = _siblings(items, nodes, unit, number, p)
        block = F.expr(f"lo div {unit * p.width}").alias("block")
        upper = above.select("*", block).drop("lo").withColumnRenamed("path", "beyond")
        above = tables.keep(
            items.select("tree", "lo", block)
            .join(own, ["tree", "lo"], "left")
            .join(upper, ["tree", "block"])
            .withColumn("path", F.concat(F.coalesce("path", F.array().cast(_NO_STEPS)), "beyond"))
            .drop("beyond", "block"),
            f"{label}{number}",
        )
    return above


def _hex(side: Column) -> Column:
    return F.lower(F.hex(side))


def folded(start: Column, path: str) -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, start, lambda a, s: digest(_hex(s["before"]), a, _hex(s["after"])))


def proofs(spark: SparkSession, docs: DataFrame, other: Column | None = None, p: Merkle = Merkle()) -> DataFrame:
    """One row per document: doc_id, leaf, other, subroot, root and the ``path`` of siblings
    from the leaf to the root, an array of (level, before, after) in raw bytes; levels of the
    upper tree start anew. ``other`` is a second digest to carry along, by default the leaf.

    A null group is a group of its own and comes first; a null order comes first in its
    group. Rows that share a group and an order follow the digest of the leaf; repeated rows
    are leaves of their own. Null fields count as absent values, unlike empty ones. An
    empty table gives an empty result; other columns are ignored.
    """
    tables = Tables(spark, "merkle")
    leaf = leaf_of(p)
    leaves = _leaves(tables, docs, leaf, leaf if other is None else other, p)
    items = leaves.select("tree", "n", "lo", "hi", F.col("leaf").alias("digest"))
    most = leaves.agg(F.max("n")).first()[0] or 0
    bands, roots = _grow(tables, items, most, "nodes", p)
    roots = roots.select(F.col("tree").alias("group"), F.col("digest").alias("subroot"))
    roots = tables.keep(number_rows(roots, ["group"], "place"), "subroots")
    n = roots.count()
    upper = roots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"), (F.col("place") - 1).alias("lo"),
        F.col("place").alias("hi"), F.col("subroot").alias("digest"),
    )
    upper_bands, top = _grow(tables, tables.keep(upper, "tops"), n, "upper", p)
    root = top.first()
    beyond = _attach(tables, upper_bands, top.select("tree", "lo", F.array().cast(_NO_STEPS).alias("path")), "beyond", p)
    above = (
        roots.withColumn("lo", F.col("place") - 1)
        .join(beyond.select("lo", "path"), "lo")
        .select(F.col("group").alias("tree"), F.lit(0).cast("long").alias("lo"), "path", "subroot")
    )
    paths = _attach(tables, bands, above, "paths", p)
    tables.drop("leaves", "groups")
    return leaves.join(paths, ["tree", "lo"]).select(
        "doc_id", "leaf", "other", "subroot", F.lit(root and root["digest"]).alias("root"), "path"
    )


def tampered(p: Merkle = Merkle()) -> Column:
    """The leaf of a row after line breaks were taken out of the text of every second row,
    by a checksum of its id. A null id or text stays as it is."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return leaf_of(p, text=F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))


def manifest(spark: SparkSession, docs: DataFrame, p: Merkle = Merkle()) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` starts from the leaf after tampering (see ``tampered``). Odd rows are
    treated as ``proofs`` says; a proof without siblings has the digest of nothing.
    """
    proved = proofs(spark, docs, tampered(p), p)
    siblings = F.transform("path", lambda s: F.concat(_hex(s["before"]), _hex(s["after"])))
    return proved.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        folded(F.col("other"), "path").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
