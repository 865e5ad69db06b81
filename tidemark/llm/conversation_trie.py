"""A trie of conversation prefixes, by whole-sequence collapse.

1. Turns are numbered within their conversation by a distributed sort, and become hashes.
2. A prefix is known by its length and the sum of hashes that each take in the place of
   their turn, in four lanes of 32 bits. Sums need no order: a whole conversation is a
   plain aggregate, and the prefixes of a very long one are running sums of blocks of its
   turns, with what lies before each block added.
3. Identical conversations collapse to one sequence with a weight, before any prefix is
   made. Those that are proper prefixes of others go by an anti-join; the rest are leaves.
4. The prefixes of the sequences, weighted, are aggregated to nodes. A node is owned by
   the sequence of its smallest member. What a sequence owns is the end of its path, so
   the distinct bytes below a node are sums over sequences as well, and no node is ever
   added to all its ancestors, which would be quadratic in the length of a conversation.

The list of members that end at a node is hashed as a stream in order, of which only the
running digest is kept: a digest of a list cannot be put together from parts.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import Tables, attach
from tidemark.operators.series import number_rows

# Turns of a conversation whose running sums one task makes.
BLOCK = 4096

_LANES = ("l1", "l2", "l3", "l4")
KEY = ["depth", "u", "v"]


def turns_of(tables: Tables, conversations: DataFrame) -> DataFrame:
    """(conv_id, rank, a, b, bytes, n): hashes of a turn's role and text, and the turns of
    its conversation. ``rank`` counts from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        text.alias("text"),
    )
    placed = number_rows(rows, ["conv_id", "turn", "role", "text"], "place").select(
        "conv_id",
        "place",
        F.xxhash64(F.lit(1), "role", "text").alias("a"),
        F.xxhash64(F.lit(2), "role", "text").alias("b"),
        F.octet_length("text").cast("long").alias("bytes"),
    )
    sizes = tables.keep(placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count("*").alias("n")), "sizes")
    ranked = attach(placed, sizes.withColumn("turns", F.col("n")), ["conv_id"])
    return tables.keep(
        ranked.select("conv_id", (F.col("place") - F.col("first")).alias("rank"), "a", "b", "bytes", F.col("turns").alias("n")),
        "turns",
    )


def branched(tables: Tables, turns: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that branch off the first of their family.

    Conversation c starts with the first h turns of conversation c - c % family, h being a
    checksum of c modulo ``heads``, and goes on with its own turns after the first h.
    Returns all conversations (conv_id) and their turns (conv_id, depth, a, b, bytes).
    """
    sizes = turns.where("rank = 0").select("conv_id", F.col("n").alias("own"))
    whole = sizes.select(
        "conv_id",
        "own",
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
    )
    known = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    whole = whole.join(known, "base", "left").withColumn("k", F.least("h", F.coalesce("there", F.lit(0))))
    whole = tables.keep(whole, "whole")
    start = turns.where(F.col("rank") < heads - 1).select(F.col("conv_id").alias("base"), "rank", "a", "b", "bytes")
    taken = whole.where("k > 0").join(start, "base").where("rank < k")
    shift = whole.select("conv_id", "h", "k", F.col("own").alias("n"))
    own = attach(turns.drop("n"), shift, ["conv_id"]).where("rank >= h")
    columns = ["conv_id", "depth", "a", "b", "bytes"]
    rows = taken.withColumn("depth", F.col("rank") + 1).select(columns)
    rows = rows.unionAll(own.withColumn("depth", F.col("rank") - F.col("h") + F.col("k") + 1).select(columns))
    return whole.select("conv_id"), rows


def _key(*sums: Column) -> list[Column]:
    return [F.xxhash64(F.lit(k + 1), *sums).alias(name) for k, name in enumerate(("u", "v"))]


def _laned(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, bytes, lanes) of turns (conv_id, depth, a, b, bytes)."""
    x, y = F.xxhash64(F.lit(1), "depth", "a", "b"), F.xxhash64(F.lit(2), "depth", "a", "b")
    low = F.lit((1 << 32) - 1)
    lanes = (x.bitwiseAND(low), F.shiftrightunsigned(x, 32), y.bitwiseAND(low), F.shiftrightunsigned(y, 32))
    return turns.select("conv_id", "depth", "bytes", *[lane.alias(name) for lane, name in zip(lanes, _LANES)])


def _ends(members: DataFrame) -> DataFrame:
    """KEY and the digest of the comma-joined ids of the conversations that end there."""

    def run(batches):
        key, made = None, None
        done: list[tuple] = []
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
            ids = batch.column(3).to_pylist()
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for first, last in zip([0, *cuts], [*cuts, len(ids)]):
                if first == last:
                    continue
                text = ",".join(map(str, ids[first:last])).encode()
                now = tuple(int(x) for x in keys[:, first])
                if now == key:
                    made.update(b"," + text)
                    continue
                if key is not None:
                    done.append((*key, made.hexdigest()))
                key, made = now, hashlib.sha256(text)
            yield _rows(done)
            done = []
        if key is not None:
            yield _rows([(*key, made.hexdigest())])

    def _rows(done):
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array([r[k] for r in done], kind) for k, kind in enumerate(types)]
        return pa.RecordBatch.from_arrays(arrays, names=[*KEY, "ends_sha256"])

    return (
        members.select(*KEY, "conv_id")
        .repartition(*KEY)
        .sortWithinPartitions(*KEY, "conv_id")
        .mapInArrow(run, "depth long, u long, v long, ends_sha256 string")
    )


def _prefixes(turns: DataFrame, sequences: DataFrame) -> DataFrame:
    """Every prefix of every sequence: conv_id, KEY, pu and pv (the key of the prefix one
    turn shorter), before (bytes of that one), and weight, n and total of the sequence."""
    facts = sequences.select("conv_id", "weight", F.col("depth").alias("n"), F.col("depth").alias("turns"), "total")
    sums = ["bytes", *_LANES]
    rows = attach(turns, facts, ["conv_id"], count="turns").withColumn("block", F.expr(f"depth div {BLOCK}"))
    blocks = rows.groupBy("conv_id", "block").agg(*[F.sum(s).alias(s) for s in sums])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "conv_id", "block", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_0") for s in sums]
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    until = [(F.col(f"{s}_1") + F.col(f"{s}_0")) for s in sums]
    bytes_until, *lanes = until
    return (
        rows.join(offsets, ["conv_id", "block"])
        .select("*", *[F.sum(s).over(so_far).alias(f"{s}_1") for s in sums])
        .select(
            "conv_id",
            "depth",
            *_key(*lanes),
            *[c.alias(n) for c, n in zip(_key(*[x - F.col(s) for x, s in zip(lanes, _LANES)]), ("pu", "pv"))],
            (bytes_until - F.col("bytes")).alias("before"),
            "weight",
            "n",
            "total",
        )
    )


def trie(tables: Tables, conversations: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of all prefixes: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    ``conversations`` has each conv_id once, turnless ones too; ``turns`` is (conv_id,
    depth, a, b, bytes) with depth from 1 and hashes a and b of the turn.
    """
    zero = [F.lit(0).cast("long")] * len(_LANES)
    turns = tables.keep(_laned(turns), "laned")
    whole = turns.groupBy("conv_id").agg(
        F.count("*").alias("depth"), F.sum("bytes").alias("total"), *[F.sum(x).alias(x) for x in _LANES]
    )
    filled = [F.coalesce(x, F.lit(0)) for x in _LANES]
    members = conversations.join(whole, "conv_id", "left").select(
        "conv_id", F.coalesce("depth", F.lit(0)).alias("depth"), *_key(*filled), F.coalesce("total", F.lit(0)).alias("total")
    )
    members = tables.keep(members, "members")
    sequences = members.groupBy(*KEY).agg(
        F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"), F.max("total").alias("total")
    )
    sequences = tables.keep(sequences, "sequences")
    none = F.lit(None).cast("long")
    roots = sequences.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), *_key(*zero), none.alias("pu"), none.alias("pv"),
        F.lit(0).cast("long").alias("before"), "weight", F.col("depth").alias("n"), "total",
    )
    prefixes = tables.keep(_prefixes(turns, sequences).unionAll(roots), "prefixes")
    nodes = tables.keep(
        prefixes.groupBy(*KEY).agg(
            F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("n").alias("deepest"),
            F.max("before").alias("before"), F.min("pu").alias("pu"), F.min("pv").alias("pv"),
        ),
        "nodes",
    )

    leaves = sequences.join(nodes.where("deepest > depth"), KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    owned = nodes.groupBy("conv_id").agg(F.min("before").alias("owned"))
    facts = (
        sequences.join(leaves, "conv_id", "left").join(owned, "conv_id", "left")
        .select(
            "conv_id", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("owned", "total").alias("owned"),
            F.col("depth").alias("rows"),
        )
    )
    shared = F.col("weight") * (F.col("total") - F.col("before"))
    distinct = F.col("total") - F.greatest("before", "owned")
    sums = (
        attach(prefixes, tables.keep(facts, "facts"), ["conv_id"], count="rows")
        .groupBy(*KEY)
        .agg(F.sum("leaf").alias("n_leaves"), F.sum(shared - distinct).alias("saved_tokens"))
    )

    parent = {"depth": "up", "u": "pu", "v": "pv"}
    up = nodes.where("depth > 0").withColumn("up", F.col("depth") - 1)
    children = tables.keep(
        up.groupBy("up", "pu", "pv").agg(F.count("*").alias("n_children"))
        .join(nodes.select("conv_id", *[F.col(k).alias(p) for k, p in parent.items()]), list(parent.values()))
        .withColumnRenamed("conv_id", "parent_conv_id"),
        "children",
    )
    parents = attach(up.select(*KEY, *parent.values()), children, list(parent.values()), count="n_children")
    counts = children.select("n_children", *[F.col(p).alias(k) for k, p in parent.items()])
    joined = reduce(
        lambda a, b: a.join(b, KEY, "left"),
        [sums, counts, _ends(members), parents.select(*KEY, "parent_conv_id")],
        nodes.select(*KEY, "conv_id", "n_convs"),
    )
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def branched_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The trie of conversations rebuilt as ``branched`` says; one row per node.

    Turns follow ``turn``, null first; turns of one number follow role and text, so the
    order of rows does not matter, and repeated rows are turns of their own. A null role or
    text is empty. Rows without conv_id belong to no conversation and are left out.
    A conversation without turns is a member of the root. Turns are equal when two 64-bit
    hashes of role and text are, prefixes when 128 bits of sums are. An empty table gives
    an empty result; other columns are ignored.
    """
    tables = Tables(spark, "trie")
    turns = turns_of(tables, conversations)
    whole, rows = branched(tables, turns)
    made = trie(tables, whole, rows)
    tables.drop("sizes", "turns", "whole", "laned")
    return made
