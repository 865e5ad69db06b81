"""Near-duplicate documents: MinHash bands, signature check, exact check, components.

1. ``sketch`` computes, in one pass over the texts, a fingerprint of the shingle set and
   the bands of many universal hash minima.
2. Documents with equal sets are one class, represented by the smallest id.
3. Representatives that share a band are candidates. Within a bucket they are compared
   with *centres*, the smallest ids, 64 times as many in each round, never all at once: a
   member already in the centre's component needs no comparison. A bucket is done once
   its members that have not been centres are all in one component. So no group is
   gathered or expanded into pairs as long as its members are linked, and no candidate is
   given up either. A large bucket is dealt out in parts, to each of which its centres go.
4. Documents that share a bucket get a longer signature, one bit of each of 2048 minima.
   It is compared as a condition of the join that makes the candidates, so pairs below the
   threshold by more than the signature's error never become rows; nor does a pair in any
   bucket but the least it shares. Full sets decide.
5. Links become components by alternating large-star and small-star. A round links the
   components of the round before, not documents again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.common import GRAM, Tables, mix, steps, texts
from tidemark.llm.components import components
from tidemark.operators.ranking import keep_first


@dataclass(frozen=True)
class NearDedup:
    """Parameters. A pair at the threshold is missed with probability
    (1 - threshold^rows)^bands, 5e-8 for the defaults. ``slack`` is how many standard
    deviations below the threshold the estimate of a signature of ``longs`` times 64 bits
    may lie: one such pair in 3 million is lost, if nothing else links it.
    ``quick_longs`` of them are looked at first."""

    words: int = 4
    percent: int = 80
    bands: int = 32
    rows: int = 4
    slack: float = 5.0
    longs: int = 32
    quick_longs: int = 8

    def most_different(self, longs: int) -> int:
        """Differing signature bits above which a pair is rejected."""
        bits = 64 * longs
        differ = (1 - self.percent / 100) / 2
        return int(bits * differ + self.slack * (bits * differ * (1 - differ)) ** 0.5)


# ``tag`` tells apart the texts of rows that share an id.
SKETCH = "doc_id long, tag long, n_shingles long, print binary, bands array<long>"

# Members of a bucket that meet its centres in one task.
PART_ROWS = 4096
GROWTH = 64


def shingle_sets(step, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a step."""
    step.words()
    words = step.hashes(lower=True)
    grams, bounds = step.grams(words, n)
    for k in range(len(step.offsets) - 1):
        low, high = step.bounds[k], step.bounds[k + 1]
        if 0 < high - low < n:
            few = words[low:high] * GRAM[32 : 32 + high - low]
            yield mix(np.atleast_1d(few.sum(dtype=np.uint64) + np.uint64(high - low)))
        else:
            yield np.unique(grams[bounds[k] : bounds[k + 1]])


def _factors(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of ``n`` hash functions."""
    seeded = np.random.Generator(np.random.PCG64(seed))
    a = seeded.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, seeded.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)


def _minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of a * x + b modulo 2^64 over a set; the high halves are universal hashes."""
    least = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
    for h in range(0, len(a), 128):
        for k in range(0, len(values), 1024):
            hashed = np.multiply.outer(a[h : h + 128], values[k : k + 1024])
            hashed += b[h : h + 128, None]
            np.minimum(least[h : h + 128], hashed.min(axis=1), out=least[h : h + 128])
    return least >> np.uint64(32)


def _bands(values: np.ndarray, p: NearDedup, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash for each band of minima, no two bands alike."""
    salt = mix(np.arange(1, p.bands + 1, dtype=np.uint64))
    least = _minima(values, a, b).reshape(p.bands, p.rows)
    return mix((least * GRAM[: p.rows]).sum(axis=1, dtype=np.uint64) + salt)


def _tag(print_: bytes) -> int:
    return int.from_bytes(print_[:8], "little", signed=True)


def sketch(docs: DataFrame, p: NearDedup) -> DataFrame:
    """One row of ``SKETCH`` for each document that has a word."""
    a, b = _factors(p.bands * p.rows, 71)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = []
            for step in steps(batch.column(1)):
                for doc_id, values in zip(ids[step.first : step.last], shingle_sets(step, p.words)):
                    if not len(values) or doc_id is None:
                        continue
                    print_ = xxhash.xxh3_128_digest(values.tobytes())
                    rows.append((doc_id, _tag(print_), len(values), print_, _bands(values, p, a, b).view(np.int64)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.int64()),
                        pa.array([r[3] for r in rows], pa.binary()),
                        pa.array([r[4] for r in rows], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "tag", "n_shingles", "print", "bands"],
                )

    return texts(docs, "doc_id").mapInArrow(run, SKETCH)


def _signature(p: NearDedup) -> list[str]:
    """Columns of a signature: the first longs, then the rest as an array."""
    return [*[f"s{k}" for k in range(p.quick_longs)], "more"]


def _sets(docs: DataFrame, p: NearDedup) -> DataFrame:
    """(doc_id, tag, shingles, bands, s0, s1 ..., more) of documents; bands have 31 bits here."""
    a, b = _factors(64 * p.longs, 72)
    of_bands = _factors(p.bands * p.rows, 71)

    def run(batches):
        for batch in batches:
            for step in steps(batch.column(1)):
                values = list(shingle_sets(step, p.words))
                bits = [(_minima(v, a, b) & np.uint64(1)).astype(np.uint8) for v in values]
                longs = np.packbits(np.array(bits, np.uint8), axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(step.first, len(values)).cast(pa.int64()),
                        pa.array([_tag(xxhash.xxh3_128_digest(v.tobytes())) for v in values], pa.int64()),
                        pa.array([v.view(np.int64) for v in values], pa.list_(pa.int64())),
                        pa.array(
                            [(_bands(v, p, *of_bands) >> np.uint64(33)).astype(np.int32) for v in values],
                            pa.list_(pa.int32()),
                        ),
                        *[pa.array(np.ascontiguousarray(x)) for x in longs.T[: p.quick_longs]],
                        pa.array(list(longs[:, p.quick_longs :]), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "tag", "shingles", "bands", *_signature(p)],
                )

    quick = "".join(f"s{k} long, " for k in range(p.quick_longs))
    schema = f"doc_id long, tag long, shingles array<long>, bands array<int>, {quick}more array<long>"
    return texts(docs, "doc_id").mapInArrow(run, schema)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components (hi, lo) of the pairs whose full sets reach the threshold."""
    lo = sets.select(F.col("doc_id").alias("lo"), F.col("tag").alias("lo_tag"), F.col("shingles").alias("left"))
    hi = sets.select(F.col("doc_id").alias("hi"), F.col("tag").alias("hi_tag"), F.col("shingles").alias("right"))
    return (
        pairs.join(lo, ["lo", "lo_tag"])
        .join(hi, ["hi", "hi_tag"])
        .select("of_lo", "of_hi", F.size("left").alias("m"), F.size("right").alias("n"),
                F.size(F.array_intersect("left", "right")).alias("both"))
        .where(F.lit(100) * F.col("both") >= F.lit(percent) * (F.col("m") + F.col("n") - F.col("both")))
        .select(F.greatest("of_lo", "of_hi").alias("hi"), F.least("of_lo", "of_hi").alias("lo"))
        .distinct()
    )


def _differ(a: Column, b: Column) -> Column:
    """Number of bits in which two longs differ."""
    return F.bit_count(a.bitwiseXOR(b))


def _open_buckets(members: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, dealt out in parts."""
    mixed = (
        members.groupBy("key")
        .agg(F.min("component_id").alias("least"), F.max("component_id").alias("most"), F.count("*").alias("n"))
        .where("least < most")
        .select("key", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts"))
    )
    return members.join(mixed, "key")


def _labelled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with the component of their doc_id."""
    return rows.join(found, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))


def link(docs: DataFrame, tables: Tables, p: NearDedup) -> tuple[DataFrame, DataFrame]:
    """Sketches of all documents, and (doc_id, component_id) of those not smallest in theirs."""
    sketches = tables.keep(sketch(docs, p), "sketches")
    classes = sketches.groupBy("print", "n_shingles").agg(F.min("doc_id").alias("least"))
    placed = sketches.join(classes, ["print", "n_shingles"])
    copies = placed.where("doc_id > least").select(F.col("doc_id").alias("hi"), F.col("least").alias("lo"))
    found = tables.keep(components(copies, tables), "found0")
    heads = placed.where("doc_id = least").dropDuplicates(["doc_id", "tag"])
    banded = _labelled(heads.select(F.explode("bands").alias("key"), "doc_id", "tag"), found)
    open_ = tables.keep(_open_buckets(banded), "open")

    candidates = open_.select("doc_id").distinct()
    sets = _sets(docs.join(candidates, "doc_id", "left_semi"), p).dropDuplicates(["doc_id", "tag"])
    sets = tables.keep(sets, "sets")
    signed = open_.join(sets.select("doc_id", "tag", "bands", *_signature(p)), ["doc_id", "tag"])
    live, seen = tables.keep_counted(signed, "live0")
    tables.drop("open")
    columns = live.columns
    quick = reduce(Column.__add__, [_differ(F.col(s), F.col(f"c_{s}")) for s in _signature(p)[:-1]])
    whole = F.aggregate(F.zip_with("more", "c_more", _differ), quick, lambda a, x: a + x)
    part = F.pmod(F.xxhash64("doc_id", "tag"), F.col("parts")).cast("int")
    centres, turn = 1, 0
    while seen["rows"]:
        order = Window.partitionBy("key").orderBy("doc_id", "tag")
        chosen = (
            live.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= centres)
            .select("key", "parts", F.col("doc_id").alias("lo"), F.col("tag").alias("lo_tag"),
                    F.col("component_id").alias("of_lo"), F.col("bands").alias("c_bands"),
                    *[F.col(s).alias(f"c_{s}") for s in _signature(p)])
        )
        chosen = tables.keep(chosen, f"centres{turn}")
        dealt = chosen.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        similar = (
            live.withColumn("part", part).drop("parts")
            .join(
                dealt.drop("parts").withColumnsRenamed({"key": "k", "part": "c_part"}),
                (F.col("key") == F.col("k"))
                & (F.col("part") == F.col("c_part"))
                & (F.col("doc_id") > F.col("lo"))
                & (F.col("component_id") != F.col("of_lo"))
                & (quick <= p.most_different(p.quick_longs))
                & (whole <= p.most_different(p.longs))
                & (F.array_min(F.array_intersect("bands", "c_bands")) == F.shiftrightunsigned("key", 33).cast("int")),
            )
            .select("lo", "lo_tag", "of_lo", F.col("doc_id").alias("hi"), F.col("tag").alias("hi_tag"),
                    F.col("component_id").alias("of_hi"))
            .distinct()
        )
        links, linked = tables.keep_counted(_linked(similar, sets, p.percent), f"links{turn}")
        turn += 1
        if linked["rows"]:
            merged = components(links, tables)
            into = merged.select(F.col("doc_id").alias("component_id"), F.col("component_id").alias("into"))
            moved = found.join(into, "component_id", "left").select("doc_id", F.coalesce("into", "component_id").alias("component_id"))
            found = tables.keep(moved.unionByName(merged), f"found{turn}")
        last = chosen.groupBy("key").agg(F.max(F.struct("lo", "lo_tag")).alias("last"))
        rest = (
            live.drop("component_id", "parts").join(last, "key")
            .where(F.struct("doc_id", "tag") > F.col("last")).drop("last")
        )
        live, seen = tables.keep_counted(_open_buckets(_labelled(rest, found)).select(columns), f"live{turn}")
        tables.drop(f"live{turn - 1}", f"centres{turn - 1}", f"links{turn - 1}")
        centres *= GROWTH
    found = tables.keep(found, "found")
    tables.drop(*[name for name in tables.paths if name not in ("sketches", "found")])
    return sketches.select("doc_id", "n_shingles"), found


def near_duplicates(
    spark: SparkSession, docs: DataFrame, p: NearDedup = NearDedup()
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Texts lower-case A-Z. Fewer words than a shingle make one shingle; a document
    without words (empty or null text) has none and is linked with nothing. Equal sets
    count as equal when their 128-bit fingerprints do. A repeated row is repeated in the
    result; rows that share an id are one node, linked if any of them is, and report the
    largest of their sets. A null id is linked with nothing: component_id null, kept true.
    An empty table gives an empty result; other columns are ignored.
    """
    tables = Tables(spark, "near")
    sizes, found = link(docs, tables, p)
    sizes = sizes.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    return (
        docs.select(F.col("doc_id").cast(T.LongType()))
        .join(sizes, "doc_id", "left")
        .join(found, "doc_id", "left")
        .select(
            "doc_id",
            F.coalesce("n_shingles", F.lit(0).cast("long")).alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def unique(spark: SparkSession, docs: DataFrame, p: NearDedup = NearDedup()) -> DataFrame:
    """The documents kept, with the columns given. Of rows that share an id one stays, the
    same in every run; rows with a null id, and documents without words, all stay."""
    tables = Tables(spark, "near")
    _, found = link(docs, tables, p)
    gone = found.select(F.col("doc_id").alias("gone"))
    rows = docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return rows
    order = [F.xxhash64(*docs.columns), F.xxhash64(F.lit(1), *docs.columns)]
    return keep_first(rows.where("doc_id IS NOT NULL"), ["doc_id"], order).unionAll(rows.where("doc_id IS NULL"))
