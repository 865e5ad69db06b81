"""Toxicity by logistic regression: hashed word n-grams and skip-grams, FTRL-proximal.

Labelled rows are split by a hash into shards; each is one task that runs over its rows a
few times with per-coordinate rates and L1 sparsity, and the shards' weights are averaged.
The result has at most one weight for each slot of a table of fixed size, most of them
zero, so it may be broadcast whatever the corpus. All documents are then scored in one
pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import GRAM, MARKS, Step, Tables, mix, steps, texts


@dataclass(frozen=True)
class Toxicity:
    """``sample`` bounds the labelled rows that are learned from, drawn by a hash of their
    id, ``shard_rows`` those of one task. A crc32 of the id that leaves no remainder by
    ``folds`` is held out."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.1
    epochs: int = 4
    sample: int = 40_000
    shard_rows: int = 10_000
    folds: int = 5


def remainder(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def slots(step: Step, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and slot of every feature of a step: words, pairs of neighbours, and pairs
    with one word between; A-Z in lower case, punctuation no part of a word."""
    step.words(MARKS)
    words = step.hashes(lower=True)
    n = np.diff(step.bounds)
    doc = np.repeat(np.arange(len(n)), n)
    shift = np.uint64(64 - bits)
    found_doc, found = [doc], [mix(words + GRAM[40]) >> shift]
    for gap in (1, 2):
        if len(words) > gap:
            same = doc[gap:] == doc[:-gap]
            pairs = words[:-gap] * GRAM[40 + gap] + words[gap:] * GRAM[50 + gap]
            found.append(mix(pairs[same]) >> shift)
            found_doc.append(doc[gap:][same])
    return np.concatenate(found_doc), np.concatenate(found).astype(np.int64)


class Ftrl:
    """State of one learner; slot ``size`` is the bias, which is not shrunk."""

    def __init__(self, p: Toxicity):
        self.p, self.size = p, 1 << p.bits
        self.z, self.n = np.zeros(self.size + 1), np.zeros(self.size + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        least = np.where(at == self.size, 0.0, self.p.l1)
        rate = (self.p.beta + np.sqrt(n)) / self.p.alpha + self.p.l2
        return np.where(np.abs(z) <= least, 0.0, -(z - np.sign(z) * least) / rate)

    def learn(self, at: np.ndarray, label: int) -> None:
        """One row; ``at`` are its distinct slots with the bias."""
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.p.alpha * w
        self.n[at] += g * g


def _labelled(docs: DataFrame, labels: DataFrame, p: Toxicity) -> DataFrame:
    """(label, h, slots) of the sample; an id with several labels counts as toxic if one says so."""
    chosen = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(remainder(F.col("doc_id"), p.folds) != 0)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("label"))
        .withColumn("h", F.xxhash64("doc_id"))
        .orderBy("h", "doc_id")
        .limit(p.sample)
    )

    def run(batches):
        for batch in batches:
            for step in steps(batch.column(2)):
                doc, slot = slots(step, p.bits)
                rows = step.last - step.first
                pairs = np.unique((doc << p.bits) | slot)
                ends = np.searchsorted(pairs, np.arange(1, rows) << p.bits)
                own = np.split(pairs & ((1 << p.bits) - 1), ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(step.first, rows),
                        batch.column(1).slice(step.first, rows),
                        pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32())),
                    ],
                    names=["label", "h", "slots"],
                )

    # At most ``sample`` ids with their labels.
    joined = texts(docs, "doc_id").join(F.broadcast(chosen), "doc_id").select("label", "h", "text")
    return joined.mapInArrow(run, "label int, h long, slots array<int>")


def train(docs: DataFrame, labels: DataFrame, tables: Tables, p: Toxicity) -> np.ndarray:
    """Averaged weights, the bias last; all zero without labelled rows."""
    rows = tables.keep(_labelled(docs, labels, p), "rows")
    shards = max(1, -(-rows.count() // p.shard_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = []
        for batch in batches:
            # Slots stay in arrays: as Python numbers a shard's rows would take ten times the memory.
            ends = batch.column("slots").offsets.to_numpy()
            slot = batch.column("slots").values.to_numpy()
            for k, (label, h) in enumerate(zip(batch.column("label").to_pylist(), batch.column("h").to_pylist())):
                own.append((h, label, slot[ends[k] : ends[k + 1]].copy()))
        own.sort(key=lambda r: r[:2])
        model = Ftrl(p)
        for _ in range(p.epochs):
            for _, label, slot in own:
                model.learn(np.append(slot, model.size), label)
        at = np.flatnonzero(model.n)
        w = model.weights(at)
        at, w = at[w != 0], w[w != 0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w)], names=["slot", "weight"])

    # A group is a shard, whatever tasks Spark deals them to.
    learned = (
        rows.withColumn("shard", F.pmod("h", F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(run, "slot long, weight double")
    )
    learners = rows.select(F.pmod("h", F.lit(shards))).distinct().count()
    # One row for each slot of the table at most.
    found = learned.groupBy("slot").agg((F.sum("weight") / max(learners, 1)).alias("weight")).toArrow()
    weights = np.zeros((1 << p.bits) + 1, np.float32)
    weights[found["slot"].to_numpy()] = found["weight"].to_numpy()
    tables.drop("rows")
    return weights


def score(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, p: Toxicity = Toxicity()
) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Only words are scored: labels, language, source and id are no features. A null or empty text
    scores the bias alone. Rows that share an id or repeat are scored each for itself; a
    null id counts as held out. Without labels every score is 0.5. Other columns are
    ignored, and an empty table gives an empty result.
    """
    shared = spark.sparkContext.broadcast(train(docs, labels, Tables(spark, "toxicity"), p))

    def run(batches):
        weights = shared.value
        for batch in batches:
            scores = []
            for step in steps(batch.column(2)):
                doc, slot = slots(step, p.bits)
                live = np.flatnonzero(weights[slot])
                pairs = np.unique((doc[live] << p.bits) | slot[live])
                sums = np.bincount(
                    pairs >> p.bits, weights[pairs & ((1 << p.bits) - 1)], step.last - step.first
                ) + float(weights[-1])
                scores.append(1 / (1 + np.exp(-np.clip(sums, -35, 35))))
            scores = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    held_out = F.coalesce(remainder(F.col("doc_id"), p.folds) == 0, F.lit(True)).alias("held_out")
    source = docs.select(F.col("doc_id").cast("long"), held_out, F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
