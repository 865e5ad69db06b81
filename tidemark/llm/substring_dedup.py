"""Passages that already occur in a document with a smaller id, by seed and extend.

A passage of ``length`` words is long enough to count. Winnowing selects, of every
``length - seed + 1`` neighbouring seeds (runs of ``seed`` words), the one with the least
hash, so any two equal passages have an equal selected seed in the same place: an anchor.

1. Seed: anchors are joined on their hash. One whose hash occurs in one document only
   cannot lie in a shared passage and goes.
2. Extend: around an anchor that stays, every passage it is the anchor of is looked up,
   to the left and to the right, and compared as a whole. Passages are grouped, so the
   smallest document of each is found without forming pairs of documents, however many
   share it.
3. Keep maximal repeats: passages found in a smaller document are joined where they
   overlap or touch; their words are the maximal repeats of at least ``length`` words.

Whole copies of a document are found first by the hash of all their words, and only the
one with the smallest id takes part in 1 to 3.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import GRAM, Step, Tables, mix, steps, texts


@dataclass(frozen=True)
class SubstringDedup:
    """Words of a passage, and of the seeds that are looked for in it."""

    length: int = 13
    seed: int = 6

    @property
    def window(self) -> int:
        return self.length - self.seed + 1


def anchors(step: Step, words: np.ndarray, p: SubstringDedup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and document of each anchor of a step, and for each passage of the
    step the place of its anchor: the leftmost of the least seed hashes."""
    seeds, _ = step.grams(words, p.seed)
    # Place of each document's seeds and passages among all runs of words.
    n = np.diff(step.bounds)
    whole = np.full(max(len(words), 1), np.uint64(0xFFFFFFFFFFFFFFFF))
    own = np.maximum(n - p.seed + 1, 0)
    at = np.arange(own.sum()) + np.repeat(step.bounds[:-1] - (np.cumsum(own) - own), own)
    whole[at] = seeds
    starts, _ = passages(step, p)
    least = whole[starts]
    where = starts.copy()
    for k in range(1, p.window):
        smaller = whole[starts + k] < least
        least = np.where(smaller, whole[starts + k], least)
        where = np.where(smaller, starts + k, where)
    return whole, starts, where


def passages(step: Step, p: SubstringDedup) -> tuple[np.ndarray, np.ndarray]:
    """First word of each passage, counted through the step, and its document."""
    own = np.maximum(np.diff(step.bounds) - p.length + 1, 0)
    doc = np.repeat(np.arange(len(own)), own)
    starts = np.arange(own.sum()) + np.repeat(step.bounds[:-1] - (np.cumsum(own) - own), own)
    return starts, doc


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _whole_hash(step: Step, words: np.ndarray, salt: int) -> np.ndarray:
    """A hash of the sequence of all words of each document of a step."""
    n = np.diff(step.bounds)
    place = (np.arange(len(words)) - np.repeat(step.bounds[:-1], n)).astype(np.uint64)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(words + mix(place + np.uint64(salt))), out=total[1:])
    return total[step.bounds[1:]] - total[step.bounds[:-1]]


def _tags(step: Step, words: np.ndarray) -> np.ndarray:
    """What tells apart the texts of rows that share an id."""
    return _whole_hash(step, words, 1).view(np.int64)


def _prints(docs: DataFrame, p: SubstringDedup) -> DataFrame:
    """(doc_id, n_words, a, b): two hashes of the sequence of all words; ``a`` is the tag."""

    def run(batches):
        for batch in batches:
            for step in steps(batch.column(1)):
                step.words()
                words = step.hashes()
                n = np.diff(step.bounds)
                sums = [_whole_hash(step, words, salt) for salt in (1, 1 << 40)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(step.first, len(n)).cast(pa.int64()),
                        pa.array(n.astype(np.int64)),
                        _long(sums[0]),
                        _long(sums[1]),
                    ],
                    names=["doc_id", "n_words", "a", "b"],
                )

    return texts(docs, "doc_id").mapInArrow(run, "doc_id long, n_words long, a long, b long")


def _anchor_rows(docs: DataFrame, p: SubstringDedup) -> DataFrame:
    """(seed, doc_id, a): each anchor hash of a row once, with the row's tag."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for step in steps(batch.column(1)):
                step.words()
                words = step.hashes()
                whole, starts, where = anchors(step, words, p)
                tags = _tags(step, words)
                at = np.unique(where)
                doc = np.searchsorted(step.bounds, at, "right") - 1
                # A word said over and over gives one seed many times.
                order = np.lexsort((whole[at], doc))
                at, doc = at[order], doc[order]
                new = np.ones(len(at), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (whole[at[1:]] != whole[at[:-1]])
                at, doc = at[new], doc[new]
                yield pa.RecordBatch.from_arrays(
                    [_long(whole[at]), pa.array(ids[step.first + doc].astype(np.int64)), pa.array(tags[doc])],
                    names=["seed", "doc_id", "a"],
                )

    return texts(docs, "doc_id").mapInArrow(run, "seed long, doc_id long, a long")


def _passage_rows(docs: DataFrame, p: SubstringDedup) -> DataFrame:
    """(a, b, doc_id, tag, places) of the passages around anchors; ``docs`` has the text and
    the array ``seeds`` of the anchor hashes of its id that others have too."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for step in steps(batch.column(1)):
                step.words()
                words = step.hashes()
                whole, starts, where = anchors(step, words, p)
                tags = _tags(step, words)
                _, doc = passages(step, p)
                shared = np.zeros(len(words), bool)
                for k in range(len(step.offsets) - 1):
                    own = np.array(batch.column(2)[step.first + k].as_py() or [], np.int64)
                    low, high = step.bounds[k], step.bounds[k + 1]
                    shared[low:high] = np.isin(whole[low:high].view(np.int64), own)
                some = shared[where] if len(where) else np.zeros(0, bool)
                starts, doc = starts[some], doc[some]
                a = np.zeros(len(starts), np.uint64)
                b = np.zeros(len(starts), np.uint64)
                for k in range(p.length):
                    a += words[starts + k] * GRAM[k]
                    b += mix(words[starts + k] + GRAM[p.length + k]) * GRAM[k + 1]
                # One row for a passage of a document, with all its places.
                order = np.lexsort((starts, b, a, doc))
                a, b, doc, starts = a[order], b[order], doc[order], starts[order]
                new = np.ones(len(a), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                first = np.flatnonzero(new)
                places = pa.ListArray.from_arrays(
                    pa.array(np.append(first, len(a)).astype(np.int32)),
                    pa.array((starts - step.bounds[doc]).astype(np.int32)),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        _long(mix(a[first])),
                        _long(mix(b[first])),
                        pa.array(ids[step.first + doc[first]].astype(np.int64)),
                        pa.array(tags[doc[first]]),
                        places,
                    ],
                    names=["a", "b", "doc_id", "tag", "places"],
                )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), "seeds").mapInArrow(
        run, "a long, b long, doc_id long, tag long, places array<int>"
    )


def repeats(docs: DataFrame, tables: Tables, p: SubstringDedup) -> tuple[DataFrame, DataFrame]:
    """Copies (doc_id, a) removed as a whole, and (doc_id, found): for each of its texts, by
    tag, where passages start that a smaller document has."""
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    prints = tables.keep(_prints(docs, p), "prints")
    first = prints.where(F.col("n_words") >= p.length).groupBy("a", "b", "n_words").agg(F.min("doc_id").alias("least"))
    copies = (
        prints.join(first, ["a", "b", "n_words"]).where("doc_id > least").select("doc_id", "a").distinct()
    )
    copies = tables.keep(copies, "copies")

    # Dealt by hash once: the aggregate and the join after it read the same shuffle.
    # Tags have done their part before the shuffle.
    found = _anchor_rows(docs, p).join(copies, ["doc_id", "a"], "left_anti").drop("a").repartition("seed")
    common = (
        found.groupBy("seed")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most")
        .select("seed")
    )
    seeds = found.join(common, "seed").groupBy("doc_id").agg(F.collect_set("seed").alias("seeds"))
    seeds = tables.keep(seeds, "seeds")
    tables.drop("prints")

    rows = _passage_rows(docs.join(seeds, "doc_id"), p).repartition("a", "b")
    owners = (
        rows.groupBy("a", "b")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most")
        .drop("most")
    )
    later = rows.join(owners, ["a", "b"]).where("doc_id > least")
    places = later.groupBy("doc_id", "tag").agg(F.flatten(F.collect_list("places")).alias("places"))
    places = places.groupBy("doc_id").agg(F.collect_list(F.struct("tag", "places")).alias("found"))
    return copies, tables.keep(places, "places")


def _cut(p: SubstringDedup, texts_too: bool):
    """Arrow batches of (doc_id, text, found, copies) to the rows of the result."""

    def tag_of(text: pa.Array) -> int:
        (step,) = steps(text)
        step.words()
        return int(_tags(step, step.hashes())[0])

    def run(batches):
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                words = (batch.column(1)[k].as_py() or b"").split()
                keep = np.ones(len(words) + 1, np.int32)
                found, copies = batch.column(2)[k].as_py(), batch.column(3)[k].as_py()
                tag = tag_of(batch.column(1).slice(k, 1)) if found or copies else None
                places = [x for f in found or () if f["tag"] == tag for x in f["places"]]
                if tag in (copies or ()):
                    keep[:] = 0
                elif places:
                    # Runs of covered words: passages that overlap or touch are one repeat.
                    cover = np.zeros(len(words) + p.length + 1, np.int32)
                    np.add.at(cover, places, 1)
                    np.add.at(cover, np.array(places) + p.length, -1)
                    keep = (np.cumsum(cover)[: len(words) + 1] <= 0).astype(np.int32)
                removed = len(words) - int(keep[: len(words)].sum())
                kept = b" ".join([w for w, x in zip(words, keep.tolist()) if x] if removed else words)
                digest = hashlib.sha256(kept).hexdigest()
                row = (batch.column(0)[k].as_py(), len(words), removed, digest)
                rows.append((*row, kept.decode("utf-8", "replace")) if texts_too else row)
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return run


def without_repeats(
    spark: SparkSession, docs: DataFrame, p: SubstringDedup = SubstringDedup(), texts_too: bool = False
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row of ``docs``; with
    ``texts_too`` also kept_text, the kept words joined by one space.

    A null or empty text has no words. A null doc_id is compared with nothing and keeps
    all words. Rows that share an id are one document for each other, so nothing is
    removed from one for the sake of another; but a passage that a smaller id has is
    removed from each that has it. An empty table gives an empty result; other columns are ignored.
    """
    tables = Tables(spark, "substring")
    copies, places = repeats(docs, tables, p)
    tags = copies.groupBy("doc_id").agg(F.collect_list("a").alias("copies"))
    joined = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
        .join(places, "doc_id", "left")
        .join(tags, "doc_id", "left")
        .select("doc_id", "text", "found", "copies")
    )
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return joined.mapInArrow(_cut(p, texts_too), schema + (", kept_text string" if texts_too else ""))
