"""Helpers the operators share: word spans and hashes of whole Arrow batches, stored tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.config import hadoop_path, scratch_path

# Java regular expression of a word and of the white space between words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

# Bytes of text that one step of vector code handles; a longer document is a step of its own.
STEP_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# White space and ASCII punctuation.
MARKS = _SPACE.copy()
MARKS[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SEEDED = np.random.Generator(np.random.PCG64(20240917))
_BYTE = _SEEDED.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_SEEDED.integers(1 << 62, 1 << 63)) * 2 + 1
GRAM = _SEEDED.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2^64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = base & 0xFFFFFFFFFFFFFFFF
    return np.multiply.accumulate(out, dtype=np.uint64)


_POWER = _powers(_BASE, STEP_BYTES + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), STEP_BYTES + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts(docs: DataFrame, *ids: str) -> DataFrame:
    """The id columns and the text as bytes."""
    return docs.select(*ids, F.col("text").cast("binary").alias("text"))


class Step:
    """Some documents of a batch, their bytes in one array.

    ``first`` and ``last`` are row numbers within the batch; ``offsets`` has the place
    of each document's first byte, and the end.
    """

    def __init__(self, first: int, last: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.last, self.data, self.offsets = first, last, data, offsets

    def words(self, between: np.ndarray = _SPACE) -> None:
        """Find the words: ``starts`` and ``ends`` in bytes, ``bounds`` of each document's words.
        ``between`` tells which bytes are none of a word."""
        space = between[self.data]
        edge = np.ones(len(space) + 1, bool)
        edge[1:] = space
        edge[self.offsets] = True
        self.starts = np.flatnonzero(edge[:-1] & ~space)
        edge[:-1] = space
        edge[self.offsets] = True
        self.ends = np.flatnonzero(edge[1:] & ~space) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One 64-bit polynomial hash for each word."""
        n = len(self.data)
        power, inverse = _POWER, _INVERSE
        if n > STEP_BYTES:
            power, inverse = _powers(_BASE, n + 1), _powers(pow(_BASE, -1, 1 << 64), n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((_BYTE[_LOWER] if lower else _BYTE)[self.data] * power[:n], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * inverse[self.starts])

    def grams(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of runs of ``n`` words, and the bounds of each document's runs."""
        runs = len(words) - n + 1
        counts = np.maximum(np.diff(self.bounds) - n + 1, 0)
        bounds = np.concatenate(([0], np.cumsum(counts)))
        if runs <= 0:
            return np.empty(0, np.uint64), bounds
        total = np.zeros(runs, np.uint64)
        for k in range(n):
            total += words[k : k + runs] * GRAM[k]
        places = np.arange(bounds[-1]) + np.repeat(self.bounds[:-1] - bounds[:-1], counts)
        return mix(total[places]), bounds


def steps(column: pa.Array, limit: int = STEP_BYTES) -> Iterator[Step]:
    """Cut a binary column into steps of at most ``limit`` bytes, or one document; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, b"")
    if not len(column):
        return
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        low, high = offsets[first], offsets[last]
        yield Step(first, last, data[low:high], offsets[first : last + 1] - low)
        first = last


class Tables:
    """Intermediate tables in the shared folder; they outlive any executor."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back, which cuts its lineage."""
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.option("compression", "zstd").parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_counted(self, df: DataFrame, name: str, **sums: Column) -> tuple[DataFrame, dict]:
        """``keep``, and what the write saw: ``rows`` and the sums given. ``df`` should end in
        a shuffle, so that only the tasks that write are counted, each once."""
        seen = Observation()
        made = [F.coalesce(F.sum(value), F.lit(0)).alias(label) for label, value in sums.items()]
        kept = self.keep(df.observe(seen, F.count(F.lit(1)).alias("rows"), *made), name)
        return kept, dict(seen.get)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            for text in self.paths.pop(name, ()):
                path, fs = hadoop_path(self.spark, text)
                fs.delete(path, True)


# Rows of one key above which ``attach`` does not send them to one task.
HOT_ROWS = 100_000


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Join ``facts``, one row for each key with the ``count`` of its rows, to ``rows``.

    Keys with very many rows are broadcast: there is at most one for every ``HOT_ROWS``
    rows. All others meet in an ordinary join.
    """
    hot = F.broadcast(facts.where(F.col(count) > HOT_ROWS).drop(count))
    cold = facts.where(F.col(count) <= HOT_ROWS).drop(count)
    few = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return rows.join(hot, keys).unionByName(few)
