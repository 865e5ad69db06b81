"""Documents that contain benchmark items, exactly or with a few edits.

Q-gram lemma filtering: a text within k edits of an item of m characters shares at least
m + 1 - q * (k + 1) q-grams with it, all within k diagonals of each other. So

1. the q-grams of the items, an index of bounded size, are looked up in every document;
2. hits are counted in overlapping bands of diagonals, each as wide as twice the budget;
3. bands that reach the bound of the lemma are verified by banded alignment.

Characters are UTF-8 bytes of the text with runs of white space as one space and the
capitals of A-Z and Latin-1 in lower case, so that re-wrapped or re-cased passages match.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import _LOWER, _SPACE, Step, steps, texts

_SCREEN_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Decontamination:
    """``percent``: edits allowed for 100 characters of an item. The budget of an item
    shorter than about ten q-grams shrinks until the lemma still filters; one shorter
    than ``q`` characters is too short to be told from ordinary text and never reported.
    ``items_at_once`` bounds what is broadcast: that many items of the table at a time."""

    q: int = 8
    percent: int = 10
    items_at_once: int = 4000

    def budget(self, length: int) -> int:
        return max(0, min(length * self.percent // 100, length // self.q - 1))


def _normal(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes and the place of each in ``data``."""
    space = _SPACE[data]
    keep = np.ones(len(data), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    places = np.flatnonzero(keep)
    folded = _LOWER[data[places]]
    folded[space[places]] = 32
    # Latin-1 capitals are the byte C3 and one of 80 to 9E, but for the sign 97.
    second = np.flatnonzero(folded[:-1] == 0xC3) + 1
    second = second[(folded[second] >= 0x80) & (folded[second] <= 0x9E) & (folded[second] != 0x97)]
    folded[second] += 32
    return folded, places


def _codes(data: np.ndarray) -> np.ndarray:
    """Every run of 8 bytes as one number."""
    one = data.astype(np.uint64)
    two = (one[:-1] << np.uint64(8)) | one[1:]
    four = (two[:-2] << np.uint64(16)) | two[2:]
    return (four[:-4] << np.uint64(32)) | four[4:]


class Index:
    """Postings of the items' q-grams: item and place for every occurrence."""

    def __init__(self, items: list[tuple[int, str]], p: Decontamination):
        if p.q != 8:
            raise ValueError("q-grams are eight bytes, one machine word")
        self.ids, self.items, self.edits, self.least = [], [], [], []
        codes, owners, places = [], [], []
        for item_id, text in items:
            folded, _ = _normal(np.frombuffer((text or "").strip().encode(), np.uint8))
            if len(folded) < p.q:
                continue
            k = p.budget(len(folded))
            found = _codes(folded)
            codes.append(found)
            owners.append(np.full(len(found), len(self.ids)))
            places.append(np.arange(len(found)))
            self.ids.append(item_id)
            self.items.append(folded)
            self.edits.append(k)
            self.least.append(len(folded) + 1 - p.q * (k + 1))
        empty = np.empty(0, np.int64)
        codes = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.first = np.unique(codes[order], return_index=True)
        self.first = np.append(self.first, len(codes))
        self.owner = (np.concatenate(owners) if len(codes) else empty)[order]
        self.place = (np.concatenate(places) if len(codes) else empty)[order]
        self.edits, self.least = np.array(self.edits, np.int64), np.array(self.least, np.int64)
        self.screen = np.zeros(1 << _SCREEN_BITS, bool)
        self.screen[self._slot(self.codes)] = True

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * _SPREAD) >> np.uint64(64 - _SCREEN_BITS)

    def bands(self, folded: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, lowest diagonal, highest diagonal) of bands that reach the bound.

        ``bounds`` has the place of each document's first folded byte, and the end. A
        diagonal is a place in the document less a place in the item.
        """
        if len(folded) < 8 or not len(self.codes):
            return
        codes = _codes(folded)
        at = np.flatnonzero(self.screen[self._slot(codes)])
        gram = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        real = self.codes[gram] == codes[at]
        at, gram = at[real], gram[real]
        doc = np.searchsorted(bounds, at, "right") - 1
        inside = at + 8 <= bounds[doc + 1]
        at, gram, doc = at[inside], gram[inside], doc[inside]
        # A document with fewer hits than the least bound has no band.
        enough = (np.bincount(doc, minlength=len(bounds)) >= self.least.min())[doc]
        at, gram, doc = at[enough], gram[enough], doc[enough]
        counts = self.first[gram + 1] - self.first[gram]
        total = np.cumsum(counts)
        if not len(total):
            return
        posting = np.arange(total[-1]) + np.repeat(self.first[gram] - (total - counts), counts)
        owner = self.owner[posting]
        diagonal = np.repeat(at, counts) - self.place[posting] + (1 << 20)
        width = self.edits[owner] + 1
        band = diagonal // width
        doc = np.repeat(doc, counts)
        base = (doc * len(self.ids) + owner) << 32
        keys, hits = np.unique(base + band, return_counts=True)
        # Two neighbouring cells of k + 1 diagonals make a band; bands overlap by a cell.
        after = np.searchsorted(keys, keys + 1)
        joined = hits.copy()
        known = after < len(keys)
        known[known] = keys[after[known]] == keys[known] + 1
        joined[known] += hits[after[known]]
        pair = keys >> 32
        owner = pair % len(self.ids)
        strong = joined >= self.least[owner]
        low = (keys & 0xFFFFFFFF) * (self.edits[owner] + 1) - (1 << 20)
        last: list[int] | None = None
        for doc, item, start in zip(
            (pair[strong] // len(self.ids)).tolist(), owner[strong].tolist(), low[strong].tolist()
        ):
            end = start + 2 * (int(self.edits[item]) + 1) - 1
            if last and last[0] == doc and last[1] == item and start <= last[3] + 1:
                last[3] = end
            else:
                if last:
                    yield tuple(last)
                last = [doc, item, start, end]
        if last:
            yield tuple(last)

    def matches(self, step: Step) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item id, first byte, end byte, edits) of the verified passages of a step.

        The nearest alignment of each band; of equal ones the first end.
        """
        folded, places = _normal(step.data)
        # A space that ends one document is folded apart from one that starts the next.
        bounds = np.searchsorted(places, step.offsets)
        for doc, item, low, high in self.bands(folded, bounds):
            pattern, k = self.items[item], int(self.edits[item])
            first, end = int(bounds[doc]), int(bounds[doc + 1])
            region = folded[max(first, low - k) : min(end, high + k + len(pattern))]
            at = region.tobytes().find(pattern.tobytes())
            if at >= 0:
                found = (max(first, low - k) + at, max(first, low - k) + at + len(pattern), 0)
            elif len(region) < 8 or np.isin(_codes(pattern), _codes(region)).sum() < self.least[item]:
                continue  # hits of the band were repeats: too few places of the item are covered
            else:
                found = banded(pattern, folded, first, end, low - k, high + k, k)
            if found:
                start, end, edits = found
                first = int(places[start]) - int(step.offsets[doc])
                last = int(places[end - 1]) + 1 - int(step.offsets[doc])
                yield step.first + doc, self.ids[item], first, last, edits


def banded(
    pattern: np.ndarray, text: np.ndarray, first: int, end: int, low: int, high: int, budget: int
) -> tuple[int, int, int] | None:
    """The best alignment of the whole pattern within text[first:end] on diagonals low to high.

    Returns (start, end, edits), or None if it takes more than ``budget`` edits. A row of
    the table holds one cell for each diagonal; insertions along a row are a running
    minimum. Starts travel along with the distances.
    """
    width = high - low + 1
    diagonals = np.arange(low, high + 1)
    far = len(pattern) + width + 1
    slots = np.arange(width)
    inside = (diagonals >= first) & (diagonals <= end)
    cost = np.where(inside, 0, far)
    start = diagonals.copy()
    padded = np.append(text, np.uint8(0))
    for j, letter in enumerate(pattern):
        column = diagonals + j  # the text's letter this step would take
        usable = (column >= first) & (column < end)
        same = usable & (padded[np.where(usable, column, len(text))] == letter)
        step = np.where(usable, cost + ~same, far)
        skip = np.append(cost[1:] + 1, far)  # a letter of the pattern left out
        take = step <= skip
        new = np.where(take, step, skip)
        origin = np.where(take, start, np.append(start[1:], 0))
        # Letters of the text left out: the nearest cell to the left, a running minimum.
        run = np.minimum.accumulate((new - slots) * width + slots)
        source = run % width
        cost = (run - source) // width + slots
        start = origin[source]
    ends = diagonals + len(pattern)
    cost = np.where((ends >= first) & (ends <= end), cost, far)
    best = int(np.argmin(cost))
    edits = int(cost[best])
    return (int(start[best]), int(ends[best]), edits) if edits <= budget else None


def _blocks(spark: SparkSession, benchmark: DataFrame, p: Decontamination) -> Iterator[Index]:
    """Indexes over at most about ``items_at_once`` items each."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    blocks = max(1, -(-items.count() // p.items_at_once))
    for k in range(blocks):
        chosen = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        yield Index(sorted(tuple(r) for r in chosen.collect()), p)


MATCHES = "doc_id long, item_id long, start long, end long, edits long"


def matches(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, p: Decontamination = Decontamination()
) -> DataFrame:
    """One row per passage: doc_id, item_id, start, end (code points, end exclusive), edits.

    Empty and null texts and items match nothing; equal items are reported each; repeated
    rows of documents repeat their matches; a null doc_id is kept as null, a null item_id
    is passed over. Empty tables give an empty result. Other columns are ignored.
    """

    def search(shared) -> Callable:
        def run(batches):
            index = shared.value
            for batch in batches:
                ids, rows = batch.column(0), []
                for step in steps(batch.column(1)):
                    for row, item, first, last, edits in index.matches(step):
                        low = int(step.offsets[row - step.first])
                        # Continuation bytes are no code points of their own.
                        lead = (step.data[low : low + last] & 0xC0) != 0x80
                        start = int(lead[:first].sum())
                        rows.append((ids[row].as_py(), item, start, start + int(lead[first:].sum()), edits))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in zip(*rows)],
                        names=["doc_id", "item_id", "start", "end", "edits"],
                    )

        return run

    source = texts(docs, "doc_id")
    parts = [
        source.mapInArrow(search(spark.sparkContext.broadcast(index)), MATCHES)
        for index in _blocks(spark, benchmark, p)
    ]
    return reduce(DataFrame.unionAll, parts)


def clean(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, p: Decontamination = Decontamination()
) -> DataFrame:
    """The documents without any benchmark item, with the columns given.

    Rows pass through one scan and are never shuffled. Nulls and repeated rows as in
    ``matches``; a document that matches nothing stays.
    """

    def keep(shared, at: int) -> Callable:
        def run(batches):
            index = shared.value
            for batch in batches:
                good = np.ones(batch.num_rows, bool)
                for step in steps(batch.column(at)):
                    for row, *_ in index.matches(step):
                        good[row] = False
                columns = batch.columns[:at]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:at]).filter(pa.array(good))

        return run

    schema = docs.schema
    out = docs
    for index in _blocks(spark, benchmark, p):
        # Under a name of its own, should the table have a column like it.
        bytes_too = out.select("*", F.col("text").cast("binary").alias("text as bytes"))
        out = bytes_too.mapInArrow(keep(spark.sparkContext.broadcast(index), len(schema)), schema)
    return out
