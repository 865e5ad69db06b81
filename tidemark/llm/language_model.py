"""Log probabilities of texts by an n-gram model in shards of an Elias-Fano trie.

Every word of the training rows, and every pair and triple seen at least ``least`` times, is
in the model; how many shards it has follows from the counts.

1. All words of the training rows are counted.
2. Each word of a row goes with its neighbours, as a window, to the shard of its context:
   the range the word's hash lies in. Frequent words are placed so that shards fill evenly;
   one that alone would fill a shard has several, by the word before it. Windows lie in files of the shared folder, one a task; only where
   they lie is shuffled.
3. A shard sees all windows around its words, so it counts its words, the pairs that end
   with them and the triples around them by itself. Pairs are needed where they begin,
   too; they are sent there with the count of their second word, packed by shard.
4. A task builds the trie of its shard, stores it, maps it and scores the shard's windows.
   What a row's windows gain goes back by the task's step that dealt them, in units of
   ``1 / _UNIT``. Counts of common words are known where windows are dealt; of all others
   the shard sends them back. So a window costs at most one small entry, however many
   shards its row is spread over.
5. A level is one Elias-Fano sequence: number of the context times a stride plus the
   successor, with monotone pointers to where each context's successors start. A triple's
   last word is stored relative to its shorter context: as its rank among the successors
   of the middle word. Probabilities and back-off weights have one byte, an entry of a
   table of quantiles.

Probabilities are interpolated by absolute discounting down to the smoothed counts, so
they sum to one over the known words and one unknown.
"""

from __future__ import annotations

import heapq
import os
import pickle
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import hadoop_path, scratch_path
from tidemark.llm.common import Step, Tables, mix, steps, texts
from tidemark.llm.elias_fano import EliasFano

# Stands for the end of a text, as the hash of a word does for the word.
END = np.int64(-0x123456789ABCDEF)
# Stand for what is before a text's first word and after its end.
START, NONE = np.int64(0x0F1E2D3C4B5A6978), np.int64(0x1032547698BADCFE)
# Windows a task gathers before it deals them to the shards.
_DEALT = 1 << 20
# Keys looked up at a time, so that what numpy makes of them stays in the cache.
_LOOKED_UP = 1 << 14
# What a row gains in a shard is rounded to this part of a unit; a probability has one byte.
_UNIT = 4096
# Distinct keys a task gathers before it passes them on.
_HELD = 1 << 21


@dataclass(frozen=True)
class LanguageModel:
    """About how many words, pairs and triples one shard has at most, and the discount; a row
    whose id's crc32 leaves ``out`` by ``folds`` is not learned from."""

    words: int = 1 << 18
    pairs: int = 1 << 20
    triples: int = 1 << 20
    least: int = 2
    discount: float = 0.75
    folds: int = 7
    out: int = 2


def hashes(step: Step) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all documents of a step, each with its end, and their bounds."""
    step.words()
    words = step.hashes(lower=True).view(np.int64)
    n = np.diff(step.bounds)
    bounds = np.concatenate(([0], np.cumsum(n + 1)))
    out = np.full(bounds[-1], END)
    inner = np.ones(bounds[-1], bool)
    inner[bounds[1:] - 1] = False
    out[inner] = words
    return out, bounds


def _counter(count):
    """Arrow batches to (key, n), combined within a task as far as ``_HELD`` keys go."""

    def flush(parts):
        keys = np.concatenate([k for k, _ in parts])
        n = np.concatenate([n for _, n in parts])
        keys, where = np.unique(keys, return_inverse=True)
        return keys, np.bincount(where, n, len(keys)).astype(np.int64)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for keys in count(batch):
                keys, n = np.unique(keys, return_counts=True)
                parts.append((keys, n))
                held += len(keys)
                if held > _HELD:
                    parts = [flush(parts)]
                    held = len(parts[0][0])
                    if held > _HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names=["key", "n"])
                        parts, held = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in flush(parts)], names=["key", "n"])

    return run


def _words_of(batch):
    for step in steps(batch.column(0)):
        yield hashes(step)[0]


class Trie:
    """The model, or a shard of it, which knows what follows its own words. Word numbers of
    the first level are ranks of their hashes in ascending order."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.hashes, self.counts = arrays["hashes"], arrays["counts"]
        self.levels = [EliasFano.load(arrays, f"level{k}") for k in (2, 3) if f"level{k}.low" in arrays]
        self.tokens, self.distinct = (int(x) for x in arrays["totals"])

    @classmethod
    def words(cls, hashes: np.ndarray, counts: np.ndarray, tokens: int, distinct: int) -> "Trie":
        order = np.argsort(hashes)
        return cls({"hashes": hashes[order], "counts": counts[order], "totals": np.array([tokens, distinct])})

    @property
    def stride(self) -> int:
        return max(len(self.hashes), 1)

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Word numbers, -1 outside the first level."""
        if not len(self.hashes):
            return np.full(len(words), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, at, -1)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """Smoothed log probability of words with these counts."""
        return np.log10((counts + 1) / (self.tokens + self.distinct + 1))

    def places(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Place of each pair in level 2, -1 where there is none."""
        known = np.flatnonzero((one >= 0) & (two >= 0))
        out = np.full(len(one), -1, np.int64)
        out[known] = _find(self.levels[0], one[known] * np.int64(self.stride) + two[known])
        return out

    def triple_keys(self, ab: np.ndarray, b: np.ndarray, bc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which triples have both pairs, by their places ``ab`` and ``bc``, in the trie, and
        their keys in level 3."""
        at = np.flatnonzero((ab >= 0) & (bc >= 0))
        pointers = EliasFano.load(self.arrays, "pointers")
        # Of many, each word's pointer is read once.
        starts = pointers.access(np.arange(self.stride))[b[at]] if len(at) > self.stride else pointers.access(b[at])
        return at, ab[at] * self.stride + (bc[at] - starts.astype(np.int64))

    def with_pairs(self, keys: np.ndarray, n: np.ndarray, p: LanguageModel, own: np.ndarray) -> "Trie":
        """Add level 2 from ascending keys and their counts. Pairs that do not begin with one
        of the shard's ``own`` words are contexts only; their probabilities are not asked for."""
        one, two = keys // self.stride, keys % self.stride
        level = EliasFano.of(keys, self.stride * self.stride)
        starts = np.searchsorted(one, np.arange(len(self.hashes) + 1))
        seen = np.bincount(one, n - p.discount, len(self.hashes))
        rest = np.maximum(1 - seen / np.maximum(self.counts, 1), 1e-6)
        low = 10.0 ** self.base(self.counts)[two]
        prob = (n - p.discount) / self.counts[one] + rest[one] * low
        arrays = self.arrays | level.arrays("level2")
        arrays |= EliasFano.of(starts, len(keys) + 1).arrays("pointers") | {"pair_counts": n}
        arrays |= _quantised("prob2", np.log10(prob), own[one]) | _quantised("rest1", np.log10(rest), own)
        return Trie(arrays)

    def with_triples(self, keys: np.ndarray, n: np.ndarray, p: LanguageModel) -> "Trie":
        """Add level 3. The shorter context's probability is the quantised one."""
        pair, rank = keys // self.stride, keys % self.stride
        pairs = len(self.arrays["pair_counts"])
        middle = (self.levels[0].access(pair) % np.uint64(self.stride)).astype(np.int64)
        shorter = EliasFano.load(self.arrays, "pointers").access(middle).astype(np.int64) + rank
        counts = self.arrays["pair_counts"]
        seen = np.bincount(pair, n - p.discount, pairs)
        rest = np.maximum(1 - seen / np.maximum(counts, 1), 1e-6)
        low = 10.0 ** self.value("prob2", shorter)
        prob = (n - p.discount) / counts[pair] + rest[pair] * low
        arrays = {k: v for k, v in self.arrays.items() if k != "pair_counts"}
        arrays |= EliasFano.of(keys, max(pairs, 1) * self.stride).arrays("level3")
        arrays |= _quantised("prob3", np.log10(prob)) | _quantised("rest2", np.log10(rest))
        return Trie(arrays)

    def value(self, name: str, at: np.ndarray) -> np.ndarray:
        return self.arrays[f"{name}.table"][self.arrays[f"{name}.codes"][at]].astype(np.float64)

    def gains(self, numbers: np.ndarray) -> np.ndarray:
        """What each word's log probability gains over ``base``; the first has no context.
        A number below 0 is a word outside the trie, or, at -2, no context at all."""
        before = np.concatenate(([-2], numbers[:-2])) if len(numbers) > 1 else numbers[:0]
        return np.concatenate((np.zeros(min(len(numbers), 1)), self.after(before, numbers[:-1], numbers[1:])))

    def after(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """What the log probability of words ``c`` gains over ``base`` after ``a`` and ``b``."""
        if not self.levels or not self.levels[0].n:
            return np.zeros(len(c))
        ab, bc = self.places(a, b), self.places(b, c)
        return self.gained(b, c, ab, bc, *self.triple_keys(ab, b, bc))

    def gained(self, b, c, ab, bc, at, keys) -> np.ndarray:
        """``after``, from the places of both pairs and what ``triple_keys`` makes of them."""
        out = np.zeros(len(c))
        # Back off: the rest a known context leaves, times the shorter context's.
        known = np.flatnonzero((bc < 0) & (b >= 0) & (c > -2))
        out[known] = self.value("rest1", b[known])
        found = np.flatnonzero(bc >= 0)
        out[found] = self.value("prob2", bc[found]) - self.base(self.counts[c[found]])
        if len(self.levels) > 1 and self.levels[1].n:
            place = _find(self.levels[1], keys)
            at, place = at[place >= 0], place[place >= 0]
            backed = (ab >= 0) & (c > -2)
            backed[at] = False
            out[backed] += self.value("rest2", ab[backed])
            out[at] = self.value("prob3", place) - self.base(self.counts[c[at]])
        return out

    def save(self, uri: str) -> None:
        """One file per array; each is mapped as it is."""
        system, base = _system(uri)
        system.create_dir(base, recursive=True)
        for name, values in self.arrays.items():
            with system.open_output_stream(f"{base}/{name}.{values.dtype.name}") as out:
                out.write(np.ascontiguousarray(values).tobytes())

    @classmethod
    def load(cls, uri: str) -> "Trie":
        """Memory-mapped where the folder is mounted, else read."""
        system, base = _system(uri)
        arrays = {}
        for info in system.get_file_info(pafs.FileSelector(base)):
            name, _, kind = info.base_name.rpartition(".")
            if name.startswith("."):
                continue
            if not info.size:
                arrays[name] = np.empty(0, kind)
            elif os.path.exists(info.path):
                arrays[name] = np.memmap(info.path, kind, "r")
            else:
                with system.open_input_stream(info.path) as stored:
                    arrays[name] = np.frombuffer(stored.read(), kind)
        return cls(arrays)


def _find(level: EliasFano, keys: np.ndarray) -> np.ndarray:
    """Places of keys, each looked up once, some thousands at a time."""
    keys, inverse = np.unique(keys, return_inverse=True)
    parts = [level.find(keys[k : k + _LOOKED_UP]) for k in range(0, len(keys), _LOOKED_UP)]
    return np.concatenate([*parts, np.empty(0, np.int64)])[inverse]


def _system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if ":/" in uri else (pafs.LocalFileSystem(), uri)


def _quantised(name: str, values: np.ndarray, asked: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """One byte a value: the quantile it lies in, which stands for the mean of its values.
    Where ``asked`` is given, the other values have no part in that."""
    own = values if asked is None else values[asked]
    if not len(own):
        return {f"{name}.codes": np.zeros(len(values), np.uint8), f"{name}.table": np.zeros(1, np.float32)}
    cuts = np.unique(np.quantile(own, np.linspace(0, 1, 257)[1:-1]))
    codes, of = np.searchsorted(cuts, values, "left"), np.searchsorted(cuts, own, "left")
    table = np.bincount(of, own, 256) / np.maximum(np.bincount(of, minlength=256), 1)
    return {f"{name}.codes": codes.astype(np.uint8), f"{name}.table": table.astype(np.float32)}


def held_out(p: LanguageModel) -> Column:
    """A row without an id is not learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % p.folds == p.out, F.lit(True))


@dataclass(frozen=True)
class Shards:
    """Where windows go. ``hot`` words ascend; each has ``n`` occurrences and ``parts`` shards
    from ``first`` on, of its own or, if one, perhaps a range's."""

    uri: str
    windows: str
    ranges: int
    hot: np.ndarray
    n: np.ndarray
    first: np.ndarray
    parts: np.ndarray
    tokens: int
    distinct: int

    @classmethod
    def plan(cls, spark: SparkSession, words: DataFrame, p: LanguageModel) -> "Shards":
        tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        ranges = max(1, -(-tokens // min(p.pairs, p.triples)), -(-distinct // p.words))
        uri, windows = scratch_path(spark, "trie"), scratch_path(spark, "windows")
        # Words with a millionth of all occurrences have short codes in the windows.
        common = words.where(F.col("n") >= max(p.least, tokens >> 20)).toArrow()
        keys, n = (common.column(k).to_numpy() for k in (0, 1))
        Trie.words(keys, n, tokens, distinct).save(f"{windows}/common")
        return cls(uri, windows, ranges, *_placed(keys, n, ranges, max(1, tokens // ranges)), tokens, distinct)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """Smoothed log probability of words with these counts."""
        return np.log10((counts + 1) / (self.tokens + self.distinct + 1))

    @property
    def total(self) -> int:
        return self.ranges + int(self.parts[self.first >= self.ranges].sum())

    def is_hot(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are hot, and their places among the hot ones."""
        if not len(self.hot):
            return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.hot, words), len(self.hot) - 1)
        return self.hot[at] == words, at

    def of(self, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Shards of the windows around ``words`` with these words before them."""
        out = _range(words.view(np.uint64), np.uint64(self.ranges))
        hot, at = self.is_hot(words)
        at = at[hot]
        out[hot] = self.first[at] + _range(mix(before[hot].view(np.uint64)), self.parts[at].astype(np.uint64))
        return out

    def all_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All shards of each word: places in ``words``, and shards."""
        hot, at = self.is_hot(words)
        times = np.ones(len(words), np.int64)
        first = _range(words.view(np.uint64), np.uint64(self.ranges))
        times[hot], first[hot] = self.parts[at[hot]], self.first[at[hot]]
        place = np.repeat(np.arange(len(words)), times)
        return place, first[place] + np.arange(len(place)) - (np.cumsum(times) - times)[place]

    def folder(self, shard: int) -> str:
        return self.uri if self.ranges == 1 else f"{self.uri}/{shard}"


def _range(x: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Which of equal ranges of 64 bits each ``x`` lies in."""
    return ((x >> np.uint64(32)) * ranges >> np.uint64(32)).astype(np.int64)


def _placed(words: np.ndarray, n: np.ndarray, ranges: int, share: int) -> tuple[np.ndarray, ...]:
    """Words so frequent that chance would fill shards unevenly, ascending, their counts, first
    shards and numbers of shards. Over half a ``share`` has shards of its own; the others go, most
    frequent first, to the range that has least so far. Fewer than 16 for each range."""
    hot = n > max(1, share // 16) if ranges > 1 else np.zeros(len(n), bool)
    filled = np.bincount(_range(words[~hot].view(np.uint64), np.uint64(ranges)), n[~hot], ranges)
    words, n = words[hot], n[hot]
    order = np.argsort(words)
    words, n = words[order], n[order]
    own = n > share // 2
    parts, first = np.where(own, -(-n // share), 1), np.zeros(len(n), np.int64)
    first[own] = ranges + np.cumsum(parts[own]) - parts[own]
    least = [(x, k) for k, x in enumerate(filled.tolist())]
    heapq.heapify(least)
    for k in np.flatnonzero(~own)[np.argsort(-n[~own], kind="stable")].tolist():
        size, first[k] = least[0]
        heapq.heapreplace(least, (size + int(n[k]), int(first[k])))
    return words, n, first, parts


def _packed(*arrays: np.ndarray) -> bytes:
    """Bytes of the same weight side by side, which compresses better."""
    planes = [(x.dtype.str, np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()) for x in arrays]
    data = pickle.dumps(planes, 5)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(data: bytes) -> list[np.ndarray]:
    planes = pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True))
    out = []
    for kind, x in planes:
        width = np.dtype(kind).itemsize
        out.append(np.frombuffer(np.frombuffer(x, np.uint8).reshape(width, len(x) // width).T.tobytes(), kind))
    return out


def _common(shards: Shards) -> tuple[Trie, np.ndarray]:
    """Common words, and their numbers by descending count."""
    common = Trie.load(f"{shards.windows}/common")
    return common, np.argsort(-common.counts, kind="stable")


def _coded(words: np.ndarray, common: Trie, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of words, and the words that the codes from ``len(order)`` on stand for."""
    code = np.empty(len(order), np.int64)
    code[order] = np.arange(len(order))
    number = common.numbers(words)
    codes = np.where(number >= 0, code[number] if len(code) else 0, -1)
    used, at = np.unique(words[codes < 0], return_inverse=True)
    codes[codes < 0] = len(code) + at
    return codes.astype(np.uint32), used


INDEX = "part long, shard long, file string, first long, size long, body binary"


def _windows(shards: Shards):
    """Where a shard's windows of many rows lie; at shard -1, what is known of the rows."""

    def deal(held, common, code):
        words, inverse = np.unique(np.concatenate([w for w, *_ in held] + [[START, NONE]]), return_inverse=True)
        inverse, (start, none) = inverse[:-2], inverse[-2:]
        sizes = np.concatenate([np.diff(b) for _, b, *_ in held])
        row, out = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes), np.concatenate([x[-1] for x in held])
        ends = np.cumsum(sizes)
        before, behind = np.roll(inverse, 1), np.roll(inverse, -1)
        before[ends - sizes], behind[ends - 1] = start, none
        number = common.numbers(words)
        codes = np.where(number >= 0, code[number] if len(code) else 0, -1)
        # What common words add to their rows.
        place = number[inverse]
        own = place >= 0
        known = np.bincount(row[own], minlength=len(sizes))
        base = np.bincount(row[own], common.base(common.counts[place[own]]), len(sizes))
        yield -1, (sizes.astype(np.uint32), known.astype(np.uint32), base.astype(np.float64))
        shard = shards.of(words[before], words[inverse])
        order = np.argsort(shard, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            three = np.concatenate((before[own], inverse[own], behind[own]))
            coded = codes[three]
            used, at = np.unique(three[coded < 0], return_inverse=True)
            coded[coded < 0] = len(code) + at
            abc = coded.astype(np.uint32).reshape(3, -1)
            yield int(shard[own[0]]), _packed(words[used], *abc, row[own], out[row[own]])

    def run(batches):
        common, order = _common(shards)
        code = np.empty(len(order), np.int64)
        code[order] = np.arange(len(order))
        system, base = _system(shards.windows)
        name, part = uuid.uuid4().hex, TaskContext.get().partitionId() << 32
        with system.open_output_stream(f"{base}/{name}") as file:

            def dealt(held):
                pieces = deal(held, common, code)
                ids = _packed(*[np.concatenate([x[k] for x in held]) for k in (2, 3, 4)], *next(pieces)[1])
                found = [(part, -1, None, None, None, ids)]
                for shard, body in pieces:
                    found.append((part, shard, name, file.tell(), len(body), None))
                    file.write(body)
                return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*found), _INDEX)], names=_names(INDEX))

            held, n = [], 0
            for batch in batches:
                doc_id, out = batch.column(0), batch.column(1).to_numpy(False)
                ids = doc_id.fill_null(0).to_numpy(), doc_id.is_null().to_numpy(False), out
                for step in steps(batch.column(2)):
                    words, bounds = hashes(step)
                    held.append((words, bounds, *[x[step.first : step.last] for x in ids]))
                    n += len(words)
                    if n >= _DEALT:
                        yield dealt(held)
                        held, n, part = [], 0, part + 1
            if held:
                yield dealt(held)

    return run


_INDEX = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _joined(shards: Shards, index: pa.Table):
    """The words of a shard's windows, ascending, and by their numbers those before, in and after
    each; whether it is learned, whether the word in it has no code of its own, and of each
    part its windows' rows."""
    common, order = _common(shards)
    system, base = _system(shards.windows)
    codes, names, rows, learned, size = [], [common.hashes[order]], [], [], len(order)
    # In the order of parts, whatever order they came in.
    for found in sorted(index.select(["part", "file", "first", "size"]).to_pylist(), key=lambda x: x["part"]):
        with system.open_input_file(f"{base}/{found['file']}") as file:
            used, *abc, row, out = _unpacked(file.read_at(found["size"], found["first"]))
        abc = np.stack(abc)
        abc[abc >= len(order)] += np.uint32(size - len(order))
        size += len(used)
        codes.append(abc)
        names.append(used)
        rows.append(row)
        learned.append(~out)
    codes = np.concatenate(codes, axis=1)
    rare = codes[1] >= len(order)
    words, number = np.unique(np.concatenate(names), return_inverse=True)
    a, b, c = number.astype(np.int32)[codes]
    return words, a, b, c, np.concatenate(learned), rare, rows


def _counted(words: np.ndarray, one: np.ndarray, two: np.ndarray, least: int):
    """Distinct pairs of ``words`` by number seen ``least`` times, and how often."""
    keys, n = np.unique(one * np.int64(len(words)) + two, return_counts=True)
    keys, n = keys[n >= least], n[n >= least]
    return words[keys // len(words)], words[keys % len(words)], n


def _own(shards: Shards, words: np.ndarray, learned: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shard's words that were learned, ascending, and their counts; ``learned`` has the
    numbers of those in windows."""
    seen = np.bincount(learned, minlength=len(words))
    found = np.union1d(words[seen > 0], more)
    counts = np.zeros(len(found), np.int64)
    counts[np.searchsorted(found, words[seen > 0])] = seen[seen > 0]
    hot, at = shards.is_hot(found)
    counts[hot] = shards.n[at[hot]]
    return found, counts


def _ending_pairs(shards: Shards, p: LanguageModel):
    """(shard, body): pairs that end in a shard, for all shards of their first word, with the
    count of the second."""

    def run(table):
        names, a, b, _, learned, *_ = _joined(shards, table)
        words, counts = _own(shards, names, b[learned], names[:0])
        inner = learned & (names != START)[a]
        one, two, n = _counted(names, a[inner], b[inner], p.least)
        total = counts[np.searchsorted(words, two)]
        place, shard = shards.all_of(one)
        order = np.argsort(shard, kind="stable")
        place, shard = place[order], shard[order]
        common, by_count = _common(shards)
        codes, used = _coded(np.concatenate((one, two)), common, by_count)
        first, second = codes[: len(one)], codes[len(one) :]
        to, bodies = [], []
        for own in np.split(np.arange(len(place)), np.flatnonzero(np.diff(shard)) + 1):
            if len(own):
                at = place[own]
                to.append(int(shard[own[0]]))
                bodies.append(_packed(*_pairs_of(first[at], second[at], used, len(by_count)), n[at], total[at][second[at] >= len(by_count)]))
        return pa.table({"shard": pa.array(to, pa.int64()), "body": pa.array(bodies, pa.binary())})

    return run


def _pairs_of(first: np.ndarray, second: np.ndarray, used: np.ndarray, known: int):
    """The words without a code that these pairs have, and the pairs with codes for them alone."""
    both = np.concatenate((first, second))
    rare = both >= known
    own, at = np.unique(both[rare], return_inverse=True)
    both[rare] = known + at
    return used[own - known], both[: len(first)], both[len(first) :]


def _sent_pairs(shards: Shards, bodies) -> tuple[np.ndarray, ...]:
    """First and second words of the pairs sent to a shard, their counts and the second's."""
    common, order = _common(shards)
    names, own = common.hashes[order], common.counts[order]
    parts = [[np.empty(0, np.int64)] * 4]
    for body in bodies:
        used, first, second, n, rare = _unpacked(body.as_py())
        words = lambda codes: np.where(codes < len(names), names[np.minimum(codes, len(names) - 1)] if len(names) else 0, used[np.maximum(codes.astype(np.int64) - len(names), 0)] if len(used) else 0)
        total = np.empty(len(n), np.int64)
        is_rare = second >= len(names)
        total[is_rare], total[~is_rare] = rare, own[second[~is_rare]]
        parts.append([words(first), words(second), n, total])
    return tuple(np.concatenate(x) for x in zip(*parts))


def _shard_trie(shards: Shards, p: LanguageModel, names, a, b, c, learned, pairs):
    """The trie of a shard, which of its words are the shard's own, the numbers of the words in
    and after all windows, and the places of what they hold in the trie."""
    first, second, n, total = pairs
    hot = shards.is_hot(names)[0] & (np.bincount(b, minlength=len(names)) > 0)
    own, own_n = _own(shards, names, b[learned], np.union1d(first, names[hot]))
    inner = learned & (names != START)[a]
    one, two, m = _counted(names, a[inner], b[inner], p.least)
    words = np.unique(np.concatenate((own, second, one)))
    number = lambda x: np.searchsorted(words, x)
    counts = np.zeros(len(words), np.int64)
    np.maximum.at(counts, number(one), m)
    counts[number(second)] = total
    counts[number(own)] = own_n
    is_own = np.zeros(len(words), bool)
    is_own[number(own)] = True
    trie = Trie.words(words, counts, shards.tokens, shards.distinct)
    keys = np.concatenate((number(first) * trie.stride + number(second), number(one) * trie.stride + number(two)))
    keys, at = np.unique(keys, return_index=True)
    trie = trie.with_pairs(keys, np.concatenate((n, m))[at], p, is_own)
    of = trie.numbers(names).astype(np.int32)
    of[names == NONE] = -2
    before, middle, behind = of[a], of[b], of[c]
    ab, bc = trie.places(before, middle), trie.places(middle, behind)
    # A triple seen ``least`` times has pairs that are, too.
    at, triples = trie.triple_keys(ab, middle, bc)
    keys, n = np.unique(triples[learned[at]], return_counts=True)
    return trie.with_triples(keys[n >= p.least], n[n >= p.least], p), is_own, middle, behind, (ab, bc, at, triples)


def _build_and_score(shards: Shards, p: LanguageModel):
    """(part, body): the sums of each row's windows in a shard, against the shard's trie."""

    def run(key, index, pairs):
        if not index.num_rows:
            return pa.table({"part": pa.array([], pa.int64()), "body": pa.array([], pa.binary())})
        *windows, rare, rows = _joined(shards, index)
        sent = _sent_pairs(shards, pairs.column("body"))
        trie, is_own, middle, behind, places = _shard_trie(shards, p, *windows, sent)
        del windows, sent
        folder = shards.folder(key[0].as_py())
        trie.save(folder)
        trie = Trie.load(folder)
        known = np.zeros(len(rare), bool)
        known[middle >= 0] = is_own[middle[middle >= 0]]
        counts = np.zeros(len(rare), np.int64)
        counts[known] = trie.counts[middle[known]]
        gain = trie.gained(middle, behind, *places)
        bodies, first = [], 0
        for row in rows:
            here = slice(first, first + len(row))
            first += len(row)
            own, at = np.unique(row, return_inverse=True)
            units = np.rint(np.bincount(at, gain[here], len(own)) * _UNIT).astype(np.int64)
            few = rare[here]
            # The sign in the lowest bit, so that small numbers have small bytes.
            bodies.append(_packed(own, units << 1 ^ units >> 63, row[few], counts[here][few]))
        return pa.table({"part": sorted(index.column("part").to_pylist()), "body": pa.array(bodies, pa.binary())})

    return run


SUMS = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, gain double"


def _summed(shards: Shards):
    """The rows of a part, with their sums over all shards."""
    return lambda found, scored: _sums(shards, found, scored)


def _sums(shards: Shards, found, scored):
    doc_id, null, out, n, known, base = _unpacked(found.column("body")[0].as_py())
    known, base, gain = known.astype(np.int64), base.copy(), np.zeros(len(out))
    for body in scored.column("body"):
        at, units, row, counts = _unpacked(body.as_py())
        gain[at] += (units >> 1 ^ -(units & 1)) / _UNIT
        known += np.bincount(row, counts > 0, len(out)).astype(np.int64)
        base += np.bincount(row, shards.base(counts), len(out))
    sums = n.astype(np.int64), known, base, gain
    return pa.table([pa.array(doc_id, mask=null), pa.array(out), *map(pa.array, sums)], _names(SUMS))


def train(spark: SparkSession, docs: DataFrame, tables: Tables, p: LanguageModel):
    """The folder of the model, its shards, and the sums of each row."""
    learned = docs.where(~held_out(p))
    words = texts(learned).mapInArrow(_counter(_words_of), "key long, n long")
    words = tables.keep(words.groupBy("key").agg(F.sum("n").alias("n")), "words")
    shards = Shards.plan(spark, words, p)
    tables.drop("words")
    source = docs.select(
        F.col("doc_id").cast("long"),
        held_out(p).alias("held_out"),
        F.col("text").cast("binary").alias("text"),
    )
    index = tables.keep(source.mapInArrow(_windows(shards), INDEX), "index")
    # By number: rows that say where windows lie are small, the work behind them is not.
    of_shard = index.where("shard >= 0").drop("body").repartition(shards.total, "shard")
    pairs = of_shard.groupBy("shard").applyInArrow(
        _ending_pairs(shards, p), "shard long, body binary"
    )
    pairs = pairs.repartition(shards.total, "shard")
    scored = of_shard.groupBy("shard").cogroup(pairs.groupBy("shard"))
    scored = tables.keep(scored.applyInArrow(_build_and_score(shards, p), "part long, body binary"), "scored")
    path, fs = hadoop_path(spark, shards.windows)
    fs.delete(path, True)
    rows = index.where("shard < 0").select("part", "body")
    return shards.uri, shards, rows.groupBy("part").cogroup(scored.groupBy("part")).applyInArrow(_summed(shards), SUMS)


def score(spark: SparkSession, docs: DataFrame, p: LanguageModel = LanguageModel()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    A null or empty text is its end alone. Rows that share an id or repeat are scored each
    for itself; a null id counts as held out. Without training rows every word is unknown.
    An empty table gives an empty result; other columns are ignored.
    """
    _, shards, sums = train(spark, docs, Tables(spark, "model"), p)
    return sums.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(int(shards.tokens)).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("base") + F.col("gain")).alias("score"),
    )
