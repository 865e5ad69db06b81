"""Token ids in binary files: one zstandard frame per document, a shared dictionary.

A shard is one file:

    magic 8 bytes | dictionary hash 8 bytes | frames ... | index | n, index length, magic

The index has for each document its id, the offset of its frame and its number of ids, so
one short document is read without touching the others. Ids are little-endian unsigned
integers of 2 or 4 bytes, as the vocabulary needs. The dictionary is trained on serialized
ids of a bounded sample, stored once beside the shards and named by its hash in each.

Documents are encoded where they lie, and only frames are sorted by id, in ranges of equal
number. A task writes its own file under a name that no other attempt shares; the list of
shards is an ordinary table, so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.config import scratch_path
from tidemark.llm.common import Tables, texts

MAGIC = b"TIDTOK01"
_HEAD = "<8sQ"
_TAIL = "<QQ8s"
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("n", "<u8")])

#: Of a tokenizer's word cache, in words; a full cache starts anew.
_CACHE_WORDS = 1 << 18


@dataclass(frozen=True)
class TokenFiles:
    """``vocabulary`` is the path of a tokenizer file, present on every machine.
    ``sample_docs`` and ``sample_ids`` bound what the dictionary is trained on: that many
    documents, drawn by a hash of their text, and of each at most that many first ids."""

    vocabulary: str
    end_id: int = 1
    id_bytes: int = 2
    level: int = 3
    dictionary_bytes: int = 1 << 16
    sample_docs: int = 2000
    sample_ids: int = 2048
    frames_per_shard: int = 100_000

    @property
    def kind(self) -> np.dtype:
        return np.dtype(f"<u{self.id_bytes}")


#: New words that are learned at a time: few enough that what is made of them stays in the
#: cache of a core that shares its memory with others.
_LEARNED = 1 << 9

# What the pre-tokenizer takes a character for. Letters of ASCII and Latin-1 are already
# composed and have one small form each. A word with any other character is left to the
# tokenizer, and so are those with an apostrophe, which may begin an ending.
_BETWEEN, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
_KIND = np.full(257, _OTHER, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x27] = _OTHER
_KIND[0x20] = _BETWEEN


# What a tokenizer file says when its texts can be encoded word by word.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}


_MERGES = {
    "type": "BPE",
    "dropout": None,
    "unk_token": None,
    "continuing_subword_prefix": None,
    "end_of_word_suffix": "</w>",
    "byte_fallback": False,
    "ignore_merges": False,
}
#: Added to a character, it stands for that character at the end of a piece.
_LAST = 0xE000


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _final(token: str) -> str:
    """A token with its last character as ``_LAST`` has it, instead of a suffix."""
    suffix = _MERGES["end_of_word_suffix"]
    if not token.endswith(suffix) or token == suffix:
        return token
    token = token[: -len(suffix)]
    return token[:-1] + chr(ord(token[-1]) + _LAST)


def by_words(path: str) -> bool:
    """Whether a tokenizer file is of the kind that ``WordEncoder`` takes apart."""
    from tokenizers import pre_tokenizers

    spec = _spec(path)
    model = spec["model"]
    if {k: model.get(k) for k in _MERGES} != _MERGES:
        return False
    # Each byte has a token, at the end of a piece and before it, and no two tokens become one.
    tokens, letters = set(map(_final, model["vocab"])), pre_tokenizers.ByteLevel.alphabet()
    if len(tokens) < len(model["vocab"]) or not tokens.issuperset(y for x in letters for y in (x, chr(ord(x) + _LAST))):
        return False
    before = spec.get("pre_tokenizer") or {}
    parts = before.get("pretokenizers") or [{}]
    last = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    return (
        spec.get("normalizer") == _NORMALIZER
        and parts[0] == _SPLIT
        and [{k: p.get(k) for k in last} for p in parts[1:]] == [last]
        and all(t["content"].startswith("<|") and not t["normalized"] for t in spec.get("added_tokens", ()))
    )


class WordEncoder:
    """Ids of texts, word by word where the vocabulary allows it (see ``by_words``), and of
    whole texts where it does not.

    Such a normalizer makes all letters small, and its pre-tokenizer drops white
    space and never joins letters across it. So a text's ids are those of its words in
    turn, and A-Z may be made small first. Words of letters with or without accents, digits
    and ASCII marks are cut where the pre-tokenizer would, many at a time, and their pieces
    go to the merges in one call, as one run of characters: the last of each piece is a
    character of its own, after which nothing merges, instead of one with a suffix. A cache
    maps words to their ids; all words of a batch are then put together by array operations.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer, self.by_words = Tokenizer.from_file(path), by_words(path)
        if not self.by_words:
            return
        # The merges alone, with the same ids, and which ids end a piece.
        model = _spec(path)["model"]
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        vocabulary = {_final(token): k for token, k in model["vocab"].items()}
        self.merges = Tokenizer(models.BPE(vocabulary, [(_final(x), _final(y)) for x, y in pairs]))
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if ord(token[-1]) >= _LAST]] = True
        # Small letters as the model writes their bytes: those with accents have two, of
        # which the first is the same for all.
        written = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.first_byte, self.last_byte = ord(written("ß")[0][0][0]), np.arange(256, dtype=np.uint32)
        self.last_byte[0xDF:] = [ord(written(chr(c))[0][0][1]) for c in range(0xDF, 0x100)]
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.first = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        ids, counts = [self.ids], []
        for low in range(0, len(words), _LEARNED):
            some = words[low : low + _LEARNED]
            other, made, n = self._pieces(some)
            odd = np.flatnonzero(other).tolist()
            encoded = [self.tokenizer.encode(some[k].decode("utf-8", "replace"), add_special_tokens=False).ids for k in odd]
            ids += [made, *(np.array(x, np.uint32) for x in encoded)]
            counts += [n, np.array([len(x) for x in encoded], np.int64)]
            order = [*np.flatnonzero(~other).tolist(), *odd]
            self.known.update(zip((some[k] for k in order), range(len(self.known), len(self.known) + len(order))))
        self.ids = np.concatenate(ids)
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(np.concatenate(counts))))

    def _pieces(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are left to the tokenizer; of the others, all ids and how many each has."""
        text = b" ".join(words).decode("utf-8", "replace")
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = _KIND[np.minimum(codes, 256)]
        # A special token begins like this.
        kind[:-1][(codes[:-1] == ord("<")) & (codes[1:] == ord("|"))] = _OTHER
        # The space before a word goes with it.
        word = np.cumsum(kind == _BETWEEN)
        other = np.zeros(len(words), bool)
        other[word[kind == _OTHER]] = True
        kept = ~other[word]
        codes, kind, word = codes[kept], kind[kept], word[kept]
        if not len(codes):
            return other, np.empty(0, np.uint32), np.empty(0, np.int64)
        before, after = kind[:-1], kind[1:]
        cut = (before > _BETWEEN) & (after > _BETWEEN) & ((before != after) | (after == _DIGIT))
        at = np.flatnonzero(cut) + 1
        pieces = (np.bincount(word[at], minlength=len(words)) + 1)[~other]
        accented = codes >= 0xC0
        large = (codes >= 0x41) & (codes < 0x5B) | accented & (codes < 0xDF)
        codes = self.last_byte[codes + 32 * large]
        last = np.ones(len(kind), bool)
        last[:-1] = cut | (after == _BETWEEN)
        codes[last] += _LAST
        # A letter with an accent has two bytes; what is between words has none.
        times = np.add(kind > _BETWEEN, accented, dtype=np.int64)
        first = np.cumsum(times) - times
        codes = np.repeat(codes, times)
        codes[first[accented]] = self.first_byte
        made = self.merges.encode_batch_fast([codes.astype("<u4").tobytes().decode("utf-32-le")], add_special_tokens=False)
        ids = np.array(made[0].ids, np.uint32)
        n = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        return other, ids, np.add.reduceat(n, np.cumsum(pieces) - pieces)

    def encode(self, documents: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        if not self.by_words:
            whole = [d.decode("utf-8", "replace") for d in documents]
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in whole]
        out: list[np.ndarray] = []
        low = 0
        while low < len(documents):
            high, size = low, 0
            while high < len(documents) and (high == low or size + len(documents[high]) <= 1 << 20):
                size += len(documents[high])
                high += 1
            out += self._some(documents[low:high])
            low = high
        return out

    def _some(self, documents: list[bytes]) -> list[np.ndarray]:
        # Capitals could spell a special token once they are small.
        split = [(d if b"<|" in d else d.translate(_SMALL)).split() for d in documents]
        words = [w for s in split for w in s]
        if not words:
            return [np.empty(0, np.uint32)] * len(documents)
        if len(self.known) > _CACHE_WORDS:
            self._clear()
        which = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(which < 0)
        if len(new):
            found = [words[k] for k in new.tolist()]
            self._learn(list(dict.fromkeys(found)))
            which[new] = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        first, counts = self.first[which], self.first[which + 1] - self.first[which]
        total = np.concatenate(([0], np.cumsum(counts)))
        ids = self.ids[np.arange(total[-1]) + np.repeat(first - total[:-1], counts)]
        ends = total[np.cumsum([0] + [len(s) for s in split])]
        return np.split(ids, ends[1:-1])


_SMALL = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary; a worker keeps it, with its cache, from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def train_dictionary(docs: DataFrame, p: TokenFiles) -> bytes:
    """A dictionary trained on the serialized ids of a sample; empty if there is too little.

    The sample is the documents with the smallest hashes of their text, so it does not
    depend on how the table is stored. ``sample_ids`` cuts what of a document is learned
    from, as a dictionary is for short documents; nothing else is cut.
    """
    hashed = docs.where("text <> ''").select(F.xxhash64("text").alias("h"))
    least = [r["h"] for r in hashed.distinct().orderBy("h").limit(p.sample_docs).collect()]
    if not least:
        return b""
    beginning = F.substring("text", 1, 16 * p.sample_ids).cast("binary").alias("text")
    chosen = docs.where("text <> ''").where(F.xxhash64("text") <= least[-1]).select(F.xxhash64("text").alias("h"), beginning)
    # Equal texts have one hash and count once; copies are combined before the shuffle.
    texts_of = dict(chosen.groupBy("h").agg(F.max("text").alias("text")).collect())
    encoder = word_encoder(p.vocabulary)
    found = encoder.encode([bytes(texts_of[h]) for h in sorted(texts_of)])
    samples = [
        x[: p.sample_ids].astype(p.kind).tobytes() for x in found
    ]
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(p.dictionary_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _pack(dictionary, p: TokenFiles) -> Callable:
    """Arrow batches of (doc_id, text) to (doc_id, n, frame)."""

    def run(batches):
        encoder = word_encoder(p.vocabulary)
        words = dictionary.value
        learned = zstandard.ZstdCompressionDict(words) if words else None
        compressor = zstandard.ZstdCompressor(level=p.level, dict_data=learned)
        for batch in (b.slice(k, 512) for b in batches for k in range(0, b.num_rows, 512)):
            found = encoder.encode([x or b"" for x in batch.column(1).to_pylist()])
            frames = [compressor.compress(np.append(x, p.end_id).astype(p.kind).tobytes()) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array([len(x) + 1 for x in found], pa.int64()),
                    pa.array(frames, pa.binary()),
                ],
                names=["doc_id", "n", "frame"],
            )

    return run


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, as executors see it."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


SHARDS = "path string, least long, n_docs long, n_tokens long"


def _write(folder: str, digest: int) -> Callable:
    """Sorted (doc_id, n, frame) batches of one partition to one shard file."""

    def run(batches):
        path, entries, at, tokens, out = "", [], struct.calcsize(_HEAD), 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                system, base = _open(folder)
                system.create_dir(base, recursive=True)
                path = f"{folder}/shard-{uuid.uuid4().hex}.tok"
                out = system.open_output_stream(_open(path)[1])
                out.write(struct.pack(_HEAD, MAGIC, digest))
            index = np.zeros(batch.num_rows, INDEX)
            sizes = np.array([len(x) for x in batch.column(2).to_pylist()], np.uint64)
            index["null"] = np.array(batch.column(0).is_null())
            index["doc_id"] = batch.column(0).fill_null(0)
            index["n"] = batch.column(1)
            index["offset"] = at + np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.uint64)
            out.write(b"".join(batch.column(2).to_pylist()))
            at += int(sizes.sum())
            tokens += int(index["n"].sum())
            entries.append(index)
        if out is None:
            return
        index = np.concatenate(entries)
        out.write(index.tobytes())
        out.write(struct.pack(_TAIL, len(index), index.nbytes, MAGIC))
        out.close()
        least = None if index["null"][0] else int(index["doc_id"][0])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([path]),
                pa.array([least], pa.int64()),
                pa.array([len(index)], pa.int64()),
                pa.array([tokens], pa.int64()),
            ],
            names=["path", "least", "n_docs", "n_tokens"],
        )

    return run


def write(spark: SparkSession, docs: DataFrame, folder: str, p: TokenFiles) -> DataFrame:
    """Encode every document into shard files under ``folder``; returns the list of shards:
    path, first (its number, from 0), start (ids in the shards before), n_docs, n_tokens."""
    tables = Tables(spark, "tokens")
    words = train_dictionary(docs, p)
    digest = xxhash.xxh64_intdigest(words)
    system, base = _open(folder)
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/dictionary-{digest:016x}") as out:
        out.write(words)
    shared = spark.sparkContext.broadcast(words)
    frames = tables.keep(
        texts(docs, "doc_id").mapInArrow(_pack(shared, p), "doc_id long, n long, frame binary"), "frames"
    )
    parts = max(1, -(-frames.count() // p.frames_per_shard), spark.sparkContext.defaultParallelism)
    # Equal ids sort by their frame, so that reruns give the same order.
    sorted_frames = frames.repartitionByRange(parts, "doc_id", "frame").sortWithinPartitions("doc_id", "frame")
    shards = tables.keep(sorted_frames.mapInArrow(_write(folder, digest), SHARDS), "shards")
    tables.drop("frames")
    # One row per shard file.
    before = Window.orderBy(F.asc_nulls_first("least")).rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


class Shard:
    """Random access to one file."""

    def __init__(self, path: str, p: TokenFiles):
        system, base = _open(path)
        self.kind = p.kind
        self.file = system.open_input_file(base)
        size = self.file.size()
        _, digest = struct.unpack(_HEAD, self.file.read_at(struct.calcsize(_HEAD), 0))
        n, length, magic = struct.unpack(_TAIL, self.file.read_at(struct.calcsize(_TAIL), size - struct.calcsize(_TAIL)))
        self.end = size - struct.calcsize(_TAIL) - length
        self.index = np.frombuffer(self.file.read_at(length, self.end), INDEX)
        with system.open_input_stream(f"{base.rsplit('/', 1)[0]}/dictionary-{digest:016x}") as stored:
            words = stored.read()
        if magic != MAGIC or len(self.index) != n or xxhash.xxh64_intdigest(words) != digest:
            raise ValueError(f"{path} is damaged or its dictionary is another")
        learned = zstandard.ZstdCompressionDict(words) if words else None
        self.decompressor = zstandard.ZstdDecompressor(dict_data=learned)

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document."""
        first = int(self.index["offset"][k])
        last = int(self.index["offset"][k + 1]) if k + 1 < len(self.index) else self.end
        frame = self.file.read_at(last - first, first)
        return np.frombuffer(self.decompressor.decompress(frame), self.kind)

    def __iter__(self) -> Iterator[np.ndarray]:
        """All documents, reading a run of frames at a time."""
        offsets = np.append(self.index["offset"].astype(np.int64), self.end)
        k = 0
        while k < len(self.index):
            last = max(k + 1, int(np.searchsorted(offsets, offsets[k] + (4 << 20), "right")) - 1)
            run = memoryview(self.file.read_at(int(offsets[last] - offsets[k]), int(offsets[k])))
            for i in range(k, last):
                frame = run[offsets[i] - offsets[k] : offsets[i + 1] - offsets[k]]
                yield np.frombuffer(self.decompressor.decompress(frame), self.kind)
            k = last


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read(shards: DataFrame, p: TokenFiles) -> DataFrame:
    """From the files: doc_id, start, n_tokens and ids_crc32 of each document."""

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(path, p)
                crcs, counts = [], []
                for ids in shard:
                    counts.append(len(ids))
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                counts = np.array(counts, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.index["doc_id"], pa.int64(), mask=shard.index["null"].astype(bool)),
                        pa.array(start + np.cumsum(counts) - counts),
                        pa.array(counts),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    parts = max(1, min(shards.count(), 1 << 16))
    return shards.select("path", "start").repartition(parts, "path").mapInArrow(run, READ)


def encoded(spark: SparkSession, docs: DataFrame, p: TokenFiles, folder: str | None = None) -> DataFrame:
    """Write the files and report what they hold, one row per document.

    ``folder`` is one that all executors reach, a new one in the shared folder if not
    given. A null or empty text has only the end id. A null doc_id comes first and stays
    null; rows that share an id are all kept, ordered by their frames. An empty table gives no
    shard and an empty result. Other columns are ignored.
    """
    return read(write(spark, docs, folder or scratch_path(spark, "token-files"), p), p)
