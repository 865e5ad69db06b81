from __future__ import annotations

import json
import random
import struct
import time
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.token_files import Shard, TokenFiles, WordEncoder, by_words, encoded, write

PATH = public_tokenizers.path("word_bpe_49k.json")
P = TokenFiles(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_odd_rows_round_trip(spark, make_docs, odd_rows, tokenizer):
    rows = sorted(
        ((i, ids_of(tokenizer, t)) for i, t, *_ in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0)
    )
    want, at = [], 0
    for doc_id, ids in rows:
        want.append((doc_id, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    docs = make_docs(odd_rows).selectExpr("*", "1 AS n", "2 AS frame", "3 AS start")
    got = sorted(map(tuple, encoded(spark, docs, P).collect()), key=lambda r: r[1])
    assert got == want
    assert encoded(spark, docs.limit(0), P).count() == 0


def test_one_document_of_a_shard(spark, make_docs, prose, tokenizer, tmp_path):
    rows = [(k, prose(30 + k, k)) for k in range(60)]
    shards = write(spark, make_docs(rows), str(tmp_path / "files"), P).collect()
    texts, seen = dict((r[0], r[1]) for r in rows), []
    for s in sorted(shards, key=lambda s: s.start):
        shard = Shard(s.path, P)
        assert shard.index["n"].sum() == s.n_tokens
        for k in (len(shard.index) - 1, 0):
            assert list(shard.ids(k)) == ids_of(tokenizer, texts[int(shard.index["doc_id"][k])])
        seen += [int(x) for x in shard.index["doc_id"]]
    assert seen == sorted(texts)
    stored = next((tmp_path / "files").glob("dictionary-*"))
    stored.write_bytes(stored.read_bytes() + b"x")
    with pytest.raises(ValueError):
        Shard(shards[0].path, P)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_words_encode_as_the_whole_text(texts):
    tokenizer = Tokenizer.from_file(PATH)
    got = WordEncoder(PATH).encode([t.encode("utf-8", "replace") for t in texts])
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    assert [list(x) for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_vocabularies_encode_whole_texts(spark, make_docs, odd_rows):
    """A file whose steps join over white space or keep capitals is not taken word by word."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert by_words(PATH) and not by_words(path)
    other = Tokenizer.from_file(path)
    rows = [(k, (t or "")[:5000]) for k, (_, t, *_) in enumerate(odd_rows)] + [(90, "Two  Words\n\n MiXed, it's"), (91, " lead")]
    texts = [t for _, t in rows]
    assert [x.tolist() for x in WordEncoder(path).encode([t.encode() for t in texts])] == [
        other.encode(t, add_special_tokens=False).ids for t in texts
    ]
    got = encoded(spark, make_docs(rows), TokenFiles(path)).collect()
    want = {k: zlib.crc32(struct.pack(f"<{len(i) + 1}I", *i, 1)) for k, t in rows for i in [other.encode(t, add_special_tokens=False).ids]}
    assert {r.doc_id: r.ids_crc32 for r in got} == want


def test_new_words_go_to_the_merges_together(tokenizer):
    """Letters, digits and marks, with and without accents, do not cost one call a word."""
    words = [w for k in range(300) for w in (f"n\u00e9{k}x.,", f"\u00dcb{k}--\u00e4!", f"w<{k}|>", "\u00df" * (k % 5 + 1))]
    odd = ["it's", "'s", "<|endoftext|>", "a<|b", "\u00aa", "\u00d7y", "e\u0301", "\u4e2d\u6587", "\ufffd", "A\x1cB", "x\u00a0y", "1\u00bd"]
    text = " ".join(w for k, word in enumerate(words) for w in (word, *odd[: k == 600 and len(odd)]))
    encoder = WordEncoder(PATH)
    calls = []

    class Counting:
        def encode(self, word, **given):
            calls.append(word)
            return tokenizer.encode(word, **given)

    encoder.tokenizer = Counting()
    found = encoder.encode([text.encode(), text.upper().encode(), b""])
    assert [x.tolist() for x in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in (text, text.upper(), "")]
    assert len(calls) < 4 * len(odd)


def test_new_words_take_a_part_of_the_tokenizers_time(tokenizer):
    """Pieces are merged as one run of characters, with the ids of each alone."""
    rng, parts = random.Random(7), ["the", "ou", "é", "st", "Ü", "ion", "Q", "ß", "x", "an"]
    words = [w for _ in range(20_000) for w in ("".join(rng.choices(parts, k=6)) + rng.choice(["", ",", "!?", "7", "-on."]),)]
    texts = [" ".join(words[k : k + 4000]) for k in range(0, len(words), 4000)]
    encoder, took = WordEncoder(PATH), []
    for _ in range(3):
        encoder._clear()
        began = time.process_time()
        found = encoder.encode([t.encode() for t in texts])
        middle = time.process_time()
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        took.append((middle - began) / (time.process_time() - middle))
        assert [x.tolist() for x in found] == want
    assert min(took) < 0.65


@pytest.mark.parametrize("changed", [{"ignore_merges": True}, {"dropout": 0.1}, {"end_of_word_suffix": None}, {"byte_fallback": True}])
def test_other_merges_are_not_taken_apart(tmp_path, changed):
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["model"] |= changed
    (tmp_path / "other.json").write_text(json.dumps(spec), encoding="utf-8")
    assert not by_words(str(tmp_path / "other.json"))
