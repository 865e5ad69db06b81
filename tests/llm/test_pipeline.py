from __future__ import annotations

import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tidemark.llm import decontaminate, mixing, near_dedup, quality
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's output, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = (docs, stage(spark, docs, SF))
        out[name][1].write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out[name] = (out[name][0], docs)
    return out


def test_each_stage_does_what_its_operator_says(spark, stages):
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = stages["quality_rules"]
    assert ids(after) == ids(quality.report(spark, before).where("kept"))
    before, after = stages["near_duplicates"]
    assert ids(after) == ids(near_dedup.near_duplicates(spark, before, near_dedup.NearDedup(words=5)).where("kept"))
    before, after = stages["decontamination"]
    leaks = {r.doc_id for r in decontaminate.matches(spark, before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids(after) == [k for k in ids(before) if k not in leaks] and leaks
    before, after = stages["source_mix"]
    taken = sum(r.taken for r in mixing.report(spark, before).collect())
    assert sum(len(r.text.encode().split()) for r in after.collect()) == taken
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == stages[name][0].columns


def test_token_ids_of_the_mix(stages):
    before, after = stages["token_ids"]
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(
        (r.doc_id, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        for r in before.collect()
        for ids in [[*t.encode(r.text, add_special_tokens=False).ids, 1]]
    )
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in after.collect())
    assert sorted(r[1:] for r in got) == want
    assert [r[0] for r in got] == [sum(r[2] for r in got[:k]) for k in range(len(got))]


def test_run_gives_the_last_stage(spark, stages):
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert got == sorted(map(tuple, stages["token_ids"][1].collect()))


def test_near_copies_share_five_word_shingles(spark, make_docs):
    """81 % of four words but 77 % of five stay apart; a nearer copy goes."""
    words = [f"w{k}" for k in range(80)]
    changed = lambda *at: " ".join("x" if k in at else w for k, w in enumerate(words))
    docs = make_docs([(1, " ".join(words)), (2, changed(20, 60)), (3, "y " + changed(79))])
    assert near_dedup.unique(spark, docs).count() == 1
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
