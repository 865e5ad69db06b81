"""Each operator as a query over the given tables; SQL twins are in ``oracle``."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import tidemark
from tidemark.llm import conversation_trie, decontaminate, language_model, merkle, mixing, near_dedup, pii, quality, simhash, substring_dedup, token_files, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_HOME = os.path.dirname(os.path.dirname(os.path.abspath(tidemark.__file__)))


def reach_workers(spark: SparkSession) -> None:
    """Let the Python workers of this machine import the package from where it lies.

    On a cluster the package is installed or sent along with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    known = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if _HOME not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, _HOME])


def query(function: Query) -> Query:
    """Register a query under the name of its function."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reach_workers(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, table(spark, sf_dir, "documents"))


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(spark, table(spark, sf_dir, "documents"))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(spark, table(spark, sf_dir, "documents"))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    p = token_files.TokenFiles(public_tokenizers.path("word_bpe_49k.json"))
    return token_files.encoded(spark, table(spark, sf_dir, "documents"), p)


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(spark, table(spark, sf_dir, "documents"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(spark, table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(spark, table(spark, sf_dir, "documents"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivative_records(spark, table(spark, sf_dir, "pages")).drop("path")


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(spark, table(spark, sf_dir, "documents"))


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.branched_trie(spark, table(spark, sf_dir, "conversations"))
