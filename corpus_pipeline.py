"""A training corpus from raw documents, stage by stage.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame; ``run`` writes it as Parquet in the shared folder and hands the
reread table to the next. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, near_dedup, quality, token_files
from tidemark.llm.common import Tables
from tidemark.llm.queries import reach_workers, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go."""
    reach_workers(spark)
    return quality.filter_quality(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    reach_workers(spark)
    return near_dedup.unique(spark, docs, near_dedup.NearDedup(words=5))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    reach_workers(spark)
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares: documents are left out, cut once a source, or repeated."""
    reach_workers(spark)
    return mixing.mixed(spark, docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus and what they hold for each document."""
    reach_workers(spark)
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_files.encoded(spark, docs, token_files.TokenFiles(vocabulary))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

# SQL has no tokenizer; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents: doc_id, start, n_tokens, ids_crc32 of the token files."""
    docs = table(spark, sf_dir, "documents")
    tables = Tables(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = tables.keep(stage(spark, docs, sf_dir), name)
        if k:
            tables.drop(STAGES[k - 1][0])
    return docs
