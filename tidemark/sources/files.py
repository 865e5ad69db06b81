"""Wide attribute files of the landing zone, and which of them are new."""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.shape import unpivot
from tidemark.sources.tables import exists

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modified_at", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)


def read_wide(spark: SparkSession, path: str) -> DataFrame | None:
    """All columns as text, named by the header line. No inference pass over the data."""
    try:
        first = spark.read.text(path).limit(1).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if not first:
        return None
    names = next(csv.reader([first[0][0].lstrip("﻿")]))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # enforceSchema=false makes Spark compare every file's header with these names.
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_attribute(
    spark: SparkSession, path: str, attribute: str, dtype: T.DataType
) -> DataFrame | None:
    """A wide file (time × entity) as ``(datetime, city, <attribute>)`` rows."""
    wide = read_wide(spark, path)
    if wide is None or len(wide.columns) < 2:
        return None
    time = wide.columns[0]
    long = unpivot(wide, [time], "city", attribute, dtype)
    return long.select(
        F.try_to_timestamp(F.col("`" + time + "`")).alias("datetime"), "city", attribute
    )


def new_files(spark: SparkSession, landing: str, manifest: str) -> DataFrame:
    """CSV files in the landing zone that the manifest does not list: ``(path, modified_at)``.

    Reads file metadata only; contents are pruned from the scan.
    """
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .load(landing)
        .select("path", F.col("modificationTime").alias("modified_at"))
    )
    if not exists(spark, manifest):
        return found
    known = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)
    return found.join(known, ["path", "modified_at"], "left_anti")


CLAIM_SCHEMA = T.StructType(
    [
        T.StructField("batch", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("modified_at", T.TimestampType()),
    ]
)


def next_batch(spark: SparkSession, landing: str, manifest: str, claims: str) -> DataFrame | None:
    """The files to ingest now, ``(batch, path, modified_at)``, or None when all are ingested.

    New files are claimed before anything is read: one small file that is there or not. A
    batch is named after the paths and times of its files. If a run died after its claim,
    the same files come again under the same name, whatever has landed since, so that its
    rows replace what the dead run wrote.
    """
    if exists(spark, claims):
        claimed = spark.read.schema(CLAIM_SCHEMA).parquet(claims)
        done = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest) if exists(spark, manifest) else None
        unfinished = claimed if done is None else claimed.join(done, ["path", "modified_at"], "left_anti")
        if (open_row := unfinished.select("batch").first()) is not None:
            return claimed.where(F.col("batch") == open_row["batch"])
    fresh = new_files(spark, landing, manifest)
    names = F.sort_array(F.collect_list(F.concat_ws("|", "path", F.unix_micros("modified_at").cast("string"))))
    name = fresh.agg(F.md5(F.array_join(names, "\n")).alias("batch"), F.count(F.lit(1)).alias("n")).first()
    if name["n"] == 0:
        return None
    fresh.select(F.lit(name["batch"]).alias("batch"), "path", "modified_at").coalesce(1).write.mode("append").parquet(
        claims
    )
    return spark.read.schema(CLAIM_SCHEMA).parquet(claims).where(F.col("batch") == name["batch"])


def record_files(files: DataFrame, manifest: str) -> None:
    """Mark files as ingested. Run after the data they hold is committed."""
    files.select("path", "modified_at", F.current_timestamp().alias("ingested_at")).write.mode(
        "append"
    ).parquet(manifest)
