"""Table scans and guards."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; a declared schema saves the footer-inference pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` holds a readable table."""
    try:
        return len(spark.read.parquet(path).schema) > 0
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def has_rows(df: DataFrame | None) -> bool:
    """Emptiness test that stops at the first row."""
    return df is not None and not df.isEmpty()


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None when it is missing or empty."""
    if not exists(spark, path):
        return None
    df = read_table(spark, path)
    return df if has_rows(df) else None


def read_cities(spark: SparkSession, path: str) -> DataFrame | None:
    """Entity metadata file as ``(city, country, latitude, longitude)``."""
    from tidemark.schemas import CITY_FILE

    try:
        raw = spark.read.schema(CITY_FILE).option("header", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return raw.select(*[F.col(n).alias(n.lower()) for n in CITY_FILE.names])
