"""Model versions and stages as a small keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import VersionedTable

# Stage names and the name the forecast model is registered under.
STAGES = ("Staging", "Production", "Archived")
MODEL_NAME = "weather-forecast-model"

_COLUMNS = (
    "name string, version int, stage string, status string, algorithm string,"
    "mae double, rmse double, r2 double, path string, created_at timestamp"
)


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = VersionedTable(spark, root, ["name", "version"], "name")

    def versions(self, name: str = MODEL_NAME) -> DataFrame:
        rows = self.table.read([name])
        if rows is None:
            return self.spark.createDataFrame([], _COLUMNS)
        return rows.select("name", *[c.split()[0] for c in _COLUMNS.split(",")[1:]])

    def register(
        self, algorithm: str, metrics: dict[str, float], path: str, name: str = MODEL_NAME
    ) -> int:
        """Add the next version, without a stage."""
        newest = self.versions(name).agg(F.max("version")).first()[0] or 0
        row = (
            name, newest + 1, "None", "", algorithm,
            metrics["mae"], metrics["rmse"], metrics["r2"], path,
        )
        columns = _COLUMNS.rsplit(",", 1)[0]
        added = self.spark.createDataFrame([row], columns)
        self.table.merge(added.withColumn("created_at", F.current_timestamp()))
        return newest + 1

    def transition(self, version: int, stage: str, name: str = MODEL_NAME) -> None:
        """Move one version to a stage."""
        if stage not in STAGES:
            raise ValueError(f"invalid stage {stage!r}")
        rows = self.versions(name).filter(F.col("version") == version)
        if rows.isEmpty():
            raise KeyError(f"{name} has no version {version}")
        self.table.merge(rows.withColumn("stage", F.lit(stage)))

    def promote(self, version: int, name: str = MODEL_NAME) -> None:
        """Archive the current production versions and promote one, in a single commit."""
        new = F.col("version") == version
        rows = self.versions(name).filter(new | (F.col("stage") == "Production"))
        if rows.filter(new).isEmpty():
            raise KeyError(f"{name} has no version {version}")
        self.table.merge(
            rows.withColumn("stage", F.when(new, "Production").otherwise("Archived")).withColumn(
                "status", F.when(new, "production").otherwise(F.col("status"))
            )
        )

    def latest(
        self, stages: tuple[str, ...] = ("Production", "Staging"), name: str = MODEL_NAME
    ) -> DataFrame:
        """The newest version in each stage."""
        rows = self.versions(name).filter(F.col("stage").isin(*stages))
        newest = F.struct(*[F.col(c) for c in rows.columns])
        return rows.groupBy("stage").agg(F.max_by(newest, "version").alias("m")).select("m.*")
