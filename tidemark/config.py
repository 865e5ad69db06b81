"""Table locations, session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every operator relies on.
# forceOptimizeSkewedJoin lets AQE split a hot join key even when the join's
# hash partitioning is reused by the aggregate above it.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Shuffle bytes a rebalanced partition aims at, which sets the size of written files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Streaming state beyond the heap of an executor.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A table of many day partitions is listed by this many tasks, not one per directory.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}

# Rows of one series that a window task should sort; longer series are cut into blocks.
ROWS_PER_TASK = 2_000_000

# The table names users query by.
TABLE_NAMES = (
    "bronze_weather_streaming",
    "bronze_weather_batch",
    "silver_weather_clean",
    "dim_city",
    "dim_date",
    "fact_weather_daily_stats",
    "fact_weather_monthly_stats",
    "fact_weather_city_summary",
    "hourly_weather",
    "daily_weather",
    "training_data",
)


@dataclass(frozen=True)
class LakeConfig:
    """Where each layer lives. Every path derives from ``root``.

    ``silver_partition`` is the unit an upsert rewrites: ``recorded_date`` for large
    tables, ``recorded_month`` where a day would make tiny files. ``feature_digits``
    computes trailing statistics in fixed point (see ``functions.fixed_point``).
    ``rows_per_task`` is how long a series may be before it is cut into blocks.
    """

    root: str
    entity: str | None = None
    horizon: int = 24
    silver_partition: str = "recorded_date"
    feature_digits: int | None = 4
    rows_per_task: int = ROWS_PER_TASK

    def __post_init__(self) -> None:
        if self.silver_partition not in ("recorded_date", "recorded_month"):
            raise ValueError(f"unknown silver partition {self.silver_partition!r}")

    @classmethod
    def from_env(cls, default_root: str = "lake") -> "LakeConfig":
        """Read LAKE_ROOT, ANALYSIS_CITY, FORECAST_HORIZON_HOURS, SILVER_PARTITION,
        FEATURE_DIGITS and ROWS_PER_TASK."""
        digits = os.environ.get("FEATURE_DIGITS", "4")
        return cls(
            root=os.environ.get("LAKE_ROOT", default_root).rstrip("/"),
            entity=os.environ.get("ANALYSIS_CITY") or None,
            horizon=int(os.environ.get("FORECAST_HORIZON_HOURS", "24")),
            silver_partition=os.environ.get("SILVER_PARTITION", "recorded_date"),
            feature_digits=int(digits) if digits else None,
            rows_per_task=int(os.environ.get("ROWS_PER_TASK", ROWS_PER_TASK)),
        )

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def manifest(self) -> str:
        return f"{self.root}/manifest"

    @property
    def claims(self) -> str:
        return f"{self.root}/claims"

    @property
    def bronze_checkpoint(self) -> str:
        return f"{self.root}/checkpoints/bronze"

    def silver_checkpoint(self, source: str) -> str:
        return f"{self.root}/checkpoints/silver_{source}"

    @property
    def cube(self) -> str:
        return f"{self.root}/cube"

    @property
    def registry(self) -> str:
        return f"{self.root}/models/registry"

    @property
    def models(self) -> str:
        return f"{self.root}/models/artifacts"

    def table(self, name: str) -> str:
        if name not in TABLE_NAMES:
            raise KeyError(f"unknown table {name!r}")
        return f"{self.root}/tables/{name}"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would vanish with its node.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all nodes share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
    if scopes := getattr(_scopes, "open", None):
        scopes[-1].append(path)
    return path


_scopes = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside the block when it ends.

    Jobs that write their results run in such a block. A query that returns a lazy
    DataFrame cannot: its intermediate tables are read later.
    """
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    made: list[str] = []
    _scopes.open.append(made)
    try:
        yield
    finally:
        _scopes.open.pop()
        for path in made:
            folder, fs = hadoop_path(spark, path)
            fs.delete(folder, True)


def hadoop_path(spark: SparkSession, text: str):
    """A path and the file system it lives on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def size_shuffles(spark: SparkSession, *paths: str, bytes_per_task: int = 128 << 20) -> int:
    """Start shuffles with enough partitions for the stored size of the inputs.

    Decoded rows take several times their Parquet size, hence the factor. AQE merges
    what turns out small, so only too few partitions would hurt: they spill.
    """
    stored = 0
    for text in paths:
        path, fs = hadoop_path(spark, text)
        if fs.exists(path):
            stored += fs.getContentSummary(path).getLength()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(least, 4 * stored // bytes_per_task)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return partitions


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage and freezes row placement; columnar files let later readers
    prune columns, and they outlive any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
