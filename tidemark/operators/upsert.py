"""Keyed upsert into Parquet with atomic, partition-wise commits.

A table has two folders. ``data/commit=<id>/<partition>=…`` holds files that are
never changed once written; the small file ``pointer/<N>.json`` names, for every
partition value, the commit that currently holds it. A merge writes new copies of
the touched partitions only, then one pointer, put in place by a rename; readers
use the highest pointer. A job that dies before the rename leaves the table as it
was, and the cost of a merge follows the touched partitions, not the table.

One writer at a time; a second one is refused when it tries to commit.

What a merge writes is counted while it is written. A merge that breaks a rule is never
published: its files stay aside, and readers keep the version before.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import hadoop_path, materialise, scratch
from tidemark.operators.quality import Rule, enforce_observed, observe_rules
from tidemark.operators.ranking import keep_first

_POINTER = re.compile(r"(\d+)\.json")
# Fixed value: how long replaced files stay.
RETENTION_HOURS = 168

_PLAIN = re.compile(r"[A-Za-z0-9_.-]+")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the source, plus every source row.

    The source must be unique on the keys and have no null key: null never
    matches, so a repeated run would insert the row again.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(source, allowMissingColumns=True)


def merge_in_order(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The first row per key, in ``order``, of target and source together.

    Which row wins does not depend on which arrived first, so batches may come late, twice
    or in any order, and the source may repeat keys. One shuffle on the keys does it all.
    """
    return keep_first(target.unionByName(source, allowMissingColumns=True), keys, order)


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


class VersionedTable:
    """A Parquet table that is replaced partition by partition.

    ``partition`` must be a function of ``keys`` (the date of a key timestamp,
    say), so that equal keys always meet in the same partition. Its values are
    few: they are listed on the driver, like the partitions of any table.

    With ``order``, the first row of a key in that order wins, stored or new. Without,
    the last writer wins and a source must not repeat a key.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        partition: str,
        order: Sequence[Column] = (),
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.partition = partition
        self.order = list(order)

    def version(self) -> int:
        """Number of the newest pointer, 0 for a new table."""
        path, fs = self._path(f"{self.root}/pointer")
        if not fs.exists(path):
            return 0
        names = (_POINTER.fullmatch(s.getPath().getName()) for s in fs.listStatus(path))
        return max((int(n[1]) for n in names if n), default=0)

    def read(self, values: Sequence[str] | None = None) -> DataFrame | None:
        """Current rows, or those of some partitions; None when there are none.

        Only the directories named by the pointer are listed and scanned.
        """
        return self._rows(self._pointer(self.version()), values)

    def _rows(self, pointer: dict, values: Sequence[str] | None) -> DataFrame | None:
        wanted = None if values is None else set(values)
        entries = {
            v: c for v, c in pointer["partitions"].items() if wanted is None or v in wanted
        }
        if not entries:
            return None
        columns = T.StructType.fromJson(pointer["columns"])
        paths = [self._folder(c, v) for v, c in entries.items()]
        return (
            self.spark.read.schema(columns)
            .option("basePath", f"{self.root}/data")
            .parquet(*paths)
            .select(*columns.names)
        )

    def merge(self, source: DataFrame, rules: Sequence[Rule] = ()) -> int:
        """Upsert ``source`` and return the committed version.

        ``rules`` are counted on the rows of the touched partitions as they are written; if
        an error rule is broken, ``QualityError`` is raised and nothing becomes visible.
        """
        with scratch(self.spark):
            return self._merge(source, rules)

    def _merge(self, source: DataFrame, rules: Sequence[Rule]) -> int:
        base = self.version()
        # Written once: it is read for the partitions it touches and for the merge.
        source = materialise(source, "upsert")
        touched = self._touched(source)
        if not touched:
            return base
        pointer = self._pointer(base)
        affected = self._rows(pointer, touched)
        if self.order:
            known = source.limit(0) if affected is None else affected
            merged = merge_in_order(known, source, self.keys, self.order)
        else:
            merged = source if affected is None else merge_rows(affected, source, self.keys)
        partitions = pointer["partitions"] | dict.fromkeys(touched, self._write(merged, rules))
        self._commit(base + 1, pointer | {"columns": merged.schema.jsonValue(), "partitions": partitions})
        return base + 1

    def replace(self, source: DataFrame, values: Sequence[str], **notes: int) -> int:
        """Put ``source`` in place of the partitions ``values``, keeping all others.

        For derived tables, whose partitions are computed again from scratch.
        ``notes`` are kept with the version.
        """
        base = self.version()
        pointer = self._pointer(base)
        commit = self._write(source)
        written = {v for v in values if self._exists(f"{self._folder(commit, v)}")}
        kept = {v: c for v, c in pointer["partitions"].items() if v not in set(values)}
        self._commit(
            base + 1,
            {
                "columns": source.schema.jsonValue(),
                "partitions": kept | dict.fromkeys(sorted(written), commit),
                "notes": notes,
            },
        )
        return base + 1

    def notes(self) -> dict[str, int]:
        return self._pointer(self.version()).get("notes", {})

    def changed_since(self, version: int) -> list[str]:
        """Partition values written after ``version``, from the two pointers alone.

        All of them if there is no such version.
        """
        now = self._pointer(self.version())["partitions"]
        if version and not self._exists(f"{self.root}/pointer/{version}.json"):
            return sorted(now)
        before = self._pointer(version)["partitions"]
        return sorted(v for v, c in now.items() if before.get(v) != c)

    def _write(self, rows: DataFrame, rules: Sequence[Rule] = ()) -> str:
        """Write a commit that no pointer names yet, and check the rules on it."""
        commit = uuid.uuid4().hex
        staged, seen = observe_rules(rows.hint("rebalance", self.partition), rules)
        staged.write.partitionBy(self.partition).parquet(f"{self.root}/data/commit={commit}")
        enforce_observed(seen, rules)
        return commit

    def _folder(self, commit: str, value: str) -> str:
        return f"{self.root}/data/commit={commit}/{self.partition}={value}"

    def _exists(self, text: str) -> bool:
        path, fs = self._path(text)
        return fs.exists(path)

    def expire(self, hours: float = RETENTION_HOURS) -> int:
        """Delete commits that no version of the last ``hours`` uses; returns how many.

        A version was in use until the next one was written, so its age counts from
        there. Files younger than ``hours`` are kept as well: they may belong to a running
        merge. Pointers stay, so that a reader of changes finds any version it noted.
        """
        newest = self.version()
        if newest == 0:
            return 0
        oldest_ms = (time.time() - hours * 3600) * 1000
        folder, fs = self._path(f"{self.root}/pointer")
        written = {}
        for status in fs.listStatus(folder):
            if name := _POINTER.fullmatch(status.getPath().getName()):
                written[int(name[1])] = status.getModificationTime()
        used: set[str] = set()
        for number in written:
            if number == newest or written.get(number + 1, oldest_ms) >= oldest_ms:
                used |= set(self._pointer(number)["partitions"].values())
        folder, _ = self._path(f"{self.root}/data")
        unused = [
            s.getPath()
            for s in fs.listStatus(folder)
            if s.getPath().getName().removeprefix("commit=") not in used
            and s.getModificationTime() < oldest_ms
        ]
        for path in unused:
            fs.delete(path, True)
        return len(unused)

    def register(self, name: str) -> bool:
        """(Re)register the current state as table ``name``; False when there is none.

        The catalog keeps one location per partition, so readers of the table
        never see files of replaced commits. Run it again after a merge.
        """
        pointer = self._pointer(self.version())
        if not pointer["partitions"]:
            return False
        columns = T.StructType.fromJson(pointer["columns"])
        listed = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields
        )
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(
            f"CREATE TABLE {name} ({listed}) USING parquet "
            f"PARTITIONED BY (`{self.partition}`) LOCATION '{_literal(self.root)}/data'"
        )
        places = " ".join(
            f"PARTITION (`{self.partition}`='{value}') LOCATION "
            f"'{_literal(self._folder(commit, value))}'"
            for value, commit in sorted(pointer["partitions"].items())
        )
        self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
        return True

    def _commit(self, number: int, pointer: dict) -> None:
        """Write the pointer aside, then rename it; the rename fails if the name is taken."""
        final, fs = self._path(f"{self.root}/pointer/{number}.json")
        aside, _ = self._path(f"{self.root}/pointer/.{uuid.uuid4().hex}")
        stream = fs.create(aside, False)
        try:
            stream.write(bytearray(json.dumps(pointer).encode()))
        finally:
            stream.close()
        if fs.exists(final) or not fs.rename(aside, final):
            fs.delete(aside, False)
            raise RuntimeError(f"{self.root}: version {number} has another writer")

    def _pointer(self, number: int) -> dict:
        if number == 0:
            return {"columns": None, "partitions": {}}
        path, fs = self._path(f"{self.root}/pointer/{number}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _path(self, text: str):
        return hadoop_path(self.spark, text)

    def _touched(self, source: DataFrame) -> list[str]:
        """Partition values of the source, after checking its keys in the same job.

        A null key would break repeatability, so it is an error, and so is a repeated key
        unless an order tells which row wins. With an order only one small row per task and
        partition value is shuffled.
        """
        part = F.col(self.partition)
        missing = part.isNull()
        for key in self.keys:
            missing = missing | F.col(key).isNull()
        rows = source.select(part.cast("string").alias("_part"), missing.alias("_missing"), F.lit(False).alias("_repeated"))
        if not self.order:
            rows = source.groupBy(*self.keys).agg(
                F.min(part).cast("string").alias("_part"),
                F.bool_or(missing).alias("_missing"),
                (F.count(F.lit(1)) > 1).alias("_repeated"),
            )
        found = (
            rows.groupBy("_part")
            .agg(F.bool_or("_repeated").alias("_repeated"), F.bool_or("_missing").alias("_missing"))
            .collect()
        )
        for problem in ("missing", "repeated"):
            if bad := [r["_part"] for r in found if r[f"_{problem}"]]:
                raise ValueError(f"upsert source has {problem} keys {self.keys} in {bad[:3]}")
        if odd := [r["_part"] for r in found if not _PLAIN.fullmatch(r["_part"])]:
            raise ValueError(f"partition values must be plain text, got {odd[:3]}")
        return [r["_part"] for r in found]
