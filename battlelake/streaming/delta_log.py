"""A table kept as a log of deltas: a batch writes what is new, readers merge, old deltas are folded in levels.

Rows are dealt to buckets by a hash of their key. A version adds one delta. When a bucket has ``fanout`` parts of a
level, they are merged into one of the next level; buckets take turns, so a version folds a share of them and the rows
written for it stay near those of its delta, however long the history is. A version is its manifest, written last: it
lists the parts to be merged. Parts that none of the last ``keep`` versions lists are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from battlelake.session import get_text, hadoop_path, names, put_text
from battlelake.streaming.registry import saved


class Part(NamedTuple):
    folder: str
    bucket: int
    level: int
    rows: int


class DeltaLog:
    """``merge(rows, more_keys)`` folds rows of equal key; it has to give the same in whatever order parts meet."""

    def __init__(
        self, spark: SparkSession, path: str, schema: str, key: list[str],
        merge: Callable[[DataFrame, list[str]], DataFrame], buckets: int = 8, fanout: int = 4, keep: int = 2,
    ):
        self.spark, self.path, self.schema, self.key, self.merge = spark, path.rstrip("/"), schema, key, merge
        self.buckets, self.fanout, self.keep = buckets, fanout, max(2, keep)

    def versions(self) -> list[int]:
        return sorted(int(name) for name in names(self.spark, f"{self.path}/manifest"))

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def manifest(self, version: int) -> dict:
        """``parts``, the number of versions so far and the rows that this one wrote."""
        found = json.loads(get_text(self.spark, f"{self.path}/manifest/{version}"))
        return found | {"parts": [Part(*p) for p in found["parts"]]}

    def _rows_of(self, parts: list[Part]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{p.folder}/bucket={p.bucket}" for p in parts])

    def read(self, version: int | None = None) -> DataFrame:
        """The table of a version, by default the latest: one row per key."""
        version = self.latest() if version is None else version
        return self.merge(self._rows_of([] if version is None else self.manifest(version)["parts"]), [])

    def delta(self, version: int) -> DataFrame:
        """What a version added; there as long as the version is kept."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{version}-delta")

    def _written(self, rows: DataFrame, folder: str, level_of: Callable[[int], int]) -> list[Part]:
        """Store rows that have a bucket, and list the parts they make."""
        path = f"{self.path}/data/{folder}"
        saved(rows, path, by="bucket")
        counts = self.spark.read.schema(f"{self.schema}, bucket int").parquet(path).groupBy("bucket").count().collect()
        return [Part(folder, r["bucket"], level_of(r["bucket"]), r["count"]) for r in counts]

    def _due(self, parts: list[Part], turn: int) -> dict[int, list[Part]]:
        """Of each bucket whose turn it is: its lowest parts, as many levels of them as are full."""
        due = {}
        for bucket in range(self.buckets):
            if (turn + bucket) % self.fanout:
                continue
            chosen, level = [], 0
            while True:
                here = [p for p in parts if p.bucket == bucket and p.level == level]
                if len(here) + bool(chosen) < self.fanout:
                    break
                chosen += here
                level += 1
            if chosen:
                due[bucket] = chosen
        return due

    def commit(self, version: int, rows: DataFrame) -> int:
        """Add a delta as ``version``, above all before it; again, the same rows replace it. Rows written in all."""
        before = max((v for v in self.versions() if v < version), default=None)
        known = {"parts": [], "turn": 0} if before is None else self.manifest(before)
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int").alias("bucket")
        delta = self._written(rows.select("*", bucket), f"{version}-delta", lambda _: 0)
        written, parts, turn = sum(p.rows for p in delta), known["parts"] + delta, known["turn"] + 1
        if due := self._due(parts, turn):
            levels = {b: 1 + max(p.level for p in own) for b, own in due.items()}
            every = None
            for b, own in due.items():
                part = self._rows_of(own).withColumn("bucket", F.lit(b))
                every = part if every is None else every.unionByName(part)
            merged = self._written(self.merge(every, ["bucket"]), f"{version}-merged", levels.get)
            gone = {p for own in due.values() for p in own}
            parts = [p for p in parts if p not in gone] + merged
            written += sum(p.rows for p in merged)
        put_text(self.spark, f"{self.path}/manifest/{version}", json.dumps({"parts": parts, "turn": turn, "written": written}))
        self._retire(version)
        return written

    def _retire(self, version: int) -> None:
        """Forget versions beyond the last ``keep`` and delete the folders that no other version needs."""
        kept = [v for v in self.versions() if v <= version][-self.keep:]
        needed = {p.folder for v in kept for p in self.manifest(v)["parts"]} | {f"{v}-delta" for v in kept}
        for folder in names(self.spark, f"{self.path}/data"):
            if folder not in needed and int(folder.split("-")[0]) < version:
                target, files = hadoop_path(self.spark, f"{self.path}/data/{folder}")
                files.delete(target, True)
        for old in self.versions():
            if old < kept[0]:
                target, files = hadoop_path(self.spark, f"{self.path}/manifest/{old}")
                files.delete(target, False)
