"""The training stream's state: pattern ids, moments as a log of deltas, one registry.

A batch writes its own moments, the patterns it adds and, last, the registry, whose row for this state has the totals:
so a reader never meets a half-written version, a batch that is run again finds its row and does nothing, and neither
totals nor the next free id are counted over history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from battlelake.operators import als
from battlelake.operators.mapping import ids_after
from battlelake.operators.matrix import merged_by
from battlelake.plans.training import State, batch_moments
from battlelake.schemas import MAPPING, MOMENTS, REGISTRY
from battlelake.session import cut_lineage, get_text, hadoop_path, names, put_text, step_scope
from battlelake.streaming import registry
from battlelake.streaming.delta_log import DeltaLog

PAIR = ["deck_pattern", "next_card"]


def _merge(rows: DataFrame, more_keys: list[str]) -> DataFrame:
    return merged_by(rows, [*more_keys, *PAIR])


class StateTables:
    def __init__(self, spark: SparkSession, path: str, model_name: str = "continuous_als_model", buckets: int = 8, fanout: int = 4):
        self.spark, self.path, self.model_name = spark, path.rstrip("/"), model_name
        self.log = DeltaLog(spark, f"{self.path}/moments", MOMENTS, PAIR, _merge, buckets, fanout)

    def versions(self) -> list[int]:
        return sorted(int(name.split("=")[1]) for name in names(self.spark, f"{self.path}/registry") if "=" in name)

    def latest_version(self) -> int | None:
        return max(self.versions(), default=None)

    def rows(self, number: int | None = None) -> DataFrame:
        """The registry of a version, by default the latest: one row per model name."""
        number = self.latest_version() if number is None else number
        if number is None:
            return registry.empty(self.spark)
        return self.spark.read.schema(REGISTRY).parquet(f"{self.path}/registry/version={number}")

    def _mapping(self, number: int) -> DataFrame:
        """Ids never change, so every version only adds a part to the mapping."""
        path = f"{self.path}/mapping"
        rows = self.spark.read.schema(f"{MAPPING}, version bigint").option("basePath", path).parquet(path)
        return rows.where(F.col("version") <= number).drop("version")

    def load(self, number: int | None = None) -> State | None:
        """The state of a version, by default the latest; None before the first batch."""
        number = self.latest_version() if number is None else number
        if number is None:
            return None
        return State(self._mapping(number), self.log.read(number), self.log.delta(number))

    def _claim(self, writer: str) -> None:
        """A batch number means something to the query that counts it only: one state, one writer."""
        path = f"{self.path}/writer"
        known = get_text(self.spark, path)
        if known is None:
            put_text(self.spark, path, writer)
        elif known != writer:
            raise ValueError(f"the state at {self.path} belongs to the query {known}, not to {writer}")

    def apply(self, battles: DataFrame, batch_id: int, with_model: bool = False, writer: str | None = None) -> bool:
        """Add one batch; False when it was already applied or holds no sequence.

        With ``writer``, an error where another one has written the state: its batch numbers would pass for known.
        """
        if writer is not None:
            self._claim(writer)
        number = self.latest_version()
        if number is not None and number >= batch_id:
            return False
        with step_scope(self.spark):
            return self._apply(battles, batch_id, number, with_model)

    def _apply(self, battles: DataFrame, batch_id: int, number: int | None, with_model: bool) -> bool:
        fresh = cut_lineage(batch_moments(battles))
        if fresh.isEmpty():
            return False
        patterns, pairs, unseen = 0, 0, fresh.select(*PAIR)
        new = fresh.select("deck_pattern").distinct()
        if number is not None:
            total = self.rows(number).where(F.col("model_name") == self.model_name).first()
            patterns, pairs = total["total_patterns"], total["total_training_samples"]
            new = new.join(self._mapping(number), "deck_pattern", "left_anti")
            # The unmerged parts will do to know a pair, and only its two columns are read.
            unseen = unseen.join(self.log._rows_of(self.log.manifest(number)["parts"]).select(*PAIR), PAIR, "left_anti")
        pairs += unseen.count()
        patterns += registry.saved(ids_after(new, patterns), f"{self.path}/mapping/version={batch_id}")
        self.log.commit(batch_id, fresh)
        paths = {
            "mapping_path": f"{self.path}/mapping", "matrix_path": f"{self.path}/moments/data/{batch_id}-delta",
            "training_path": f"{self.path}/moments/manifest/{batch_id}",
        }
        if with_model:
            saved = State(self._mapping(batch_id), self.log.read(batch_id), fresh)
            paths["model_path"] = f"{self.path}/models/version={batch_id}"
            als.save(als.fit(cut_lineage(saved.matrix())), paths["model_path"])
        row = registry.row(self.model_name, battles.agg(F.max("battle_time")), patterns, pairs, paths)
        registry.saved(registry.upsert(self.rows(number), row), f"{self.path}/registry/version={batch_id}")
        self._retire(batch_id)
        return True

    def _retire(self, batch_id: int) -> None:
        """Registries and models of versions whose moments are gone."""
        kept = self.log.versions()[0]
        for table in ("registry", "models"):
            for name in names(self.spark, f"{self.path}/{table}"):
                if "=" in name and int(name.split("=")[1]) < kept:
                    target, files = hadoop_path(self.spark, f"{self.path}/{table}/{name}")
                    files.delete(target, True)
