"""What each micro-batch of a query took in, as a table."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from battlelake.session import get_text, names, put_text

SCHEMA = "query_name string, batch_id bigint, at string, input_rows bigint, metric string, value bigint"


class ProgressTable(StreamingQueryListener):
    """Stores the observed metrics of every batch of the session's queries: one small file per query and batch.

    A batch that is run again replaces its file. Register it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = event.progress
        metrics = {f"{name}.{key}": value for name, row in told.observedMetrics.items() for key, value in row.asDict().items()}
        lines = [
            json.dumps({"query_name": told.name, "batch_id": told.batchId, "at": told.timestamp, "input_rows": told.numInputRows,
                        "metric": metric, "value": value})
            for metric, value in (metrics or {None: None}).items()
        ]
        put_text(self.spark, f"{self.path}/{told.id}-{told.batchId}.json", "\n".join(lines) + "\n")

    def waited(self, run: StreamingQuery, seconds: float = 30.0) -> None:
        """Wait until the last batch of a query that has ended is in the table; events come after their batch."""
        last = run.lastProgress
        until = time.monotonic() + seconds
        while last is not None and get_text(self.spark, f"{self.path}/{run.id}-{last['batchId']}.json") is None:
            if time.monotonic() > until:
                raise TimeoutError("the progress of the last batch has not come")
            time.sleep(0.05)

    def read(self) -> DataFrame:
        if not names(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).json(f"{self.path}/*.json")

    def totals(self) -> DataFrame:
        """Per query and batch: rows taken in and rows that could not be used."""
        kind = F.element_at(F.split("metric", r"\."), -1)
        return self.read().where(F.col("metric").isNotNull()).groupBy("query_name", "batch_id").agg(
            *[F.sum(F.when(kind == name, F.col("value"))).alias(name) for name in ("rows", "quarantined")])
