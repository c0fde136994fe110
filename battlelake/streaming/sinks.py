"""Sinks that stay correct when a batch is written again."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from battlelake.session import get_text, names, put_text


def write_batch(df: DataFrame, batch_id: int, path: str, by: str | None = None) -> None:
    """Each batch has a folder of its own; a replay replaces it instead of adding rows."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop("batch_id")


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Of rows written by several batches under one key, the row of the last batch."""
    rows = spark.read.option("basePath", path).parquet(path)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("batch_id")))
    return rows.withColumn("place", place).where(F.col("place") == 1).drop("place", "batch_id")


class Commits:
    """Several tables that take a batch together: its commit is written last, readers go by the commits.

    Each table has the batch in a folder of its own. A batch without a commit is seen in none of them and is written
    anew when it is run again; a batch with one is left alone. Batches are committed in order, so readers see all up to
    the last commit.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def batches(self) -> list[int]:
        return sorted(int(name) for name in names(self.spark, f"{self.path}/commits"))

    def commit_of(self, batch_id: int) -> dict | None:
        """Writer, and per table the rows, files and checksum of a batch."""
        text = get_text(self.spark, f"{self.path}/commits/{batch_id}")
        return None if text is None else json.loads(text)

    def done(self, batch_id: int, writer: str) -> bool:
        """Whether the batch has been committed; an error if by another query, to which the number means another batch."""
        found = self.commit_of(batch_id)
        if found and found["writer"] != writer:
            raise ValueError(f"batch {batch_id} at {self.path} belongs to the query {found['writer']}, not to {writer}")
        return found is not None

    def write(self, batch_id: int, writer: str, tables: dict[str, DataFrame]) -> None:
        written = {}
        for table, rows in tables.items():
            path, seen = f"{self.path}/{table}/batch_id={batch_id}", Observation()
            write_batch(rows.observe(seen, *_checks(rows)), batch_id, f"{self.path}/{table}")
            stored = self.spark.read.schema(rows.schema).parquet(path)
            found = {"rows": seen.get["rows"], "checksum": str(seen.get["checksum"]), "files": len(stored.inputFiles())}
            if stored.count() != found["rows"]:
                raise OSError(f"{path} does not hold the rows that were written")
            written[table] = found
        put_text(self.spark, f"{self.path}/commits/{batch_id}", json.dumps({"writer": writer, "tables": written}))

    def read(self, table: str) -> DataFrame:
        """The table's committed rows, with the number of their batch."""
        path, last = f"{self.path}/{table}", max(self.batches(), default=-1)
        rows = self.spark.read.option("basePath", path).parquet(path)
        return rows.where(F.col("batch_id") <= last)

    def differing(self, batch_id: int) -> list[str]:
        """Tables whose stored rows are not those that were committed."""
        out = []
        for table, told in self.commit_of(batch_id)["tables"].items():
            rows = self.spark.read.parquet(f"{self.path}/{table}/batch_id={batch_id}")
            found = rows.agg(*_checks(rows)).first()
            if (found["rows"], str(found["checksum"])) != (told["rows"], told["checksum"]):
                out.append(table)
        return out


# A hash is added up in parts of so many bits, so that long sums hold for 2**41 rows.
_PART_BITS = 21


def _checks(rows: DataFrame) -> list[Column]:
    """Number of rows, and a sum over their hashes that doesn't depend on their order.

    The parts of a hash are summed as longs and put together once; decimals would be an object per row.
    """
    hashed, mask = F.xxhash64(*sorted(rows.columns)), 2**_PART_BITS - 1
    parts = [hashed.bitwiseAND(mask), F.shiftright(hashed, _PART_BITS).bitwiseAND(mask), F.shiftright(hashed, 2 * _PART_BITS)]
    sums = [
        F.coalesce(F.sum(part), F.lit(0)).cast("decimal(20,0)") * F.lit(2 ** (_PART_BITS * place)).cast("decimal(13,0)")
        for place, part in enumerate(parts)
    ]
    return [F.count(F.lit(1)).alias("rows"), (sums[0] + sums[1] + sums[2]).cast("decimal(38,0)").alias("checksum")]


class RowWriter:
    """Row-by-row sink: one connection per partition and epoch, opened where the rows are.

    ``connect(partition_id, epoch_id)`` returns an object with ``write(dict)`` and ``close()``.
    """

    def __init__(self, connect: Callable[[int, int], Any]):
        self.connect = connect
        self.connection = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.connection = self.connect(partition_id, epoch_id)
        return True

    def process(self, row) -> None:
        self.connection.write(row.asDict(recursive=True))

    def all_of(self, epoch_id: int) -> Callable:
        """A function that writes the rows of one partition over one connection."""

        def write(rows) -> None:
            self.open(TaskContext.get().partitionId(), epoch_id)
            error = None
            try:
                for row in rows:
                    self.process(row)
            except Exception as failed:
                error = failed
                raise
            finally:
                self.close(error)

        return write

    def close(self, error) -> None:
        if self.connection is not None:
            self.connection.close()
