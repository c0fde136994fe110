"""Model registry rows, table profiles and the request log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from battlelake.functions.values import battle_ts
from battlelake.schemas import REGISTRY


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY)


def row(
    model_name: str, last_time: DataFrame, mapping: DataFrame | int, training: DataFrame | int,
    paths: dict[str, str] | None = None,
) -> DataFrame:
    """One registry row; ``last_time`` holds the latest battle time in its only cell.

    Totals that are known already are given as numbers instead of the tables.
    """
    paths = paths or {}

    def total(of: DataFrame | int) -> Column:
        return F.lit(of).cast("bigint") if isinstance(of, int) else of.agg(F.count(F.lit(1))).scalar()

    return last_time.sparkSession.range(1).select(
        F.lit(model_name).alias("model_name"),
        battle_ts(last_time.scalar()).alias("timestamp"),
        *[
            F.lit(paths.get(name)).cast("string").alias(name)
            for name in ("model_path", "mapping_path", "matrix_path", "training_path")
        ],
        total(mapping).alias("total_patterns"),
        total(training).alias("total_training_samples"),
    )


def upsert(existing: DataFrame, new: DataFrame, key: str = "model_name") -> DataFrame:
    """New rows replace those of the same name."""
    both = existing.withColumn("is_new", F.lit(0)).unionByName(new.withColumn("is_new", F.lit(1)))
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("is_new")))
    return both.withColumn("place", place).where(F.col("place") == 1).drop("place", "is_new")


def append(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new)


def latest(rows: DataFrame, model_name: str | None = None) -> DataFrame:
    chosen = rows if model_name is None else rows.where(F.col("model_name") == model_name)
    return chosen.orderBy(F.desc("timestamp")).limit(1)


def profile(mapping: DataFrame, matrix: DataFrame) -> DataFrame:
    """Pattern count, matrix size and totals in one row."""
    totals = matrix.agg(
        F.count(F.lit(1)).alias("matrix_rows"),
        F.count_distinct("next_card").alias("cards"),
        F.sum("total_appearances").alias("samples"),
    )
    return totals.select(
        mapping.agg(F.count(F.lit(1))).scalar().alias("patterns"),
        "matrix_rows",
        F.lit(len(matrix.columns)).alias("matrix_columns"),
        "cards",
        "samples",
    )


def samples(rows: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows that stand for all: those whose keys have the least digests, the same ones at every run."""
    return rows.orderBy(F.md5(F.col(key).cast("string").cast("binary")), key).limit(n)


def audit_log(requests: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Each answered request with its recommendations in order (at most ten per request)."""
    answers = recommendations.groupBy("request_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "card_id", "score"))).alias("recommendations")
    )
    return requests.select("request_id", "partial_deck").join(answers, "request_id")


def write_audit_log(log: DataFrame, path: str) -> None:
    """Append answered requests with the time they were answered."""
    log.withColumn("request_timestamp", F.current_timestamp()).write.mode("append").parquet(path)


def saved(df: DataFrame, path: str, by: str | None = None) -> int:
    """Write a table in the place of an earlier one and read it back: its rows, after checking them and the columns.

    The rows are counted while they are written; reading back takes the counts in the files' footers.
    """
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    count = seen.get["n"]
    if stored.count() != count or (count and set(df.sparkSession.read.parquet(path).columns) != set(df.columns)):
        raise OSError(f"{path} does not hold the table that was saved")
    return count


def verify_saved(df: DataFrame, path: str) -> tuple[int, list[str]]:
    """Read a saved table back: its rows and columns, after checking that both equal what was saved."""
    spark = df.sparkSession
    stored = spark.read.parquet(path)
    count, columns = stored.count(), stored.columns
    if columns != df.columns or count != df.count():
        raise IOError(f"{path} does not hold the table that was saved")
    return count, columns
