"""Streaming sources: a topic, or a folder of record files in its place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from battlelake.sources import logs


def topic(
    spark: SparkSession, servers: str, name: str, starting_offsets: str = "earliest", **options: str
) -> DataFrame:
    """One Kafka topic. The connector package comes with the cluster, not with this library."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return with_origin(reader.options(subscribe=name, startingOffsets=starting_offsets, **options).load())


def with_origin(records: DataFrame) -> DataFrame:
    """Topic records with the place that tells each from all others."""
    return records.withColumn("origin", F.concat_ws("/", "topic", "partition", "offset"))


def all_topics(spark: SparkSession, servers: str, excluded: list[str], **options: str) -> DataFrame:
    """Every topic but the excluded ones, from the earliest offset."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    stream = reader.options(subscribePattern=".*", startingOffsets="earliest", **options).load()
    return logs.except_topics(stream, excluded)


def record_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files with one record per line, as column ``value``, and their file in ``origin``."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("origin"))


def battles(records: DataFrame) -> DataFrame:
    return logs.decode(records)


def parsed_battles(records: DataFrame) -> DataFrame:
    """Battles with their record, and the reason of those that cannot be used."""
    return logs.parsed(records)


def service_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log lines from the beginning, new files as they come."""
    return logs.log_lines(spark.readStream.text(path))
