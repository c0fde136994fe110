"""Dense, stable integer ids for deck patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from battlelake.session import cut_lineage, shuffle_width

def dense_ids(keys: DataFrame, key: str, id_name: str, start: int = 0) -> DataFrame:
    """Ids start+1, start+2, … in the order of ``key``, without sorting everything in one task.

    The distinct keys are spread by range, sorted and stored, one file for each range. A row's place in its file
    (``_metadata.row_index``) and the rows of the files before it make its id, so nothing is shuffled or sorted again.
    One number per file reaches the driver.
    """
    spark = keys.sparkSession
    stored = cut_lineage(
        keys.select(key).repartitionByRange(shuffle_width(spark), key).sortWithinPartitions(key)
        .withColumn("range_no", F.spark_partition_id())
    )
    # A file may be split over tasks and several files may share one; the range number says where a row belongs.
    counts = sorted((row["range_no"], row["n"]) for row in
                    stored.groupBy("range_no").agg(F.count(F.lit(1)).alias("n")).collect())
    before, earlier = start, {}
    for range_no, n in counts:
        earlier[range_no] = before
        before += n
    offset = F.get(F.lit([earlier.get(i, 0) for i in range(max(earlier, default=0) + 1)]), F.col("range_no"))
    return stored.select(key, (offset + F.col("_metadata.row_index") + 1).cast("int").alias(id_name))


def new_mapping(patterns: DataFrame) -> DataFrame:
    return dense_ids(patterns.select("deck_pattern").distinct(), "deck_pattern", "deck_pattern_id")


def added_ids(mapping: DataFrame, patterns: DataFrame) -> DataFrame:
    """Ids of the patterns not in the mapping, after its highest id, in pattern order."""
    unknown = (
        patterns.select("deck_pattern").distinct().join(mapping, "deck_pattern", "left_anti")
    )
    return ids_after(unknown, mapping.agg(F.max("deck_pattern_id")).first()[0] or 0)


def ids_after(unknown: DataFrame, highest: int) -> DataFrame:
    return dense_ids(unknown, "deck_pattern", "deck_pattern_id", start=highest)


def extend_mapping(mapping: DataFrame, patterns: DataFrame) -> DataFrame:
    """Known patterns keep their id; unknown ones are added."""
    known = mapping.select("deck_pattern", "deck_pattern_id")
    return known.unionByName(added_ids(mapping, patterns))


def with_pattern_ids(by_pattern: DataFrame, mapping: DataFrame) -> DataFrame:
    """Replace the pattern by its id; done on aggregated rows, never on raw sequences."""
    rest = [c for c in by_pattern.columns if c != "deck_pattern"]
    return by_pattern.join(mapping, "deck_pattern").select("deck_pattern_id", *rest)


def lookup_patterns(requests: DataFrame, mapping: DataFrame) -> DataFrame:
    """Exact pattern look-up; unknown patterns get a null id."""
    return requests.join(mapping, "deck_pattern", "left")
