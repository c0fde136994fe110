"""The effectiveness matrix and its accumulation over batches.

State is kept as mergeable moments per (pattern, next card): row count ``n``, sum of scores ``s``, sum of
squared distances from the mean ``m2`` and sum of prefix lengths ``len_sum``. Merging moments gives the
same matrix however the battles are split into batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from battlelake.functions.scoring import consistency, effectiveness
from battlelake.operators.performance import prefix_rows

MOMENTS = ("n", "s", "m2", "len_sum")


def _merged() -> list[Column]:
    n, s = F.sum("n"), F.sum("s")
    spread = F.sum("m2") + F.sum(F.col("s") * F.col("s") / F.col("n")) - s * s / n
    return [n.alias("n"), s.alias("s"), F.greatest(F.lit(0.0), spread).alias("m2")]


def deck_moments(results: DataFrame) -> DataFrame:
    """Scores per ordered deck; popular decks shrink to one row before any prefix is built."""
    score = F.col("performance_score")
    return results.where(F.size("deck") > 1).groupBy("deck").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(score).alias("s"),
        (F.var_pop(score) * F.count(F.lit(1))).alias("m2"),
    )


def pattern_moments(results: DataFrame) -> DataFrame:
    return (
        prefix_rows(deck_moments(results))
        .groupBy("deck_pattern", "next_card")
        .agg(*_merged(), F.sum(F.col("n") * F.col("sequence_length")).alias("len_sum"))
    )


def merged_by(moments: DataFrame, keys: list[str]) -> DataFrame:
    return moments.groupBy(*keys).agg(*_merged(), F.sum("len_sum").alias("len_sum"))


def merge_moments(*states: DataFrame) -> DataFrame:
    every = reduce(DataFrame.unionByName, states)
    return merged_by(every, [c for c in every.columns if c not in MOMENTS])


def scored(moments: DataFrame, pattern_key: str = "deck_pattern") -> DataFrame:
    """Moments to the matrix columns."""
    n = F.col("n")
    return with_scores(
        moments.select(
            pattern_key,
            "next_card",
            n.alias("total_appearances"),
            (F.col("s") / n).alias("weighted_performance"),
            F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("performance_consistency"),
            (F.col("len_sum") / n).alias("avg_sequence_length"),
        ),
        pattern_key,
    )


def with_scores(matrix: DataFrame, pattern_key: str = "deck_pattern") -> DataFrame:
    appearances = F.col("total_appearances")
    within = F.sum(appearances).over(Window.partitionBy(pattern_key))
    return (
        matrix.withColumn("frequency_score", appearances / within)
        .withColumn("consistency_factor", consistency(F.col("performance_consistency")))
        .withColumn(
            "effectiveness_score",
            effectiveness(
                F.col("frequency_score"),
                F.col("weighted_performance"),
                F.col("consistency_factor"),
            ),
        )
    )


def effectiveness_matrix(results: DataFrame) -> DataFrame:
    return scored(pattern_moments(results))


def accumulate_legacy(old: DataFrame, new: DataFrame, pattern_key: str = "deck_pattern") -> DataFrame:
    """Earlier accumulation: counts add up, everything else is the plain mean of old and new."""
    base = [
        pattern_key, "next_card", "total_appearances", "weighted_performance",
        "performance_consistency", "avg_sequence_length",
    ]
    joined = old.select(*base).unionByName(new.select(*base)).groupBy(pattern_key, "next_card").agg(
        F.sum("total_appearances").alias("total_appearances"),
        F.avg("weighted_performance").alias("weighted_performance"),
        F.avg("performance_consistency").alias("performance_consistency"),
        F.avg("avg_sequence_length").alias("avg_sequence_length"),
    )
    return with_scores(joined, pattern_key)


def popular_cards(matrix: DataFrame) -> DataFrame:
    """Per next card: mean effectiveness and all appearances."""
    return matrix.groupBy("next_card").agg(
        F.avg("effectiveness_score").alias("effectiveness_score"),
        F.sum("total_appearances").alias("total_appearances"),
    )
