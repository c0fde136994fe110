"""Alternating least squares on the effectiveness matrix."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, functions as F

from battlelake.operators.mapping import lookup_patterns

# Training parameters. The seed is ours, so that runs can be repeated.
MAX_ITER, REG_PARAM, SEED = 10, 0.01, 42


def fit(matrix: DataFrame) -> ALSModel:
    return ALS(
        userCol="deck_pattern_id", itemCol="next_card", ratingCol="effectiveness_score",
        maxIter=MAX_ITER, regParam=REG_PARAM, coldStartStrategy="drop", seed=SEED,
    ).fit(matrix)


def recommend_patterns(model: ALSModel, patterns: DataFrame, mapping: DataFrame, n: int) -> DataFrame:
    """Top ``n`` next cards per pattern in ``deck_pattern``; unknown patterns give no row."""
    known = lookup_patterns(patterns.select("deck_pattern").distinct(), mapping).where(
        F.col("deck_pattern_id").isNotNull()
    )
    found = model.recommendForUserSubset(known.select("deck_pattern_id"), n)
    return (
        found.select("deck_pattern_id", F.posexplode("recommendations").alias("place", "rec"))
        .join(known, "deck_pattern_id")
        .select(
            "deck_pattern", "deck_pattern_id", (F.col("place") + 1).alias("place"),
            F.col("rec.next_card").cast("int").alias("card_id"),
            F.col("rec.rating").cast("double").alias("score"),
        )
    )


def fold_in(model: ALSModel, ratings: DataFrame) -> DataFrame:
    """(id, features): factors of patterns that the model was not fitted with, from their ratings of cards it knows.

    Each pattern's normal equations are one aggregation over its ratings, ``rank`` numbers wide and high, and are solved
    in its row by elimination; they are positive definite, so no pivot is looked for. Patterns without a known card
    give no row.
    """
    places = range(model.rank)
    items = model.itemFactors.select(F.col("id").alias("next_card"), F.transform("features", lambda x: x.cast("double")).alias("v"))
    rated = ratings.select("deck_pattern_id", "next_card", F.col("effectiveness_score").alias("r")).join(items, "next_card")
    v = F.col("v")
    sums = rated.groupBy(F.col("deck_pattern_id").alias("id")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(v[i] * v[j]).alias(f"a{i}_{j}") for i in places for j in places if i <= j],
        *[F.sum(F.col("r") * v[i]).alias(f"b{i}") for i in places])

    def cell(i: int, j: int) -> Column:
        product = F.col(f"a{min(i, j)}_{max(i, j)}")
        return product + REG_PARAM * F.col("n") if i == j else product

    def eliminated(rows: Column, k: Column) -> Column:
        pivot = F.get(rows, k)
        return F.transform(rows, lambda row, i: F.when(i == k, row).otherwise(
            F.zip_with(row, pivot, lambda x, y: x - y * F.get(row, k) / F.get(pivot, k))))

    system = sums.select("id", F.array(*[F.array(*[cell(i, j) for j in places], F.col(f"b{i}")) for i in places]).alias("rows"))
    solved = system.select("id", F.aggregate(F.sequence(F.lit(0), F.lit(model.rank - 1)), F.col("rows"), eliminated).alias("rows"))
    return solved.select("id", F.transform("rows", lambda row, i: F.get(row, F.lit(model.rank)) / F.get(row, i)).alias("features"))


def residuals(model: ALSModel, matrix: DataFrame, factors: DataFrame | None = None) -> DataFrame:
    """How far each pattern's factors are from solving their normal equations, given the cards' factors.

    ``factors`` (id, features) are the model's own unless given.

    Alternating least squares ends with the patterns: their factors u solve sum((v.u - r) v) + reg n u = 0 over the
    pattern's n ratings r of cards with factors v. ``residual`` is the largest component of that sum relative to the
    largest of sum(r v), so single precision leaves it near 1e-6 and any other factors far above.
    """
    rank = model.rank
    users = (model.userFactors if factors is None else factors).select(F.col("id").alias("deck_pattern_id"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").alias("next_card"), F.col("features").alias("v"))
    places = range(rank)
    rated = matrix.select("deck_pattern_id", "next_card", F.col("effectiveness_score").alias("r")).join(items, "next_card").join(users, "deck_pattern_id")
    predicted = sum((F.col("u")[k].cast("double") * F.col("v")[k] for k in places), F.lit(0.0))
    sums = rated.withColumn("error", predicted - F.col("r")).groupBy("deck_pattern_id").agg(
        F.count(F.lit(1)).alias("ratings"), F.first("u").alias("u"),
        *[F.sum(F.col("error") * F.col("v")[k]).alias(f"e{k}") for k in places],
        *[F.sum(F.col("r") * F.col("v")[k]).alias(f"b{k}") for k in places])
    left = F.greatest(*[F.abs(F.col(f"e{k}") + REG_PARAM * F.col("ratings") * F.col("u")[k]) for k in places])
    size = F.greatest(*[F.abs(F.col(f"b{k}")) for k in places])
    return sums.select("deck_pattern_id", "ratings", (left / F.greatest(size, F.lit(1e-12))).alias("residual"))


def save(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> ALSModel:
    return ALSModel.load(path)
