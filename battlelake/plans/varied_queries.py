"""Registered queries over battles whose decks, prefixes and pairs grow in number with the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from battlelake.operators import als, canonical, decks, frontier, mapping, matrix, performance
from battlelake.plans import queries as batch, training
from battlelake.plans.queries import query
from battlelake.session import cut_lineage
from battlelake.sources import fixtures
from battlelake.sources.varied import varied


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return varied(batch._flat(spark, sf_dir))


def _battles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.nest(_flat(spark, sf_dir))


@query
def varied_pattern_mapping(spark, sf_dir):
    return mapping.new_mapping(performance.known_patterns(performance.player_results(_battles(spark, sf_dir))))


@query
def varied_matrix(spark, sf_dir):
    return batch._rounded_matrix(matrix.scored(training.batch_moments(_battles(spark, sf_dir))))


@query
def varied_accumulated_matrix(spark, sf_dir):
    return batch._rounded_matrix(training.run_batches(batch._batches(_battles(spark, sf_dir))).matrix())


@query
def varied_one_on_one(spark, sf_dir):
    """Battles of two players by class; ranked ones below the floor go."""
    kept = frontier.above_ranked_floor(frontier.one_on_one(_flat(spark, sf_dir)))
    return kept.select("battle_id", "game_mode", frontier.mode_class(F.col("game_mode")).alias("mode_class"))


@query
def varied_frontier(spark, sf_dir):
    """The frontier with one opponent in a third of all battles."""
    flat = _flat(spark, sf_dir)
    return frontier.frontier(flat, flat.where("p1_trophies >= 6500").select(F.col("p1_tag").alias("tag")))


@query
def varied_season_summary(spark, sf_dir):
    """Seasons with battles outside all of them."""
    log = fixtures.battle_log(_battles(spark, sf_dir))
    return canonical.season_summary(canonical.season_battles(log, fixtures.season_dim(spark)))


@query
def varied_pair_stats(spark, sf_dir):
    return batch._pair_text(decks.deck_pair_stats(_flat(spark, sf_dir)))


@query
def varied_folded_in(spark, sf_dir):
    """Patterns that the model was not fitted with: whether the factors found for them solve their normal equations."""
    rated = cut_lineage(training.start(_battles(spark, sf_dir)).matrix())
    unknown = rated.where("deck_pattern_id % 5 = 0")
    model = als.fit(rated.where("deck_pattern_id % 5 <> 0"))
    found = als.residuals(model, unknown, als.fold_in(model, unknown))
    return found.select("deck_pattern_id", "ratings", (F.col("residual") < 1e-9).alias("solved"))
