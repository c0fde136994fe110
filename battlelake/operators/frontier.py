"""Mode filters and the frontier of players to ask for next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from battlelake.sources.dims import LADDER_MODES, ONE_ON_ONE_MODES, RANKED_MODES

# Trophies the crawl steers to, and the skill floor of ranked opponents.
TROPHY_TARGET = 10_000
RANKED_FLOOR = 31


def mode_class(mode: Column) -> Column:
    return F.when(mode.isin(LADDER_MODES), "ladder").when(mode.isin(RANKED_MODES), "ranked").otherwise("other")


def one_on_one(battles: DataFrame) -> DataFrame:
    return battles.where(F.col("game_mode").isin(ONE_ON_ONE_MODES))


def above_ranked_floor(flat: DataFrame) -> DataFrame:
    low = F.col("p2_trophies") < RANKED_FLOOR
    return flat.where(~(F.col("game_mode").isin(RANKED_MODES) & low))


def frontier(
    flat: DataFrame, requested: DataFrame,
    ranked_target: int = TROPHY_TARGET, ladder_target: int = TROPHY_TARGET,
) -> DataFrame:
    """Opponents not asked for yet, with their distance to the target at the latest ranked and ladder battle.

    ``requested``: tags already asked for. Missing classes give distance 0 and an empty time.
    """
    candidates = (
        above_ranked_floor(one_on_one(flat))
        .withColumn("mode_class", mode_class(F.col("game_mode")))
        .where(F.col("mode_class") != "other")
        .select(F.col("p2_tag").alias("tag"), "mode_class", "battle_time", "battle_id", "p2_trophies")
    )

    def latest(kind: str, target: int) -> Column:
        # Of two battles at the same time the first one listed (lower id) counts.
        row = F.struct("battle_time", -F.col("battle_id"), F.abs(F.col("p2_trophies") - target).alias("distance"))
        return F.max(F.when(F.col("mode_class") == kind, row))

    found = candidates.groupBy("tag").agg(
        latest("ranked", ranked_target).alias("ranked"), latest("ladder", ladder_target).alias("ladder")
    )
    # One row per tag by now: an opponent met by everybody is no more to move than any other.
    return found.join(requested.select("tag").distinct(), "tag", "left_anti").select(
        "tag",
        F.coalesce("ranked.distance", F.lit(0)).alias("ranked_trophies"),
        F.coalesce("ladder.distance", F.lit(0)).alias("ladder_trophies"),
        F.coalesce("ranked.battle_time", F.lit("")).alias("last_ranked_battle"),
        F.coalesce("ladder.battle_time", F.lit("")).alias("last_ladder_battle"),
    )


def next_players(players: DataFrame, k: int) -> DataFrame:
    """The next ``k`` players in priority order."""
    return players.orderBy(
        "ranked_trophies", "ladder_trophies", "last_ranked_battle", "last_ladder_battle", "tag"
    ).limit(k)


def crawl_counters(flat: DataFrame) -> DataFrame:
    return flat.agg(
        F.count(F.lit(1)).alias("battles"), F.count_distinct("p1_tag").alias("players")
    )
