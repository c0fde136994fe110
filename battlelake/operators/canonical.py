"""Orientation of a battle's two sides, de-duplication and season assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from battlelake.functions.values import battle_date

# Season number of battles outside all seasons.
NO_SEASON = 0
BATTLE_COLUMNS = ["battle_time", "game_mode", "player1", "player2"]


def _oriented(battles: DataFrame, keep: Column) -> DataFrame:
    as_is = F.struct(F.col("player1").alias("player1"), F.col("player2").alias("player2"))
    swapped = F.struct(F.col("player2").alias("player1"), F.col("player1").alias("player2"))
    rest = [c for c in battles.columns if c not in ("player1", "player2")]
    return battles.withColumn("sides", F.when(keep, as_is).otherwise(swapped)).select(*rest, "sides.*")


def by_tag(battles: DataFrame) -> DataFrame:
    """The larger tag first: one form per battle, whichever player's log it came from."""
    return _oriented(battles, F.col("player1.tag") > F.col("player2.tag"))


def winner_first(battles: DataFrame) -> DataFrame:
    """The winner first. Draws swap as well, so the two views of a draw stay different."""
    return _oriented(battles, F.col("player1.crowns") > F.col("player2.crowns"))


def distinct_battles(oriented: DataFrame) -> DataFrame:
    """One row per battle, compared on every column (no hashes, so no collisions)."""
    return oriented.select(*BATTLE_COLUMNS).distinct()


def canonical_battles(log: DataFrame) -> DataFrame:
    return distinct_battles(by_tag(log))


def winners_first(log: DataFrame) -> DataFrame:
    """Each battle once, the winner first; draws keep the order by tag, in which their two views are one."""
    return _oriented(canonical_battles(log), F.col("player1.crowns") >= F.col("player2.crowns")).select(*BATTLE_COLUMNS)


def season_days(seasons: DataFrame) -> DataFrame:
    """One row per season and day (end exclusive), so that battles find their season by equality."""
    return seasons.select(
        "season",
        F.explode(F.sequence("start_date", F.date_sub("end_date", 1))).alias("battle_date"),
    )


def with_season(battles: DataFrame, seasons: DataFrame) -> DataFrame:
    """The season of each battle; NO_SEASON for those outside all seasons and those without a readable time."""
    dated = battles.withColumn("battle_date", battle_date(F.col("battle_time")))
    return dated.join(season_days(seasons), "battle_date", "left").withColumn(
        "season", F.coalesce("season", F.lit(NO_SEASON))
    )


def season_battles(log: DataFrame, seasons: DataFrame) -> DataFrame:
    """Overlapping files of the log to distinct battles by season and day."""
    return with_season(canonical_battles(log), seasons)


def season_summary(season_rows: DataFrame) -> DataFrame:
    """Games and days per season, with a grand total (season null)."""
    daily = season_rows.groupBy("season", "battle_date").agg(F.count(F.lit(1)).alias("games"))
    return daily.rollup("season").agg(
        F.sum("games").alias("games"), F.count_distinct("battle_date").alias("days")
    )


def last_days(battles: DataFrame, days: int) -> DataFrame:
    """The last ``days`` days on which there were battles, by the column ``battle_date``.

    With a table partitioned by ``battle_date`` only those partitions are read.
    """
    recent = (
        battles.select("battle_date").where(F.col("battle_date").isNotNull()).distinct()
        .orderBy(F.desc("battle_date")).limit(days)
    )
    first = recent.agg(F.min("battle_date")).scalar()
    return battles.where(F.col("battle_date") >= first)
