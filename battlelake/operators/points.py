"""Time-series points of games, cards and players."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from battlelake.functions.values import battle_ts, floor_mean
from battlelake.session import cut_lineage, shuffle_width

GAME_TAGS = ["battle_time", "player1_tag", "player2_tag"]
GAME_FIELDS = ["player1_trophies", "player1_crowns", "player2_trophies", "player2_crowns"]
#: What decides which of several points of one tag set stays: the greatest, field by field (nulls are least).
POINT_ORDER = ["game_mode", *GAME_FIELDS]


def game_points(flat: DataFrame) -> DataFrame:
    """One point per tag set; of points with equal tags the last in ``POINT_ORDER`` stays."""
    return latest_points(game_point_rows(flat))


def latest_points(points: DataFrame, more_keys: list[str] = [], written: list[str] = []) -> DataFrame:  # noqa: B006
    """One point per tag set: the one with the greatest ``written`` columns, then in ``POINT_ORDER``."""
    order = [*written, *POINT_ORDER]
    last = points.groupBy(*more_keys, *GAME_TAGS).agg(F.max(F.struct(*order)).alias("last"))
    return last.select(*[c if c in (*more_keys, *GAME_TAGS) else F.col(f"last.{c}").alias(c) for c in points.columns])


def game_point_rows(flat: DataFrame) -> DataFrame:
    """The point of each battle."""
    return flat.select(
        "battle_time",
        F.col("p1_tag").alias("player1_tag"),
        F.col("p2_tag").alias("player2_tag"),
        "game_mode",
        F.col("p1_trophies").alias("player1_trophies"),
        F.col("p1_crowns").alias("player1_crowns"),
        F.col("p2_trophies").alias("player2_trophies"),
        F.col("p2_crowns").alias("player2_crowns"),
    )


def card_points(flat: DataFrame) -> DataFrame:
    """One point per distinct card of a battle: crowns for minus crowns against, trophies of its owner."""
    card = F.col("card")
    mine, theirs = F.array_contains("p1_deck", card), F.array_contains("p2_deck", card)
    kept = [c for c in ("battle_id", "battle_time", "game_mode") if c in flat.columns]
    crowns = F.when(mine, F.col("p1_crowns")).otherwise(0) - F.when(theirs, F.col("p2_crowns")).otherwise(0)
    trophies = (
        F.when(mine & theirs, floor_mean(F.col("p1_trophies"), F.col("p2_trophies")))
        .when(mine, F.col("p1_trophies"))
        .otherwise(F.col("p2_trophies"))
    )
    return flat.withColumn("card", F.explode(F.array_union("p1_deck", "p2_deck"))).select(
        *kept, "card", crowns.alias("crowns"), trophies.cast("int").alias("trophies")
    )


def long_form(points: DataFrame) -> DataFrame:
    """Wide game points to (tags, field, value)."""
    return points.unpivot(GAME_TAGS, GAME_FIELDS, "field", "value")


def select_points(points: DataFrame, field: str, start: str | None = None, stop: str | None = None,
                  **tags: str) -> DataFrame:
    """Points of one field, within ``start <= battle_time < stop`` and with the given tag values."""
    chosen = points.where(F.col("field") == field)
    if start is not None:
        chosen = chosen.where(F.col("battle_time") >= start)
    if stop is not None:
        chosen = chosen.where(F.col("battle_time") < stop)
    for tag, value in tags.items():
        chosen = chosen.where(F.col(tag) == value)
    return chosen.drop("field")


def join_series(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Two field series side by side, matched on time and both tags (time alone is not unique)."""
    return left.withColumnRenamed("value", left_name).join(
        right.withColumnRenamed("value", right_name), GAME_TAGS
    )


def ordered_series(series: DataFrame, parts: int | None = None) -> DataFrame:
    """Series rows with their place in time within each tag, in range partitions of (tag, time, row).

    The stored rows of a partition are one file in order. A hot player's rows may lie in several: a row's place is its
    place in the file, moved by what the player has in the files before, one row per file and player.
    """
    parts = parts or shuffle_width(series.sparkSession)
    order = ["tag", "battle_time", "side", "trophies"]
    rest = [c for c in series.columns if c not in order]
    ranged = cut_lineage(
        series.repartitionByRange(parts, *order, *rest).sortWithinPartitions(*order, *rest).withColumn("range_no", F.spark_partition_id()))
    placed = ranged.withColumn("file_row", F.col("_metadata.row_index"))
    runs = placed.groupBy("tag", "range_no").agg(F.count(F.lit(1)).alias("n"), F.min("file_row").alias("first"))
    by_range = Window.partitionBy("tag").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        F.col("tag").alias("of_tag"), F.col("range_no").alias("of_range"), (F.coalesce(F.sum("n").over(by_range), F.lit(0)) - F.col("first")).alias("shift"))
    mine = F.col("tag").eqNullSafe(F.col("of_tag")) & (F.col("range_no") == F.col("of_range"))
    return placed.join(starts, mine).select(*series.columns, (F.col("file_row") + F.col("shift") + 1).alias("place"))


def player_trophy_series(points: DataFrame, tag: str | None = None) -> DataFrame:
    """Trophies over time for every player (or one), whichever side they played on.

    Both sides come from one scan of the wide points, so no self join is needed.
    """
    sides = F.array(*[
        F.struct(
            F.col(f"{side}_tag").alias("tag"),
            F.lit(side).alias("side"),
            F.col(f"{side}_trophies").alias("trophies"),
        )
        for side in ("player1", "player2")
    ])
    series = points.select("battle_time", battle_ts(F.col("battle_time")).alias("ts"), F.inline(sides))
    return series if tag is None else series.where(F.col("tag") == tag)
