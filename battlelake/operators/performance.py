"""Battles to one scored row per player, and decks to (prefix, next card) sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from battlelake.functions.decks import pattern_of
from battlelake.functions.scoring import outcome, trophy_boost


def flatten(battles: DataFrame) -> DataFrame:
    """Nested battle to flat columns; other columns are kept in front."""
    fields = ("tag", "trophies", "crowns", "deck")
    kept = [c for c in battles.columns if c not in ("player1", "player2")]
    return battles.select(
        *kept,
        *[F.col(f"player1.{name}").alias(f"p1_{name}") for name in fields],
        *[F.col(f"player2.{name}").alias(f"p2_{name}") for name in fields],
    )


def with_outcomes(flat: DataFrame) -> DataFrame:
    """Each player's outcome from their own crowns and the other's."""
    p1, p2 = F.col("p1_crowns"), F.col("p2_crowns")
    return flat.withColumns({"p1_outcome": outcome(p1, p2), "p2_outcome": outcome(p2, p1)})


def player_results(battles: DataFrame, legacy: bool = False) -> DataFrame:
    """Two rows per battle, one per player, from a single scan.

    ``legacy`` scores player 2 on player 1's outcome, as the earlier pipeline did.
    """
    flat = with_outcomes(flatten(battles))

    def side(number: int, own: str, opponent: str, scored_on: str) -> Column:
        return F.struct(
            F.lit(number).alias("side"),
            F.col(f"{own}_tag").alias("tag"),
            F.col(f"{own}_deck").alias("deck"),
            F.col(f"{own}_trophies").alias("trophies"),
            F.col(f"{opponent}_trophies").alias("opponent_trophies"),
            F.col(f"{own}_outcome").alias("outcome"),
            trophy_boost(
                F.col(f"{own}_trophies"), F.col(f"{opponent}_trophies"), F.col(scored_on)
            ).alias("performance_score"),
        )

    sides = F.array(
        side(1, "p1", "p2", "p1_outcome"),
        side(2, "p2", "p1", "p1_outcome" if legacy else "p2_outcome"),
    )
    kept = [c for c in ("battle_id", "battle_time", "game_mode") if c in flat.columns]
    return flat.select(*kept, F.inline(sides))


def prefix_rows(decks: DataFrame) -> DataFrame:
    """One row per prefix of ``deck``: its pattern, the card that follows and the prefix length.

    Decks of fewer than two cards, empty and null decks give no row.
    """
    kept = [c for c in decks.columns if c != "deck"]
    followers = F.slice("deck", 2, F.greatest(F.size("deck") - 1, F.lit(0)))
    return (
        decks.where(F.size("deck") > 1)
        .select("*", F.posexplode(followers).alias("place", "next_card"))
        .select(
            *kept,
            pattern_of(F.slice("deck", 1, F.col("place") + 1)).alias("deck_pattern"),
            "next_card",
            (F.col("place") + 1).alias("sequence_length"),
        )
    )


def deck_sequences(results: DataFrame) -> DataFrame:
    return prefix_rows(results.select("battle_id", "side", "deck", "performance_score"))


def known_patterns(results: DataFrame) -> DataFrame:
    """Distinct patterns, built from distinct decks."""
    return prefix_rows(results.select("deck").distinct()).select("deck_pattern").distinct()
