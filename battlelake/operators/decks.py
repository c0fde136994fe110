"""Deck-against-deck results, deck filters and multi-hot tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from battlelake.functions.decks import bit_text, contains_all, contains_none, file_cards, multi_hot
from battlelake.schemas import DECK_SIZE
from battlelake.sources.dims import map_of


def without_mirrors(flat: DataFrame, any_order: bool = False) -> DataFrame:
    """Drop battles of equal decks: position by position, or as sets with ``any_order``."""
    first, second = F.col("p1_deck"), F.col("p2_deck")
    if any_order:
        first, second = F.sort_array(first), F.sort_array(second)
    return flat.where(first != second)


def deck_pair_stats(flat: DataFrame, any_order: bool = False) -> DataFrame:
    """Wins and losses of the smaller sorted deck against the larger, draws and mirrors left out."""
    decided = without_mirrors(flat, any_order).where(F.col("p1_crowns") != F.col("p2_crowns"))
    oriented = decided.select(
        F.sort_array("p1_deck").alias("first"),
        F.sort_array("p2_deck").alias("second"),
        (F.col("p1_crowns") > F.col("p2_crowns")).alias("first_won"),
    )
    in_order = F.col("first") <= F.col("second")
    won = F.when(in_order, F.col("first_won")).otherwise(~F.col("first_won"))
    return (
        oriented.select(
            F.least("first", "second").alias("deck_a"),
            F.greatest("first", "second").alias("deck_b"),
            won.cast("bigint").alias("wins"),
            (~won).cast("bigint").alias("losses"),
        )
        .groupBy("deck_a", "deck_b")
        .agg(F.sum("wins").alias("wins"), F.sum("losses").alias("losses"))
    )


def merge_deck_stats(*stats: DataFrame) -> DataFrame:
    """Add up any number of deck-pair tables."""
    every = stats[0]
    for more in stats[1:]:
        every = every.unionByName(more)
    return every.groupBy("deck_a", "deck_b").agg(
        F.sum("wins").alias("wins"), F.sum("losses").alias("losses")
    )


def flat_deck_columns(stats: DataFrame) -> DataFrame:
    """The file form: sixteen card columns, wins and losses."""
    cards = [
        card.alias(f"{deck[-1]}{i}")
        for deck in ("deck_a", "deck_b") for i, card in enumerate(file_cards(F.col(deck)), 1)
    ]
    return stats.select(*cards, "wins", "losses")


def write_deck_file(stats: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The pair table as CSV, in deck order across and within the files."""
    flat_deck_columns(stats.orderBy("deck_a", "deck_b")).write.mode(mode).csv(path)


def read_deck_file(spark: SparkSession, path: str) -> DataFrame:
    """The pair table from its CSV: the decks' cards in columns, wins and losses."""
    cards = [f"{side}{i} int" for side in ("a", "b") for i in range(1, DECK_SIZE + 1)]
    return spark.read.schema(", ".join([*cards, "wins bigint", "losses bigint"])).csv(path)


def resolve_keys(cards: DataFrame, keys: list[str]) -> list[int]:
    """Card ids of the given keys, the first in the dimension's order where a key repeats."""
    if not keys:
        return []
    rows = (
        cards.where(F.col("key").isin(keys)).groupBy("key")
        .agg(F.min_by("id", "card_index").alias("id")).collect()
    )
    ids = {row["key"]: row["id"] for row in rows}
    unknown = sorted(set(keys) - set(ids))
    if unknown:
        raise KeyError(f"unknown card keys: {unknown}")
    return [ids[key] for key in keys]


def all_decks(flat: DataFrame, *kept: str) -> DataFrame:
    """Both decks of every battle, one row each."""
    return flat.select(
        *kept,
        F.inline(F.array(
            F.struct(F.lit(1).alias("side"), F.col("p1_deck").alias("deck")),
            F.struct(F.lit(2).alias("side"), F.col("p2_deck").alias("deck")),
        )),
    )


def decks_with(decks: DataFrame, include: list[int], exclude: list[int]) -> DataFrame:
    """Decks that hold every card of ``include`` and none of ``exclude``."""
    deck = F.col("deck")
    return decks.where(contains_all(deck, include) & contains_none(deck, exclude))


def card_index_map(cards: DataFrame) -> Column:
    """Card id to place in the dimension."""
    return map_of(cards, "id", "card_index")


def indexed(deck: Column, index_map: Column, keep_unknown: bool = False) -> Column:
    """Card places; unknown cards become null, or keep their ids with ``keep_unknown``."""
    if keep_unknown:
        return F.transform(deck, lambda card: F.coalesce(F.try_element_at(index_map, card), card))
    return F.transform(deck, lambda card: F.try_element_at(index_map, card))


def multi_hot_battles(
    flat: DataFrame, index_map: Column, team_width: int, opponent_width: int,
    legacy: bool = False, as_text: bool = False,
) -> DataFrame:
    """Battles with each deck as booleans by card place (or as text of 0 and 1), and the unknown cards' number.

    Unknown cards set no flag; with ``legacy`` they count as the card at place 0.
    """
    encode = bit_text if as_text else multi_hot
    widths = {"p1": team_width, "p2": opponent_width}
    encoded = flat.withColumns({f"{s}_places": indexed(F.col(f"{s}_deck"), index_map) for s in widths})

    def places(side: str) -> Column:
        found = F.col(f"{side}_places")
        return F.transform(found, lambda i: F.coalesce(i, F.lit(0))) if legacy else found

    unknown = F.size(F.filter(F.concat("p1_places", "p2_places"), lambda i: i.isNull()))
    kept = [c for c in flat.columns if c not in ("p1_deck", "p2_deck")]
    return encoded.select(
        *kept,
        *[encode(places(side), width).alias(f"{side}_cards") for side, width in widths.items()],
        unknown.alias("unknown_cards"),
    )
