"""Names for ids: game modes and decks, and the flat search document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from battlelake.operators.performance import flatten
from battlelake.sources.dims import distinct_keys, literal_lookup

UNKNOWN = "Unknown"


def unknown_card(card: Column) -> Column:
    return F.concat(F.lit(f"{UNKNOWN}("), card.cast("string"), F.lit(")"))


def with_mode_names(df: DataFrame, modes: DataFrame) -> DataFrame:
    dim = modes.select(F.col("id").alias("game_mode"), F.col("name_en").alias("game_mode_name"))
    return df.join(dim, "game_mode", "left").withColumn(
        "game_mode_name", F.coalesce("game_mode_name", F.lit(UNKNOWN))
    )


def with_card_names(df: DataFrame, decks: dict[str, str], cards: DataFrame) -> DataFrame:
    """Add a name list per deck column (``{deck column: new column}``), in deck order.

    A dimension of card-game size becomes a literal; a larger one is joined card by card.
    """
    name_of = literal_lookup(cards, "id", "name")
    if name_of is not None:
        return df.withColumns({
            new: F.transform(deck, lambda c: F.coalesce(name_of(c), unknown_card(c)))
            for deck, new in decks.items()
        })
    dim = distinct_keys(cards, "id", "name").select(F.col("id").alias("card"), "name")
    named = df
    for deck, new in decks.items():
        # Names are looked up once per distinct deck, and a deck's few cards are put together again.
        lists = (
            df.select(deck).distinct()
            .select(deck, F.posexplode(deck).alias("place", "card"))
            .join(dim, "card", "left")
            .groupBy(deck)
            .agg(F.sort_array(F.collect_list(F.struct(
                "place", F.coalesce("name", unknown_card(F.col("card"))).alias("name")
            ))).alias("names"))
            .select(deck, F.col("names.name").alias(new))
        )
        # A deck without cards has no row there and an empty list of names.
        none = F.when(F.col(deck).isNotNull(), F.array().cast("array<string>"))
        named = named.join(lists, deck, "left").withColumn(new, F.coalesce(new, none))
    return named


def search_documents(battles: DataFrame, cards: DataFrame, modes: DataFrame, legacy: bool = False) -> DataFrame:
    """Flat document with names; ``legacy`` gives the deck lists as one text ``[a, b]``."""
    named = with_card_names(
        with_mode_names(flatten(battles), modes),
        {"p1_deck": "player1_deck_names", "p2_deck": "player2_deck_names"},
        cards,
    )

    def names(column: str) -> Column:
        if not legacy:
            return F.col(column)
        return F.concat(F.lit("["), F.array_join(column, ", "), F.lit("]")).alias(column)

    kept = [c for c in ("battle_id",) if c in battles.columns]
    return named.select(
        *kept,
        "battle_time",
        "game_mode_name",
        F.col("p1_tag").alias("player1_tag"),
        F.col("p1_trophies").alias("player1_trophies"),
        F.col("p1_crowns").alias("player1_crowns"),
        names("player1_deck_names"),
        F.col("p2_tag").alias("player2_tag"),
        F.col("p2_trophies").alias("player2_trophies"),
        F.col("p2_crowns").alias("player2_crowns"),
        names("player2_deck_names"),
    )
