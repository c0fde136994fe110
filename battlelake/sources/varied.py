"""Battles whose variety grows with the events: nearly every deck is new, while one card and one opponent are hot.

The same formulas are written in SQL in ``plans/varied_oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from battlelake.schemas import DECK_SIZE
from battlelake.sources.fixtures import FIRST_CARD

#: Cards that may stand at one place of a deck; place i has the cards that leave i when divided by the deck's size.
CARDS_PER_PLACE = 15
HOT_OPPONENT = "P99999"


def _deck(x: str) -> str:
    n = CARDS_PER_PLACE
    places = ", ".join(str(i) for i in range(DECK_SIZE))
    digit = lambda at: f"{x} div element_at(array(1, {n}, {n**2}, {n**3}), {at} % 4 + 1)"
    # Four places have one digit of the number to base 15 each, the other four the sum of two and of what is above.
    digits = f"({digit('i')} + IF(i < 4, 0, {digit('(i + 1)')} + {x} div {n**4})) % {n}"
    return f"transform(array({places}), i -> int({FIRST_CARD} + i + {DECK_SIZE} * IF(i = 0 AND battle_id % 3 = 0, 0, {digits})))"


def varied(flat: DataFrame) -> DataFrame:
    """Flat battles with decks of their own.

    A third of the first decks begin with one card, a third of the opponents are one player, some opponents have so few
    trophies that ranked play leaves them out, and some battles lie outside all seasons.
    """
    return flat.selectExpr(
        "battle_id",
        "IF(battle_id % 29 = 0, concat('2025', substr(battle_time, 5)), battle_time) AS battle_time",
        "game_mode", "p1_tag", "p1_trophies", "p1_crowns", f"{_deck('battle_id')} AS p1_deck",
        f"IF(battle_id % 3 = 1, '{HOT_OPPONENT}', p2_tag) AS p2_tag",
        "IF(battle_id % 13 = 0, int(battle_id % 60), p2_trophies) AS p2_trophies",
        "p2_crowns", f"{_deck('(battle_id * 3 + 1)')} AS p2_deck",
    )
