"""The SQL of the queries over varied battles: that of their counterparts, with the battles changed."""

from __future__ import annotations

from battlelake.plans import oracle


def _deck(x: str) -> str:
    power = "[1, 15, 225, 3375]"
    digits = f"({x} // {power}[i % 4 + 1] + CASE WHEN i < 4 THEN 0 ELSE {x} // {power}[(i + 1) % 4 + 1] + {x} // 50625 END) % 15"
    return (
        f"[CAST(26000000 + i + 8 * CASE WHEN i = 0 AND battle_id % 3 = 0 THEN 0 ELSE {digits} END AS INTEGER)"
        " FOR i IN [0,1,2,3,4,5,6,7]]"
    )


_VARIED = f"""
  SELECT * REPLACE (
    CASE WHEN battle_id % 29 = 0 THEN '2025' || substr(battle_time, 5) ELSE battle_time END AS battle_time,
    {_deck('battle_id')} AS p1_deck, {_deck('(battle_id * 3 + 1)')} AS p2_deck,
    CASE WHEN battle_id % 3 = 1 THEN 'P99999' ELSE p2_tag END AS p2_tag,
    CAST(CASE WHEN battle_id % 13 = 0 THEN battle_id % 60 ELSE p2_trophies END AS INTEGER) AS p2_trophies)
  FROM plain_battles"""

#: Query over varied battles: the one that it repeats.
COUNTERPARTS = {
    "varied_pattern_mapping": "pattern_mapping",
    "varied_matrix": "effectiveness_matrix",
    "varied_accumulated_matrix": "accumulated_matrix",
    "varied_one_on_one": "one_on_one_modes",
    "varied_frontier": "player_frontier",
    "varied_season_summary": "season_summary",
    "varied_pair_stats": "deck_pair_stats",
    "varied_folded_in": None,
}

_FOLDED_IN = oracle._sql(
    "SELECT deck_pattern_id, count(*) AS ratings, true AS solved FROM mapping JOIN matrix USING (deck_pattern)"
    " WHERE deck_pattern_id % 5 = 0 AND next_card IN"
    " (SELECT next_card FROM mapping JOIN matrix USING (deck_pattern) WHERE deck_pattern_id % 5 <> 0) GROUP BY deck_pattern_id",
    "mapping", "matrix")


def statements() -> dict[str, str]:
    known = oracle.statements()

    def over_varied(sql: str) -> str:
        renamed = sql.replace("\nbattles AS (", "\nplain_battles AS (", 1)
        return renamed.replace("FROM types)", f"FROM types),\nbattles AS ({_VARIED})", 1)

    return {name: over_varied(known[own] if own else _FOLDED_IN) for name, own in COUNTERPARTS.items()}
