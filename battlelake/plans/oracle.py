"""The registered queries in SQL, over the given tables, written without regard to scale.

Each statement is a chain of common table expressions; ``_sql`` puts together the ones it needs.
"""

from __future__ import annotations

from battlelake.sources.dims import GAME_MODES

_MODES = ", ".join(f"({i}, '{name}', '{kind}')" for i, name, kind in GAME_MODES)

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, body: str, *needs: str) -> None:
    _CTES[name] = (body, needs)


def _sql(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for parent in _CTES[name][1]:
            visit(parent)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name][0]})" for name in order) + "\n" + body


def _deck(archetype: str, reverse: str) -> str:
    card = f"CAST(26000000 + ({archetype}*5 + i*(1 + {archetype}%4)) % 121 AS INTEGER)"
    return (
        f"CASE WHEN {reverse} THEN [{card} FOR i IN [7,6,5,4,3,2,1,0]]"
        f" ELSE [{card} FOR i IN [0,1,2,3,4,5,6,7]] END"
    )


_cte("users", """
  SELECT event_id AS e, user_id AS u, (user_id + 1 + (event_id*7) % 149) % 150 AS u2, ts, event_type FROM events""")
_cte("types", "SELECT *, (u + e%3) % 40 AS a1, (u2 + e%5) % 40 AS a2 FROM users", "users")
_cte("battles", f"""
  SELECT e AS battle_id, concat(strftime(ts, '%Y%m%dT%H%M%S.%g'), 'Z') AS battle_time,
    CAST(CASE event_type WHEN 'click' THEN 72000006 WHEN 'view' THEN 72000323 WHEN 'purchase' THEN 72000010
         WHEN 'signup' THEN 72000201 ELSE 72999999 END AS INTEGER) AS game_mode,
    'P' || lpad(CAST(u AS VARCHAR), 5, '0') AS p1_tag,
    CAST(5000 + (u*37)%3000 + e%60 AS INTEGER) AS p1_trophies,
    CAST((e*7 + u) % 4 AS INTEGER) AS p1_crowns,
    {_deck('a1', 'e%7 = 0')} AS p1_deck,
    'P' || lpad(CAST(u2 AS VARCHAR), 5, '0') AS p2_tag,
    CAST(5000 + (u2*37)%3000 + (e*3)%60 AS INTEGER) AS p2_trophies,
    CAST((e*5 + u2*3) % 4 AS INTEGER) AS p2_crowns,
    {_deck('a2', 'e%7 = 3')} AS p2_deck
  FROM types""", "types")
_cte("dated", "SELECT *, CAST(strptime(substr(battle_time, 1, 8), '%Y%m%d') AS DATE) AS battle_date FROM battles",
     "battles")
_INFO = ("tag", "trophies", "crowns", "deck")
_SWAPPED = ", ".join(
    [f"p2_{c} AS p1_{c}" for c in _INFO] + [f"p1_{c} AS p2_{c}" for c in _INFO]
)
_STRAIGHT = ", ".join([f"p1_{c}" for c in _INFO] + [f"p2_{c}" for c in _INFO])
_cte("battle_log", f"""
  SELECT battle_id, battle_time, game_mode, {_STRAIGHT} FROM battles
  UNION ALL SELECT battle_id, battle_time, game_mode, {_SWAPPED} FROM battles WHERE battle_id % 10 = 0
  UNION ALL SELECT battle_id, battle_time, game_mode, {_STRAIGHT} FROM battles WHERE battle_id % 25 = 0""", "battles")
_cte("card_dim", """
  SELECT CAST(26000000 + k AS INTEGER) AS id, CAST(k AS INTEGER) AS card_index, 'card-' || k AS key,
    'Card ' || k AS name FROM range(118) t(k)""")
_cte("mode_dim", f"SELECT * FROM (VALUES {_MODES}) m(id, name_en, class)")
_cte("season_dim", """
  SELECT * FROM (VALUES (1, DATE '2024-01-01', DATE '2024-01-08'), (2, DATE '2024-01-08', DATE '2024-01-22'),
    (3, DATE '2024-01-22', DATE '2024-02-05')) s(season, start_date, end_date)""")


# --- scoring ---------------------------------------------------------------------------------------

def _outcome(own: str, opponent: str) -> str:
    return f"CASE WHEN {own} > {opponent} THEN 'win' WHEN {own} < {opponent} THEN 'loss' ELSE 'draw' END"


def _score(scored_on: str) -> str:
    gap = "(opponent_trophies - trophies) / CAST(greatest(trophies, 100) AS DOUBLE)"
    return (
        f"CASE {scored_on} WHEN 'win' THEN 1.0 + greatest(0.0, {gap} * 0.3::DOUBLE)"
        f" WHEN 'draw' THEN 0.5 + greatest(0.0, {gap} * 0.2::DOUBLE)"
        f" ELSE greatest(0.1::DOUBLE, 1.0 - abs(least(0.0, {gap} * 0.2::DOUBLE))) END"
    )


_cte("sides", f"""
  SELECT battle_id, battle_time, CAST(1 AS INTEGER) AS side, p1_tag AS tag, p1_deck AS deck, p1_trophies AS trophies,
    p2_trophies AS opponent_trophies, {_outcome('p1_crowns', 'p2_crowns')} AS outcome,
    {_outcome('p1_crowns', 'p2_crowns')} AS legacy_outcome FROM battles
  UNION ALL
  SELECT battle_id, battle_time, CAST(2 AS INTEGER), p2_tag, p2_deck, p2_trophies, p1_trophies,
    {_outcome('p2_crowns', 'p1_crowns')}, {_outcome('p1_crowns', 'p2_crowns')} FROM battles""", "battles")
_cte("results", f"SELECT *, {_score('outcome')} AS performance_score FROM sides", "sides")
_cte("results_legacy", f"SELECT *, {_score('legacy_outcome')} AS performance_score FROM sides", "sides")

_SEQUENCES = """
  SELECT battle_id, battle_time, side, performance_score, array_to_string(deck[1:k], ',') AS deck_pattern,
    deck[k+1] AS next_card, CAST(k AS INTEGER) AS sequence_length
  FROM {source}, range(1, 8) t(k)"""
_cte("sequences", _SEQUENCES.format(source="results"), "results")
_cte("sequences_legacy", _SEQUENCES.format(source="results_legacy"), "results_legacy")


def _base(source: str, where: str = "true") -> str:
    return f"""
  SELECT deck_pattern, next_card, count(*) AS total_appearances, avg(performance_score) AS weighted_performance,
    stddev_samp(performance_score) AS performance_consistency, avg(sequence_length) AS avg_sequence_length
  FROM {source} WHERE {where} GROUP BY ALL"""


def _with_scores(source: str, key: str = "deck_pattern") -> str:
    return f"""
  SELECT *, 0.20::DOUBLE*frequency_score + 0.45::DOUBLE*weighted_performance
    + 0.35::DOUBLE*consistency_factor AS effectiveness_score
  FROM (SELECT *, total_appearances / CAST(sum(total_appearances) OVER (PARTITION BY {key}) AS DOUBLE) AS frequency_score,
          1.0::DOUBLE / (1.0::DOUBLE + coalesce(performance_consistency, 1.0::DOUBLE)) AS consistency_factor
        FROM {source})"""


_cte("base", _base("sequences"), "sequences")
_cte("matrix", _with_scores("base"), "base")
_cte("base_legacy", _base("sequences_legacy"), "sequences_legacy")
_cte("matrix_legacy", _with_scores("base_legacy"), "base_legacy")
_BATCH_OF = "CASE WHEN battle_time < '20240108' THEN 1 WHEN battle_time < '20240122' THEN 2 ELSE 3 END"
for _number in (1, 2, 3):
    _cte(f"batch{_number}", _base("sequences", f"{_BATCH_OF} = {_number}"), "sequences")


def _fold(old: str, new: str) -> str:
    return f"""
  SELECT deck_pattern, next_card, CAST(sum(total_appearances) AS BIGINT) AS total_appearances,
    avg(weighted_performance) AS weighted_performance, avg(performance_consistency) AS performance_consistency,
    avg(avg_sequence_length) AS avg_sequence_length
  FROM (SELECT * FROM {old} UNION ALL SELECT * FROM {new}) GROUP BY ALL"""


_cte("folded2", _fold("batch1", "batch2"), "batch1", "batch2")
_cte("folded3", _fold("folded2", "batch3"), "folded2", "batch3")
_cte("folded", _with_scores("folded3"), "folded3")
_cte("last_matrix", _with_scores("batch3"), "batch3")

_SCORES = ", ".join(
    f"round({c}, 6) AS {c}" for c in (
        "weighted_performance", "performance_consistency", "avg_sequence_length", "frequency_score",
        "consistency_factor", "effectiveness_score")
)

_cte("mapping", """
  SELECT deck_pattern, CAST(row_number() OVER (ORDER BY deck_pattern) AS INTEGER) AS deck_pattern_id
  FROM (SELECT DISTINCT deck_pattern FROM sequences)""", "sequences")
_cte("mapping_by_batch", f"""
  SELECT deck_pattern, CAST(row_number() OVER (ORDER BY first_batch, deck_pattern) AS INTEGER) AS deck_pattern_id
  FROM (SELECT deck_pattern, min({_BATCH_OF}) AS first_batch FROM sequences GROUP BY deck_pattern)""", "sequences")


# --- requests and recommendations ------------------------------------------------------------------

_cte("requests", """
  SELECT battle_id AS request_id,
    CASE WHEN battle_id % 17 = 0 THEN [CAST(29000000 + battle_id % 3 AS INTEGER)]
         WHEN battle_id % 19 = 0
           THEN list_concat(p1_deck[1:least(battle_id % 10, 6)], [CAST(29000000 + battle_id % 3 AS INTEGER)])
         ELSE p1_deck[1:battle_id % 10] END AS partial_deck,
    CASE WHEN battle_id % 13 <> 12 THEN CAST(battle_id % 12 AS INTEGER) END AS asked
  FROM battles""", "battles")
_cte("checked", """
  SELECT request_id, partial_deck, coalesce(asked, 3) AS num_recommendations,
    CASE WHEN len(partial_deck) NOT BETWEEN 1 AND 7 THEN 'deck size'
         WHEN asked NOT BETWEEN 1 AND 10 THEN 'number of cards' END AS rejected
  FROM requests""", "requests")
_cte("valid", """
  SELECT request_id, list_sort(list_distinct(partial_deck)) AS cards, num_recommendations AS wanted
  FROM checked WHERE rejected IS NULL""", "checked")
_cte("request_sets", "SELECT DISTINCT cards FROM valid", "valid")


def _overlaps(mapping: str) -> str:
    return f"""
  SELECT cards, deck_pattern_id, len(list_intersect(cards, known)) AS overlap, len(cards) AS a, len(known) AS b
  FROM request_sets, (SELECT deck_pattern_id,
    [CAST(c AS INTEGER) FOR c IN string_split(deck_pattern, ',')] AS known FROM {mapping})"""


_TOP5 = """
  SELECT cards, deck_pattern_id, score, place FROM (
    SELECT cards, deck_pattern_id, overlap / CAST(a + b - overlap AS DOUBLE) AS score,
      CAST(row_number() OVER (PARTITION BY cards ORDER BY overlap / CAST(a + b - overlap AS DOUBLE) DESC, deck_pattern_id)
        AS INTEGER) AS place
    FROM {source}) WHERE place <= 5"""
_cte("shared_cards", _overlaps("mapping"), "request_sets", "mapping")
_cte("top5", _TOP5.format(source="shared_cards"), "shared_cards")
_cte("shared_cards_by_batch", _overlaps("mapping_by_batch"), "request_sets", "mapping_by_batch")
_cte("top5_by_batch", _TOP5.format(source="shared_cards_by_batch"), "shared_cards_by_batch")
_cte("best", """
  SELECT cards, deck_pattern_id, CAST(overlap AS INTEGER) AS overlap FROM (
    SELECT *, row_number() OVER (PARTITION BY cards ORDER BY overlap DESC, deck_pattern_id) AS place
    FROM shared_cards WHERE overlap > 0) WHERE place = 1""", "shared_cards")


def _popular(matrix: str) -> str:
    return f"""
  SELECT next_card, avg(effectiveness_score) AS effectiveness_score,
    CAST(sum(total_appearances) AS BIGINT) AS total_appearances FROM {matrix} GROUP BY next_card"""


_cte("popular", _popular("matrix"), "matrix")
_cte("popular_last", _popular("last_matrix"), "last_matrix")


def _pooled(matches: str, mapping: str, matrix: str, popular: str) -> str:
    return f"""
  SELECT request_id, CAST(place AS INTEGER) AS place, card_id, round(score, 6) AS score, appearances
  FROM valid JOIN (
    SELECT *, row_number() OVER (PARTITION BY cards, wanted ORDER BY score DESC, card_id) AS place FROM (
      SELECT cards, wanted, card_id, avg(s) AS score, CAST(sum(n) AS BIGINT) AS appearances FROM (
        SELECT cards, wanted, next_card AS card_id, effectiveness_score AS s, total_appearances AS n
        FROM (SELECT DISTINCT cards, wanted FROM valid) JOIN pool USING (cards)
        UNION ALL
        SELECT cards, wanted, next_card, effectiveness_score, total_appearances FROM (
          SELECT f.cards, f.wanted, f.found, p.*,
            row_number() OVER (PARTITION BY f.cards, f.wanted ORDER BY p.total_appearances DESC, p.next_card) AS k
          FROM (SELECT v.cards, v.wanted, count(pool.next_card) AS found
                FROM (SELECT DISTINCT cards, wanted FROM valid) v LEFT JOIN pool USING (cards) GROUP BY ALL) f,
            {popular} p WHERE NOT list_contains(f.cards, p.next_card))
        WHERE k <= wanted - found)
      GROUP BY ALL)) USING (cards, wanted)
  WHERE place <= wanted"""


_POOL = """
  SELECT t.cards, m.next_card, m.effectiveness_score, m.total_appearances
  FROM {matches} t JOIN {mapping} USING (deck_pattern_id) JOIN {matrix} m USING (deck_pattern)
  WHERE NOT list_contains(t.cards, m.next_card)"""
_cte("pool", _POOL.format(matches="top5", mapping="mapping", matrix="matrix"), "top5", "mapping", "matrix")
_cte("single", """
  SELECT request_id, CAST(place AS INTEGER) AS place, card_id, round(score, 6) AS score, appearances
  FROM valid JOIN (
    SELECT v.cards, v.wanted, m.next_card AS card_id, m.effectiveness_score AS score, m.total_appearances AS appearances,
      row_number() OVER (PARTITION BY v.cards, v.wanted ORDER BY m.effectiveness_score DESC, m.next_card) AS place
    FROM (SELECT DISTINCT cards, wanted FROM valid) v JOIN best USING (cards)
      JOIN mapping USING (deck_pattern_id) JOIN matrix m USING (deck_pattern)
    WHERE NOT list_contains(v.cards, m.next_card)) USING (cards, wanted)
  WHERE place <= wanted""", "valid", "best", "mapping", "matrix")


def _text(*columns: str) -> str:
    return ", ".join(f"array_to_string({c}, ',') AS {c}" for c in columns)


_DECKS = _text("p1_deck", "p2_deck")

# --- batch analytics -------------------------------------------------------------------------------

_KEEP_BY_TAG = "p1_tag > p2_tag"
_KEEP_WINNER = "p1_crowns > p2_crowns"


def _oriented(keep: str) -> str:
    return f"""
  SELECT DISTINCT battle_time, game_mode, {_STRAIGHT} FROM (
    SELECT battle_time, game_mode, {_STRAIGHT} FROM battle_log WHERE {keep}
    UNION ALL SELECT battle_time, game_mode, {_SWAPPED} FROM battle_log WHERE NOT ({keep}))"""


_cte("canonical", _oriented(_KEEP_BY_TAG), "battle_log")
_cte("winner_first", _oriented(_KEEP_WINNER), "battle_log")
_cte("season_rows", """
  SELECT c.*, CAST(try_strptime(substr(battle_time, 1, 8), '%Y%m%d') AS DATE) AS battle_date, coalesce(season, 0) AS season
  FROM canonical c LEFT JOIN season_dim ON CAST(try_strptime(substr(battle_time, 1, 8), '%Y%m%d') AS DATE) >= start_date
    AND CAST(try_strptime(substr(battle_time, 1, 8), '%Y%m%d') AS DATE) < end_date""", "canonical", "season_dim")


def _pairs(differ: str, source: str = "battles") -> str:
    return f"""
  SELECT deck_a, deck_b, CAST(sum(wins) AS BIGINT) AS wins, CAST(sum(losses) AS BIGINT) AS losses FROM (
    SELECT least(x, y) AS deck_a, greatest(x, y) AS deck_b, CASE WHEN (x <= y) = won THEN 1 ELSE 0 END AS wins,
      CASE WHEN (x <= y) = won THEN 0 ELSE 1 END AS losses
    FROM (SELECT list_sort(p1_deck) AS x, list_sort(p2_deck) AS y, p1_crowns > p2_crowns AS won
          FROM {source} WHERE {differ} AND p1_crowns <> p2_crowns))
  GROUP BY ALL"""


_cte("pairs", _pairs("p1_deck <> p2_deck"), "battles")
_cte("pairs_sets", _pairs("list_sort(p1_deck) <> list_sort(p2_deck)"), "battles")
_cte("encoded", """
  SELECT p1_crowns, p2_crowns, [CASE WHEN c < 26000118 THEN c - 26000000 ELSE c END FOR c IN p1_deck] AS p1_deck,
    [CASE WHEN c < 26000118 THEN c - 26000000 ELSE c END FOR c IN p2_deck] AS p2_deck
  FROM battles""", "battles")
_cte("encoded_pairs", _pairs("p1_deck <> p2_deck", "encoded"), "encoded")
_cte("all_decks", """
  SELECT battle_id, battle_date, CAST(1 AS INTEGER) AS side, p1_deck AS deck FROM dated
  UNION ALL SELECT battle_id, battle_date, CAST(2 AS INTEGER), p2_deck FROM dated""", "dated")
_cte("daily_cards", """
  SELECT battle_date, card, count(*) AS usage
  FROM (SELECT battle_date, unnest(list_distinct(deck)) AS card FROM all_decks) GROUP BY ALL""", "all_decks")
_SHARE = "round(usage / CAST(sum(usage) OVER (PARTITION BY battle_date) AS DOUBLE), 6) AS share"
_cte("card_total", """
  SELECT coalesce(u.card, d.id) AS card, d.name AS card_name, coalesce(u.usage, 0) AS usage
  FROM (SELECT card, CAST(sum(usage) AS BIGINT) AS usage FROM daily_cards GROUP BY card) u
    FULL JOIN card_dim d ON u.card = d.id""", "daily_cards", "card_dim")
_cte("daily_decks", """
  SELECT battle_date, list_sort(deck) AS deck, count(*) AS usage FROM all_decks GROUP BY ALL""", "all_decks")


def _hot(deck: str, width: int, legacy: bool) -> str:
    place = "CASE WHEN c - 26000000 < 118 THEN c - 26000000 ELSE %s END" % ("0" if legacy else "-1")
    return (
        f"array_to_string([CASE WHEN list_contains([{place} FOR c IN {deck}], i) THEN '1' ELSE '0' END"
        f" FOR i IN range({width})], '') AS {deck.replace('deck', 'cards')}"
    )


def _multi_hot(legacy: bool) -> str:
    return f"""
  SELECT battle_id, {_hot('p1_deck', 256, legacy)}, {_hot('p2_deck', 128, legacy)},
    CAST(len([c FOR c IN list_concat(p1_deck, p2_deck) IF c >= 26000118]) AS INTEGER) AS unknown_cards FROM battles"""


# --- enrichment, series, frontier ------------------------------------------------------------------

def _names(deck: str) -> str:
    return (
        f"[CASE WHEN c < 26000118 THEN 'Card ' || (c - 26000000) ELSE 'Unknown(' || c || ')' END FOR c IN {deck}]"
    )


def _documents(first: str, second: str) -> str:
    return f"""
  SELECT battle_id, battle_time, coalesce(name_en, 'Unknown') AS game_mode_name,
    p1_tag AS player1_tag, p1_trophies AS player1_trophies, p1_crowns AS player1_crowns,
    {first} AS player1_deck_names,
    p2_tag AS player2_tag, p2_trophies AS player2_trophies, p2_crowns AS player2_crowns,
    {second} AS player2_deck_names
  FROM battles LEFT JOIN mode_dim ON game_mode = id"""


_cte("game_points", """
  SELECT DISTINCT battle_time, p1_tag AS player1_tag, p2_tag AS player2_tag, game_mode,
    p1_trophies AS player1_trophies, p1_crowns AS player1_crowns, p2_trophies AS player2_trophies,
    p2_crowns AS player2_crowns FROM battle_log""", "battle_log")
_LADDER = ", ".join(str(i) for i, _, kind in GAME_MODES if kind == "ladder")
_RANKED = ", ".join(str(i) for i, _, kind in GAME_MODES if kind == "ranked")
_ALL_MODES = ", ".join(str(i) for i, _, _ in GAME_MODES)
_CLASS = f"CASE WHEN game_mode IN ({_LADDER}) THEN 'ladder' WHEN game_mode IN ({_RANKED}) THEN 'ranked' ELSE 'other' END"
_cte("one_on_one", f"""
  SELECT *, {_CLASS} AS mode_class FROM battles
  WHERE game_mode IN ({_ALL_MODES}) AND NOT (game_mode IN ({_RANKED}) AND p2_trophies < 31)""", "battles")
_cte("latest", """
  SELECT tag, mode_class, distance, battle_time FROM (
    SELECT p2_tag AS tag, mode_class, abs(p2_trophies - 10000) AS distance, battle_time,
      row_number() OVER (PARTITION BY p2_tag, mode_class ORDER BY battle_time DESC, battle_id) AS k
    FROM one_on_one WHERE mode_class <> 'other'
      AND p2_tag NOT IN (SELECT p1_tag FROM battles WHERE p1_trophies >= 6500)) WHERE k = 1""", "one_on_one")
_cte("frontier", """
  SELECT tag, coalesce(max(distance) FILTER (mode_class = 'ranked'), 0) AS ranked_trophies,
    coalesce(max(distance) FILTER (mode_class = 'ladder'), 0) AS ladder_trophies,
    coalesce(max(battle_time) FILTER (mode_class = 'ranked'), '') AS last_ranked_battle,
    coalesce(max(battle_time) FILTER (mode_class = 'ladder'), '') AS last_ladder_battle
  FROM latest GROUP BY tag""", "latest")

_CARD_POINTS = """
  SELECT battle_id, battle_time, game_mode, card,
    CASE WHEN mine THEN p1_crowns ELSE 0 END - CASE WHEN theirs THEN p2_crowns ELSE 0 END AS crowns,
    CAST(CASE WHEN mine AND theirs THEN (p1_trophies + p2_trophies) // 2 WHEN mine THEN p1_trophies
         ELSE p2_trophies END AS INTEGER) AS trophies
  FROM (SELECT *, list_contains(p1_deck, card) AS mine, list_contains(p2_deck, card) AS theirs
        FROM (SELECT *, unnest(list_distinct(list_concat(p1_deck, p2_deck))) AS card FROM battles))"""
_cte("card_points", _CARD_POINTS, "battles")

_CHOSEN_EVENTS = "SELECT CAST(event_id AS VARCHAR) AS key"
_K = "CAST(json_extract_string({0}, '$.k') AS INTEGER)"


_cte("by_tag", f"""
  SELECT battle_id, battle_time, game_mode, {_STRAIGHT} FROM battles WHERE p1_tag > p2_tag
  UNION ALL SELECT battle_id, battle_time, game_mode, {_SWAPPED} FROM battles WHERE p1_tag <= p2_tag""", "battles")
_SIDES_TEXT = "p1_tag, p1_trophies, p1_crowns, p2_tag, p2_trophies, p2_crowns"
# The broken records of the streams, and why each cannot be used.
_BROKEN = (
    ('{"battle_time": ', "no battle in JSON"), ('{"battle_time":"20240131T000000.000Z","game_mode":72000006}', "no deck"))


def statements() -> dict[str, str]:
    matrix_columns = f"deck_pattern, next_card, total_appearances, {_SCORES}"
    id_matrix = f"deck_pattern_id, next_card, total_appearances, {_SCORES}"
    outcome1 = _outcome("p1_crowns", "p2_crowns")
    outcome2 = _outcome("p2_crowns", "p1_crowns")
    performance = (
        "SELECT battle_id, side, tag, trophies, opponent_trophies, outcome,"
        " round(performance_score, 6) AS performance_score FROM "
    )
    registry = f"""
      SELECT max(battle_time) AS t, (SELECT count(DISTINCT deck_pattern) FROM sequences s WHERE {{until}}) AS total_patterns,
        (SELECT count(*) FROM (SELECT DISTINCT deck_pattern, next_card FROM sequences s WHERE {{until}}))
          AS total_training_samples
      FROM battles WHERE {{until}}"""
    until = ["battle_time < '20240108'", "battle_time < '20240122'", "true"]
    stamp = "strptime(t, '%Y%m%dT%H%M%S.%gZ')"
    saves = " UNION ALL ".join(
        f"SELECT 'als_model_' || strftime({stamp}, '%Y%m%d_%H%M%S') AS model_name, {stamp} AS timestamp,"
        f" total_patterns, total_training_samples FROM ({registry.format(until=u)})" for u in until
    )
    event_value = "CASE WHEN event_type = 'error' THEN '{' || props ELSE props END"
    return {
        "battles_flat": _sql(
            f"SELECT battle_id, battle_time, game_mode, p1_tag, p1_trophies, p1_crowns, p2_tag, p2_trophies,"
            f" p2_crowns, {_DECKS} FROM battles", "battles"),
        "battle_outcomes": _sql(
            f"SELECT battle_id, p1_crowns, p2_crowns, {outcome1} AS p1_outcome, {outcome2} AS p2_outcome FROM battles",
            "battles"),
        "player_performance": _sql(performance + "results", "results"),
        "player_performance_legacy": _sql(performance + "results_legacy", "results_legacy"),
        "deck_sequences": _sql(
            "SELECT battle_id, side, round(performance_score, 6) AS performance_score, deck_pattern, next_card,"
            " sequence_length FROM sequences", "sequences"),
        "effectiveness_matrix": _sql(f"SELECT {matrix_columns} FROM matrix", "matrix"),
        "effectiveness_matrix_legacy": _sql(f"SELECT {matrix_columns} FROM matrix_legacy", "matrix_legacy"),
        "pattern_mapping": _sql("SELECT deck_pattern, deck_pattern_id FROM mapping", "mapping"),
        "pattern_mapping_incremental": _sql(
            "SELECT deck_pattern, deck_pattern_id FROM mapping_by_batch", "mapping_by_batch"),
        "accumulated_matrix": _sql(
            f"SELECT {id_matrix} FROM matrix JOIN mapping_by_batch USING (deck_pattern)", "matrix", "mapping_by_batch"),
        "accumulated_matrix_legacy": _sql(f"SELECT {matrix_columns} FROM folded", "folded"),
        "jaccard_matches": _sql(
            f"SELECT {_text('cards')}, deck_pattern_id, round(score, 6) AS score, place FROM top5", "top5"),
        "best_overlap_match": _sql(
            f"SELECT {_text('cards')}, deck_pattern_id, overlap FROM best", "best"),
        "exact_pattern_lookup": _sql(
            "SELECT request_id, deck_pattern, deck_pattern_id FROM (SELECT request_id,"
            " coalesce(array_to_string(partial_deck, ','), '') AS deck_pattern FROM requests)"
            " LEFT JOIN mapping USING (deck_pattern)", "requests", "mapping"),
        "popular_cards": _sql(
            "SELECT next_card, round(effectiveness_score, 6) AS effectiveness_score, total_appearances FROM popular",
            "popular"),
        "recommend_pooled": _sql(
            _pooled("top5", "mapping", "matrix", "popular"), "valid", "pool", "popular"),
        "recommend_pooled_last_batch": _sql(
            _pooled("top5_by_batch", "mapping_by_batch", "last_matrix", "popular_last").replace("pool USING", "pool_last pool USING"),
            "valid", "pool_last", "popular_last"),
        "recommend_single": _sql("SELECT * FROM single", "single"),
        "recommend_named": _sql(
            "SELECT card_id, request_id, place, score, appearances, key AS card_key, name AS card_name,"
            " score BETWEEN 0 AND 1 AS in_unit_range FROM single LEFT JOIN card_dim ON card_id = id",
            "single", "card_dim"),
        "request_validation": _sql(
            "SELECT request_id, num_recommendations, rejected,"
            " coalesce(array_to_string(list_sort(partial_deck), ','), '') AS deck_pattern FROM checked", "checked"),
        "canonical_battles": _sql(
            f"SELECT * REPLACE ({_DECKS}) FROM canonical", "canonical"),
        "winner_first_battles": _sql(f"SELECT * REPLACE ({_DECKS}) FROM winner_first", "winner_first"),
        "season_dedup": _sql(f"SELECT * REPLACE ({_DECKS}) FROM season_rows", "season_rows"),
        "season_summary": _sql(
            "SELECT season, count(*) AS games, count(DISTINCT battle_date) AS days FROM season_rows GROUP BY ROLLUP (season)",
            "season_rows"),
        "deck_pair_stats": _sql(f"SELECT * REPLACE ({_text('deck_a', 'deck_b')}) FROM pairs", "pairs"),
        "deck_pair_stats_set_mirrors": _sql(
            f"SELECT * REPLACE ({_text('deck_a', 'deck_b')}) FROM pairs_sets", "pairs_sets"),
        "deck_pair_stats_merged": _sql(f"SELECT * REPLACE ({_text('deck_a', 'deck_b')}) FROM pairs", "pairs"),
        "deck_pair_file_rows": _sql(
            "SELECT " + ", ".join(
                f"deck_{d}[{i}] AS {d}{i}" for d in "ab" for i in range(1, 9))
            + ", wins, losses, CAST(len([c FOR c IN list_concat(deck_a, deck_b) IF c >= 118]) AS INTEGER) AS unknown_cards,"
            " array_to_string([lpad(CAST(c AS VARCHAR), greatest(3, len(CAST(c AS VARCHAR)))::INTEGER, '0')"
            " FOR c IN list_concat(deck_a, deck_b)], '')"
            " AS sort_key FROM encoded_pairs", "encoded_pairs"),
        "card_usage_daily": _sql(f"SELECT battle_date, card, usage, {_SHARE} FROM daily_cards", "daily_cards"),
        "recent_card_usage": _sql(
            f"SELECT battle_date, card, usage, {_SHARE} FROM daily_cards WHERE battle_date IN"
            " (SELECT DISTINCT battle_date FROM dated ORDER BY battle_date DESC LIMIT 7)", "daily_cards"),
        "card_usage_total": _sql("SELECT * FROM card_total ORDER BY usage, card", "card_total"),
        "deck_usage_top": _sql(
            "SELECT array_to_string(deck, ',') AS deck, CAST(sum(usage) AS BIGINT) AS usage FROM daily_decks"
            " GROUP BY ALL ORDER BY usage DESC, deck LIMIT 10", "daily_decks"),
        "deck_usage_daily_top10_sum": _sql(
            "SELECT array_to_string(deck, ',') AS deck, CAST(sum(usage) AS BIGINT) AS usage FROM (SELECT *,"
            " row_number() OVER (PARTITION BY battle_date ORDER BY usage DESC, deck) AS k FROM daily_decks)"
            " WHERE k <= 10 GROUP BY ALL", "daily_decks"),
        "deck_filter": _sql(
            "SELECT battle_id, side, array_to_string(deck, ',') AS deck FROM all_decks WHERE list_contains(deck, 26000005)"
            " AND NOT list_has_any(deck, [26000007, 26000011])", "all_decks"),
        "deck_multi_hot": _sql(_multi_hot(False), "battles"),
        "deck_multi_hot_legacy": _sql(_multi_hot(True), "battles"),
        "search_documents": _sql(
            _documents(f"array_to_string({_names('p1_deck')}, '|')", f"array_to_string({_names('p2_deck')}, '|')"),
            "battles", "mode_dim"),
        "search_documents_legacy": _sql(
            _documents(f"'[' || array_to_string({_names('p1_deck')}, ', ') || ']'",
                       f"'[' || array_to_string({_names('p2_deck')}, ', ') || ']'"), "battles", "mode_dim"),
        "game_points": _sql("SELECT * FROM game_points", "game_points"),
        "card_points": _sql("SELECT * FROM card_points", "card_points"),
        "player_trophy_series": _sql(
            "SELECT battle_time, player1_tag AS tag, 'player1' AS side, player1_trophies AS trophies FROM game_points"
            " UNION ALL SELECT battle_time, player2_tag, 'player2', player2_trophies FROM game_points", "game_points"),
        "player_series_ordered": _sql(
            "SELECT strptime(substr(battle_time, 1, 19), '%Y%m%dT%H%M%S.%g') AS ts, tag, side, trophies,"
            " row_number() OVER (PARTITION BY tag ORDER BY battle_time, side, trophies) AS place FROM ("
            "SELECT battle_time, player1_tag AS tag, 'player1' AS side, player1_trophies AS trophies FROM game_points"
            " UNION ALL SELECT battle_time, player2_tag, 'player2', player2_trophies FROM game_points)", "game_points"),
        "player_totals": _sql(
            "SELECT tag, count(*) AS battles, count(*) FILTER (WHERE outcome = 'win') AS wins, any_value(best_trophies) AS best_trophies"
            " FROM results JOIN (SELECT tag AS of_tag, max(trophies) AS best_trophies FROM results GROUP BY tag) ON tag = of_tag GROUP BY tag",
            "results"),
        "winner_first_canonical": _sql(f"""
            SELECT * REPLACE ({_DECKS}) FROM (
              SELECT battle_time, game_mode, {_STRAIGHT} FROM canonical WHERE p1_crowns >= p2_crowns
              UNION ALL SELECT battle_time, game_mode, {_SWAPPED} FROM canonical WHERE p1_crowns < p2_crowns)""", "canonical"),
        "als_residuals": _sql(
            "SELECT deck_pattern_id, count(*) AS ratings, true AS solved FROM mapping JOIN matrix USING (deck_pattern) GROUP BY deck_pattern_id",
            "mapping", "matrix"),
        "field_series_join": _sql(
            "SELECT battle_time, player1_tag, player2_tag, player2_trophies AS trophies, player2_crowns AS crowns"
            " FROM game_points WHERE battle_time >= '20240105' AND battle_time < '20240120'", "game_points"),
        "card_search": _sql(
            "SELECT *, 'assets/cards/' || replace(lower(card_name), ' ', '-') || '.png' AS picture FROM card_total"
            " WHERE contains(lower(card_name), 'card 1')", "card_total"),
        "deck_toggle": _sql(
            "SELECT battle_id, array_to_string(CASE WHEN list_contains(p1_deck, c) THEN [x FOR x IN p1_deck IF x <> c]"
            " ELSE list_append(p1_deck, c) END, ',') AS deck"
            " FROM (SELECT *, CAST(26000000 + battle_id % 121 AS INTEGER) AS c FROM battles)", "battles"),
        "player_frontier": _sql("SELECT * FROM frontier", "frontier"),
        "frontier_next": _sql(
            "SELECT * FROM frontier ORDER BY ranked_trophies, ladder_trophies, last_ranked_battle, last_ladder_battle, tag"
            " LIMIT 20", "frontier"),
        "crawl_counters": _sql(
            f"SELECT count(*) AS battles, count(DISTINCT p1_tag) AS players FROM battles WHERE game_mode IN ({_ALL_MODES})",
            "battles"),
        "one_on_one_modes": _sql("SELECT battle_id, game_mode, mode_class FROM one_on_one", "one_on_one"),
        "raw_log_normalise": _sql(
            f"SELECT battle_id, battle_time, game_mode, {_STRAIGHT.replace('p1_deck', _text('p1_deck')).replace('p2_deck', _text('p2_deck'))}"
            " FROM battle_log", "battle_log"),
        "topic_records": (
            f"SELECT CAST(event_id AS VARCHAR) AS key, {event_value} AS value,"
            f" CASE WHEN event_type <> 'error' THEN {_K.format('props')} END AS k FROM events WHERE event_type <> 'signup'"),
        "tolerant_decode": (
            "SELECT CAST(event_id AS VARCHAR) AS key, event_type = 'error' AS undecodable,"
            f" CASE WHEN event_type <> 'error' THEN {_K.format('props')} END AS k FROM events"),
        "publish_records": _sql(f"SELECT * REPLACE ({_DECKS}) FROM winner_first", "winner_first"),
        "csv_table": _sql(
            f"SELECT * REPLACE ({_DECKS}, CAST(p1_trophies AS SMALLINT) AS p1_trophies,"
            " CAST(p2_trophies AS SMALLINT) AS p2_trophies, CAST(p1_crowns AS TINYINT) AS p1_crowns,"
            " CAST(p2_crowns AS TINYINT) AS p2_crowns),"
            " CAST(strptime(substr(battle_time, 1, 8), '%Y%m%d') AS DATE) AS battle_date FROM canonical", "canonical"),
        "csv_table_appended": _sql(
            f"SELECT * REPLACE ({_DECKS}, CAST(p1_trophies AS SMALLINT) AS p1_trophies,"
            " CAST(p2_trophies AS SMALLINT) AS p2_trophies, CAST(p1_crowns AS TINYINT) AS p1_crowns,"
            " CAST(p2_crowns AS TINYINT) AS p2_crowns),"
            " CAST(strptime(substr(battle_time, 1, 8), '%Y%m%d') AS DATE) AS battle_date FROM canonical", "canonical"),
        "deck_pair_file": _sql(
            "SELECT " + ", ".join(f"deck_{d}[{i}] AS {d}{i}" for d in "ab" for i in range(1, 9)) + ", wins, losses FROM pairs", "pairs"),
        "search_documents_from_files": _sql(
            _documents(f"array_to_string({_names('p1_deck')}, '|')", f"array_to_string({_names('p2_deck')}, '|')"),
            "battles", "mode_dim"),
        "odd_numbers": "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'Infinity' END AS as_text FROM events",
        "model_registry_latest": _sql(
            f"SELECT 'continuous_als_model' AS model_name, {stamp} AS timestamp, total_patterns, total_training_samples"
            f" FROM ({registry.format(until='true')})", "sequences", "battles"),
        "model_registry_versions": _sql(saves, "sequences", "battles"),
        "state_profile": _sql(
            "SELECT (SELECT count(*) FROM mapping) AS patterns, count(*) AS matrix_rows, CAST(9 AS INTEGER) AS matrix_columns,"
            " count(DISTINCT next_card) AS cards, CAST(sum(total_appearances) AS BIGINT) AS samples FROM matrix",
            "mapping", "matrix"),
        "state_samples": _sql("SELECT deck_pattern, deck_pattern_id FROM mapping ORDER BY md5(deck_pattern), deck_pattern LIMIT 10", "mapping"),
        "recommendation_log": _sql(
            "SELECT request_id, array_to_string(partial_deck, ',') AS partial_deck,"
            " string_agg(CAST(card_id AS VARCHAR), ',' ORDER BY place) AS card_ids"
            " FROM single JOIN requests USING (request_id) GROUP BY ALL", "single", "requests"),
        "stream_documents": _sql(
            _documents(f"array_to_string({_names('p1_deck')}, '|')", f"array_to_string({_names('p2_deck')}, '|')")
            .replace("SELECT battle_id, ", "SELECT ", 1), "battles", "mode_dim"),
        "stream_fan_out": _sql(
            "SELECT 'battles' AS table_name, count(*) AS n FROM battle_log"
            " UNION ALL SELECT 'documents', count(*) FROM battle_log"
            " UNION ALL SELECT 'card_points', CAST(sum(len(list_distinct(list_concat(p1_deck, p2_deck)))) AS BIGINT)"
            " FROM battle_log UNION ALL SELECT 'quarantine', 2", "battle_log"),
        "stream_fan_out_contents": _sql(
            f"SELECT 'battles' AS table_name, concat_ws('|', battle_time, game_mode, {_SIDES_TEXT}, array_to_string(p1_deck, ','),"
            " array_to_string(p2_deck, ',')) AS content FROM battle_log"
            f" UNION ALL SELECT 'documents', concat_ws('|', battle_time, coalesce(m.name_en, 'Unknown'), {_SIDES_TEXT},"
            f" array_to_string({_names('p1_deck')}, ','), array_to_string({_names('p2_deck')}, ','))"
            " FROM battle_log b LEFT JOIN mode_dim m ON m.id = b.game_mode"
            " UNION ALL SELECT 'game_points', concat_ws('|', battle_time, player1_tag, player2_tag, game_mode, player1_trophies,"
            " player1_crowns, player2_trophies, player2_crowns) FROM game_points"
            f" UNION ALL SELECT 'card_points', concat_ws('|', battle_time, game_mode, card, crowns, trophies) FROM"
            f" ({_CARD_POINTS.replace('battles', 'battle_log')})"
            + "".join(f" UNION ALL SELECT 'quarantine', '{text}|{reason}'" for text, reason in _BROKEN),
            "battle_log", "mode_dim", "game_points"),
        "stream_points_latest": _sql(
            "SELECT battle_time, p1_tag AS player1_tag, p2_tag AS player2_tag, game_mode, p1_trophies AS player1_trophies,"
            " CAST(p1_crowns + CASE WHEN battle_id % 60 = 0 THEN -1 WHEN battle_id % 30 = 0 THEN 2 ELSE 0 END AS INTEGER) AS player1_crowns,"
            " p2_trophies AS player2_trophies, p2_crowns AS player2_crowns FROM battles", "battles"),
        "stream_dead_letters": _sql(
            "SELECT CAST(count(*) + 1 AS VARCHAR) AS value, 'stored' AS reason FROM battles"
            + "".join(f" UNION ALL SELECT '{text}', '{reason}'" for text, reason in _BROKEN), "battles"),
        "stream_progress": _sql(
            "SELECT k AS batch_id, count(*) + k AS rows, k AS quarantined FROM (SELECT CASE WHEN battle_time < '20240108' THEN 0"
            " WHEN battle_time < '20240122' THEN 1 ELSE 2 END::BIGINT AS k FROM battles) GROUP BY k", "battles"),
        "stream_matrix": _sql(f"SELECT {matrix_columns} FROM matrix", "matrix"),
        "state_restarted": _sql(f"SELECT {matrix_columns} FROM matrix", "matrix"),
        "state_model_reloaded": _sql(
            "SELECT deck_pattern_id, count(*) AS ratings, true AS solved FROM mapping JOIN matrix USING (deck_pattern) GROUP BY deck_pattern_id",
            "mapping", "matrix"),
        "stream_dedup": _sql(f"SELECT * REPLACE ({_DECKS}) FROM canonical", "canonical"),
        "stream_card_usage_window": _sql(
            "SELECT CAST(strptime(substr(battle_time, 1, 8), '%Y%m%d') AS DATE) AS battle_date, card, count(*) AS battles,"
            " CAST(sum(crowns) AS BIGINT) AS crowns FROM card_points GROUP BY ALL", "card_points"),
        "stream_card_metrics": _sql(
            "SELECT CAST(strptime(substr(battle_time, 1, 8), '%Y%m%d') AS DATE) AS battle_date, card, count(*) AS battles,"
            f" CAST(sum(crowns) AS BIGINT) AS crowns FROM ({_CARD_POINTS.replace('FROM battles', 'FROM by_tag')}) GROUP BY ALL", "by_tag"),
        "log_daily_index": (
            "SELECT concat_ws(' ', CAST(event_id AS VARCHAR), event_type, props) AS value, true AS in_index_of_day FROM events"),
    }


_cte("pool_last", _POOL.format(matches="top5_by_batch", mapping="mapping_by_batch", matrix="last_matrix"),
     "top5_by_batch", "mapping_by_batch", "last_matrix")
