"""Every registered query: name -> function of (session, folder of the given tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from battlelake.functions import decks as deck_fn
from battlelake.functions.values import asset_path, battle_date, matches_name, printable, version_stamp
from battlelake.operators import (
    als, canonical, decks, enrich, frontier, mapping, matching, matrix, performance, points, recommend, usage,
)
from battlelake.plans import training
from battlelake.sources import dims, fixtures, logs
from battlelake.streaming import registry
from battlelake.session import cut_lineage, put_text, shuffle_width, work_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Batches of the incremental queries: the battles before, between and after these times (season starts).
BATCH_STARTS = ("20240108", "20240122")
# Cards asked for by the deck filter, by key.
INCLUDE, EXCLUDE = ["card-5"], ["card-7", "card-11"]
# Multi-hot widths of the two sides.
TEAM_WIDTH, OPPONENT_WIDTH = 256, 128


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared inputs ---------------------------------------------------------------------------------

def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.battles_flat_from(fixtures.read_events(spark, sf_dir))


def _battles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.nest(_flat(spark, sf_dir))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.battle_log(_battles(spark, sf_dir))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(spark, sf_dir).withColumn("battle_date", battle_date(F.col("battle_time")))


def _batches(battles: DataFrame) -> list[DataFrame]:
    time = F.col("battle_time")
    first, second = BATCH_STARTS
    return [
        battles.where(time < first),
        battles.where((time >= first) & (time < second)),
        battles.where(time >= second),
    ]


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.requests(_flat(spark, sf_dir))


def _six(*names: str) -> dict[str, Column]:
    return {name: F.round(name, 6) for name in names}


def _rounded_matrix(df: DataFrame) -> DataFrame:
    return df.withColumns(_six(
        "weighted_performance", "performance_consistency", "avg_sequence_length",
        "frequency_score", "consistency_factor", "effectiveness_score",
    ))


def _deck_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: deck_fn.pattern_of(F.col(c)) for c in columns})


def _flat_text(battles: DataFrame) -> DataFrame:
    return _deck_text(performance.flatten(battles), "p1_deck", "p2_deck")


# --- scoring (P1-P6, U1, F1-F4, F26, M2, M8, A1, W1, F7-F9) ------------------------------------------

@query
def battles_flat(spark, sf_dir):
    return _flat_text(_battles(spark, sf_dir))


@query
def battle_outcomes(spark, sf_dir):
    scored = performance.with_outcomes(performance.flatten(_battles(spark, sf_dir)))
    return scored.select("battle_id", "p1_crowns", "p2_crowns", "p1_outcome", "p2_outcome")


def _player_scores(results: DataFrame) -> DataFrame:
    return results.select(
        "battle_id", "side", "tag", "trophies", "opponent_trophies", "outcome",
        F.round("performance_score", 6).alias("performance_score"),
    )


@query
def player_performance(spark, sf_dir):
    return _player_scores(performance.player_results(_battles(spark, sf_dir)))


@query
def player_performance_legacy(spark, sf_dir):
    return _player_scores(performance.player_results(_battles(spark, sf_dir), legacy=True))


@query
def deck_sequences(spark, sf_dir):
    rows = performance.deck_sequences(performance.player_results(_battles(spark, sf_dir)))
    return rows.withColumns(_six("performance_score"))


@query
def effectiveness_matrix(spark, sf_dir):
    return _rounded_matrix(matrix.scored(training.batch_moments(_battles(spark, sf_dir))))


@query
def effectiveness_matrix_legacy(spark, sf_dir):
    return _rounded_matrix(matrix.scored(training.batch_moments(_battles(spark, sf_dir), legacy=True)))


# --- mapping and state (W2-W4, J1, A2, A3, A11, A12, U2-U4) ------------------------------------------

@query
def pattern_mapping(spark, sf_dir):
    results = performance.player_results(_battles(spark, sf_dir))
    return mapping.new_mapping(performance.known_patterns(results))


@query
def pattern_mapping_incremental(spark, sf_dir):
    return training.run_batches(_batches(_battles(spark, sf_dir))).mapping


@query
def accumulated_matrix(spark, sf_dir):
    return _rounded_matrix(training.run_batches(_batches(_battles(spark, sf_dir))).matrix())


@query
def accumulated_matrix_legacy(spark, sf_dir):
    return _rounded_matrix(training.accumulate_batches_legacy(_batches(_battles(spark, sf_dir))))


# --- recommender (P18, P21, P22, F5, F6, F10, J2, J6-J8, J12, A9, A10, T1-T3, M6, M7) ----------------

def _matched(df: DataFrame) -> DataFrame:
    return df.withColumn("cards", deck_fn.pattern_of(F.col("cards")))


@query
def jaccard_matches(spark, sf_dir):
    state = training.start(_battles(spark, sf_dir))
    sets = cut_lineage(recommend.request_sets(_requests(spark, sf_dir)))
    return _matched(matching.similar_patterns(sets, state.mapping)).withColumns(_six("score"))


@query
def best_overlap_match(spark, sf_dir):
    state = training.start(_battles(spark, sf_dir))
    sets = cut_lineage(recommend.request_sets(_requests(spark, sf_dir)))
    return _matched(matching.best_overlaps(sets, state.mapping))


@query
def exact_pattern_lookup(spark, sf_dir):
    """Requests in the order given, looked up as patterns; unknown ones keep a null id."""
    state = training.start(_battles(spark, sf_dir))
    asked = _requests(spark, sf_dir).select(
        "request_id", deck_fn.pattern_of(F.col("partial_deck")).alias("deck_pattern")
    )
    return mapping.lookup_patterns(asked, state.mapping)


@query
def popular_cards(spark, sf_dir):
    scored = matrix.scored(training.batch_moments(_battles(spark, sf_dir)))
    return matrix.popular_cards(scored).withColumns(_six("effectiveness_score"))


def _rounded_scores(df: DataFrame) -> DataFrame:
    return df.withColumns(_six("score"))


@query
def recommend_pooled(spark, sf_dir):
    state = training.start(_battles(spark, sf_dir))
    return _rounded_scores(
        recommend.recommend_pooled(_requests(spark, sf_dir), state.mapping, state.matrix())
    )


@query
def recommend_pooled_last_batch(spark, sf_dir):
    """Earlier serving: patterns of all batches, scores of the last batch only."""
    state = training.run_batches(_batches(_battles(spark, sf_dir)))
    return _rounded_scores(
        recommend.recommend_pooled(_requests(spark, sf_dir), state.mapping, state.last_matrix())
    )


@query
def recommend_single(spark, sf_dir):
    state = training.start(_battles(spark, sf_dir))
    return _rounded_scores(
        recommend.recommend_single(_requests(spark, sf_dir), state.mapping, state.matrix())
    )


@query
def recommend_named(spark, sf_dir):
    state = training.start(_battles(spark, sf_dir))
    found = recommend.recommend_single(_requests(spark, sf_dir), state.mapping, state.matrix())
    return _rounded_scores(recommend.flag_scores(recommend.named(found, fixtures.card_dim(spark))))


@query
def request_validation(spark, sf_dir):
    checked = recommend.checked_requests(_requests(spark, sf_dir))
    return checked.select(
        "request_id", "num_recommendations", "rejected",
        deck_fn.sorted_pattern_of(F.col("partial_deck")).alias("deck_pattern"),
    )


# --- batch deck analytics (P13-P15, P23-P25, U5-U7, U9, J5, J10, J13, A4-A8, A14, W5, W6, F12-F15) ---

@query
def canonical_battles(spark, sf_dir):
    return _flat_text(canonical.canonical_battles(_log(spark, sf_dir)))


@query
def winner_first_battles(spark, sf_dir):
    return _flat_text(canonical.distinct_battles(canonical.winner_first(_log(spark, sf_dir))))


@query
def season_dedup(spark, sf_dir):
    return _flat_text(canonical.season_battles(_log(spark, sf_dir), fixtures.season_dim(spark)))


@query
def season_summary(spark, sf_dir):
    rows = canonical.season_battles(_log(spark, sf_dir), fixtures.season_dim(spark))
    return canonical.season_summary(rows)


def _pair_text(stats: DataFrame) -> DataFrame:
    return _deck_text(stats, "deck_a", "deck_b")


@query
def deck_pair_stats(spark, sf_dir):
    return _pair_text(decks.deck_pair_stats(_flat(spark, sf_dir)))


@query
def deck_pair_stats_set_mirrors(spark, sf_dir):
    return _pair_text(decks.deck_pair_stats(_flat(spark, sf_dir), any_order=True))


@query
def deck_pair_stats_merged(spark, sf_dir):
    """Season table folded from the tables of the batches."""
    tables = [decks.deck_pair_stats(flat) for flat in _batches(_flat(spark, sf_dir))]
    return _pair_text(decks.merge_deck_stats(*tables))


@query
def deck_pair_file_rows(spark, sf_dir):
    """The file form of the pair table: card places instead of ids, and the text key it sorts by.

    A card without a place keeps its id; ``unknown_cards`` counts those of the row.
    """
    places = decks.card_index_map(fixtures.card_dim(spark))
    encoded = _flat(spark, sf_dir).withColumns({
        side: decks.indexed(F.col(side), places, keep_unknown=True) for side in ("p1_deck", "p2_deck")
    })
    rows = decks.flat_deck_columns(decks.deck_pair_stats(encoded))
    cards = [c for c in rows.columns if c not in ("wins", "losses")]
    known = F.map_values(places)
    unknown = F.size(F.filter(F.array(*cards), lambda c: ~F.array_contains(known, c)))
    return rows.withColumns({"unknown_cards": unknown, "sort_key": deck_fn.padded_key(F.array(*cards))})


@query
def card_usage_daily(spark, sf_dir):
    return usage.card_usage_daily(_dated(spark, sf_dir)).withColumns(_six("share"))


@query
def recent_card_usage(spark, sf_dir):
    """Usage over the last seven days that have battles."""
    recent = canonical.last_days(_dated(spark, sf_dir), 7)
    return usage.card_usage_daily(recent).withColumns(_six("share"))


@query
def card_usage_total(spark, sf_dir):
    total = usage.card_usage_total(_flat(spark, sf_dir), fixtures.card_dim(spark))
    return total.orderBy("usage", "card")


@query
def deck_usage_top(spark, sf_dir):
    return _deck_text(usage.top_decks(usage.deck_usage(_flat(spark, sf_dir)), 10), "deck")


@query
def deck_usage_daily_top10_sum(spark, sf_dir):
    return _deck_text(usage.deck_usage_daily_top_sum(_dated(spark, sf_dir)), "deck")


@query
def deck_filter(spark, sf_dir):
    cards = fixtures.card_dim(spark)
    wanted, unwanted = decks.resolve_keys(cards, INCLUDE), decks.resolve_keys(cards, EXCLUDE)
    found = decks.decks_with(decks.all_decks(_flat(spark, sf_dir), "battle_id"), wanted, unwanted)
    return _deck_text(found, "deck")


def _multi_hot(spark: SparkSession, sf_dir: str, legacy: bool) -> DataFrame:
    places = decks.card_index_map(fixtures.card_dim(spark))
    wide = decks.multi_hot_battles(
        _flat(spark, sf_dir), places, TEAM_WIDTH, OPPONENT_WIDTH, legacy, as_text=True
    )
    return wide.select("battle_id", "p1_cards", "p2_cards", "unknown_cards")


@query
def deck_multi_hot(spark, sf_dir):
    return _multi_hot(spark, sf_dir, legacy=False)


@query
def deck_multi_hot_legacy(spark, sf_dir):
    return _multi_hot(spark, sf_dir, legacy=True)


# --- enrichment, series and frontier (S7, P7-P12, P19, P20, P26-P28, J3, J4, J9, J11, A15, A16, T7, T9) ---

def _documents(spark: SparkSession, sf_dir: str, legacy: bool) -> DataFrame:
    return enrich.search_documents(
        _battles(spark, sf_dir), fixtures.card_dim(spark), dims.game_mode_dim(spark), legacy
    )


@query
def search_documents(spark, sf_dir):
    documents = _documents(spark, sf_dir, legacy=False)
    return documents.withColumns({
        c: F.array_join(c, "|") for c in ("player1_deck_names", "player2_deck_names")
    })


@query
def search_documents_legacy(spark, sf_dir):
    return _documents(spark, sf_dir, legacy=True)


@query
def game_points(spark, sf_dir):
    return points.game_points(performance.flatten(_log(spark, sf_dir)))


@query
def card_points(spark, sf_dir):
    return points.card_points(_flat(spark, sf_dir))


@query
def player_trophy_series(spark, sf_dir):
    wide = points.game_points(performance.flatten(_log(spark, sf_dir)))
    return points.player_trophy_series(wide).drop("ts")


@query
def player_series_ordered(spark, sf_dir):
    """Every player's series with the place of each point in time."""
    wide = points.game_points(performance.flatten(_log(spark, sf_dir)))
    return points.ordered_series(points.player_trophy_series(wide)).drop("battle_time")


@query
def field_series_join(spark, sf_dir):
    """Trophies beside crowns of player 2 within a time range, joined from the long form."""
    long = points.long_form(points.game_points(performance.flatten(_log(spark, sf_dir))))
    span = {"start": "20240105", "stop": "20240120"}
    return points.join_series(
        points.select_points(long, "player2_trophies", **span),
        points.select_points(long, "player2_crowns", **span),
        "trophies", "crowns",
    )


@query
def card_search(spark, sf_dir):
    """Cards in use whose name holds the query, with their usage and picture path."""
    used = usage.card_usage_total(_flat(spark, sf_dir), fixtures.card_dim(spark))
    found = used.where(matches_name(F.col("card_name"), "CARD 1"))
    key = F.regexp_replace(F.lower("card_name"), " ", "-")
    return found.withColumn("picture", asset_path("assets/cards", key))


@query
def deck_toggle(spark, sf_dir):
    card = (F.lit(fixtures.FIRST_CARD) + F.col("battle_id") % fixtures.CARDS).cast("int")
    return _flat(spark, sf_dir).select(
        "battle_id",
        deck_fn.pattern_of(deck_fn.toggle(F.col("p1_deck"), card)).alias("deck"),
    )


def _frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _flat(spark, sf_dir)
    asked = flat.where(F.col("p1_trophies") >= 6500).select(F.col("p1_tag").alias("tag"))
    return frontier.frontier(flat, asked)


@query
def player_frontier(spark, sf_dir):
    return _frontier(spark, sf_dir)


@query
def frontier_next(spark, sf_dir):
    return frontier.next_players(_frontier(spark, sf_dir), 20)


@query
def crawl_counters(spark, sf_dir):
    return frontier.crawl_counters(frontier.one_on_one(_flat(spark, sf_dir)))


@query
def one_on_one_modes(spark, sf_dir):
    kept = frontier.above_ranked_floor(frontier.one_on_one(_flat(spark, sf_dir)))
    return kept.select(
        "battle_id", "game_mode", frontier.mode_class(F.col("game_mode")).alias("mode_class")
    )


@query
def raw_log_normalise(spark, sf_dir):
    raw = fixtures.raw_log(_log(spark, sf_dir))
    return _flat_text(logs.normalise_raw(raw))


# --- records, files and tables (S3-S6, S8, S9, S11, K5, K6, K12, T8, F19, F23, F24) -------------------

def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic records: every event type is a topic, errors carry undecodable bytes."""
    return fixtures.read_events(spark, sf_dir).select(
        F.col("event_type").alias("topic"),
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "props"))
        .otherwise(F.col("props")).cast("binary").alias("value"),
    )


@query
def topic_records(spark, sf_dir):
    """All topics but the internal one, key and value as text, the decoded value beside them."""
    chosen = logs.except_topics(_records(spark, sf_dir), ["signup"])
    return logs.decode_beside(chosen, "k int").select(
        "key", "value", F.col("json_data.k").alias("k")
    )


@query
def tolerant_decode(spark, sf_dir):
    read = logs.tolerant(_records(spark, sf_dir))
    return read.select(
        F.col("key").cast("string").alias("key"), "undecodable",
        F.try_variant_get("document", "$.k", "int").alias("k"),
    )


@query
def publish_records(spark, sf_dir):
    """Winner-first battles published as JSON text and decoded again."""
    published = logs.to_records(
        canonical.distinct_battles(canonical.winner_first(_log(spark, sf_dir)))
    )
    return _flat_text(logs.decode(published))


@query
def csv_table(spark, sf_dir):
    """Canonical battles through sorted gzip CSV into a parquet table by day, and back."""
    csv_path, table_path = work_path(spark, "battles-csv"), work_path(spark, "battles-table")
    flat = performance.flatten(canonical.by_tag(_log(spark, sf_dir))).drop("battle_id")
    logs.write_sorted_csv(logs.flat_to_csv(flat), csv_path)
    return _deck_text(logs.csv_to_parquet(spark, csv_path, table_path), "p1_deck", "p2_deck")


@query
def csv_table_appended(spark, sf_dir):
    """The table of ``csv_table`` from files that grew batch by batch, one batch sent twice, converted again by force."""
    csv_path, table_path = work_path(spark, "battles-csv"), work_path(spark, "battles-table")
    first, second, third = [
        logs.flat_to_csv(performance.flatten(battles)) for battles in _batches(canonical.by_tag(_log(spark, sf_dir)))]
    logs.write_sorted_csv(first, csv_path)
    logs.csv_to_parquet(spark, csv_path, table_path)
    for batch in (second, third, second):
        logs.append_sorted_csv(batch, csv_path)
    return _deck_text(logs.csv_to_parquet(spark, csv_path, table_path, force=True), "p1_deck", "p2_deck")


@query
def deck_pair_file(spark, sf_dir):
    """The pair table written to CSV in deck order and read back."""
    path = work_path(spark, "deck-pairs")
    decks.write_deck_file(decks.deck_pair_stats(_flat(spark, sf_dir)), path)
    return decks.read_deck_file(spark, path)


@query
def search_documents_from_files(spark, sf_dir):
    """The named documents with cards and game modes read from their JSON files."""
    cards, modes = f"{work_path(spark, 'cards')}.json", f"{work_path(spark, 'modes')}.json"
    for path, dim in ((cards, fixtures.card_dim(spark).orderBy("card_index")), (modes, dims.game_mode_dim(spark))):
        put_text(spark, path, "[" + ",".join(dim.toJSON().collect()) + "]")
    documents = enrich.search_documents(_battles(spark, sf_dir), dims.read_cards(spark, cards), dims.read_game_modes(spark, modes))
    return documents.withColumns({
        c: F.array_join(c, "|") for c in ("player1_deck_names", "player2_deck_names")
    })


def _player_tables(spark, sf_dir):
    """Results and trophy points of every player as two catalog tables in the same buckets."""
    battles, log = _battles(spark, sf_dir), _log(spark, sf_dir)
    series = points.player_trophy_series(points.game_points(performance.flatten(log)))
    mark, width = uuid.uuid4().hex, shuffle_width(spark)
    return [
        logs.save_by_player(rows, f"{name}_{mark}", work_path(spark, name), width)
        for name, rows in (("player_results", performance.player_results(battles)), ("player_points", series))
    ]


@query
def player_totals(spark, sf_dir):
    """Wins and highest trophies of each player from two bucketed catalog tables, joined where they lie."""
    results, series = _player_tables(spark, sf_dir)
    won = results.groupBy("tag").agg(F.count(F.lit(1)).alias("battles"), F.count_if(F.col("outcome") == "win").alias("wins"))
    best = series.groupBy("tag").agg(F.max("trophies").alias("best_trophies"))
    return won.join(best.hint("merge"), "tag")


@query
def winner_first_canonical(spark, sf_dir):
    """Every battle once with its winner first; a draw is one battle too."""
    return _flat_text(canonical.winners_first(_log(spark, sf_dir)))


@query
def odd_numbers(spark, sf_dir):
    """Values as text where JSON cannot carry them: the ratio of value and crowns, with its infinities."""
    events = fixtures.read_events(spark, sf_dir)
    ratio = F.when(F.col("event_id") % 4 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    return events.select("event_id", printable(ratio).alias("as_text"))


# --- ML and registry (A13, A17, K7-K11, S13, T6, T10, M3-M5, X6) --------------------------------------

@query
def als_residuals(spark, sf_dir):
    """Whether every pattern's factors solve their normal equations."""
    matrix = cut_lineage(training.start(_battles(spark, sf_dir)).matrix())
    found = als.residuals(als.fit(matrix), matrix)
    return found.select("deck_pattern_id", "ratings", (F.col("residual") < 1e-3).alias("solved"))


@query
def als_recommendations(spark, sf_dir):
    state = training.start(_battles(spark, sf_dir))
    model = als.fit(cut_lineage(state.matrix()))
    asked = _requests(spark, sf_dir).select(
        deck_fn.pattern_of(F.col("partial_deck")).alias("deck_pattern")
    )
    return als.recommend_patterns(model, asked, state.mapping, 3)


def _registered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Registry after each batch was saved, as one row per name and as one row per save."""
    upserted = registry.empty(spark)
    versions = registry.empty(spark)
    state = None
    for battles in _batches(_battles(spark, sf_dir)):
        state = training.advance(state, battles)
        saved = registry.row(
            "continuous_als_model", battles.agg(F.max("battle_time")), state.mapping, state.moments
        )
        upserted = registry.upsert(upserted, saved)
        stamped = F.concat(F.lit("als_model_"), version_stamp(F.col("timestamp")))
        versions = registry.append(versions, saved.withColumn("model_name", stamped))
    return upserted, versions


@query
def model_registry_latest(spark, sf_dir):
    return registry.latest(_registered(spark, sf_dir)[0]).select(
        "model_name", "timestamp", "total_patterns", "total_training_samples"
    )


@query
def model_registry_versions(spark, sf_dir):
    return _registered(spark, sf_dir)[1].select(
        "model_name", "timestamp", "total_patterns", "total_training_samples"
    )


@query
def state_profile(spark, sf_dir):
    state = training.start(_battles(spark, sf_dir))
    scored = state.matrix()
    return registry.profile(state.mapping, scored)


@query
def state_samples(spark, sf_dir):
    """Ten patterns of the state with their ids, as the profile shows them."""
    state = training.start(_battles(spark, sf_dir))
    return registry.samples(state.mapping, "deck_pattern", 10).select("deck_pattern", "deck_pattern_id")


@query
def recommendation_log(spark, sf_dir):
    """One row per answered request with its list of cards, as kept by the audit log."""
    state = training.start(_battles(spark, sf_dir))
    requests = _requests(spark, sf_dir)
    found = recommend.recommend_single(requests, state.mapping, state.matrix())
    log = registry.audit_log(requests, found)
    return log.select(
        "request_id",
        deck_fn.pattern_of(F.col("partial_deck")).alias("partial_deck"),
        F.array_join(F.transform("recommendations", lambda r: r["card_id"].cast("string")), ",")
        .alias("card_ids"),
    )
