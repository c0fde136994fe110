"""Next-card recommendations for a table of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from battlelake.functions.decks import card_set
from battlelake.operators.matching import TOP_PATTERNS, best_overlaps, similar_patterns
from battlelake.operators.matrix import popular_cards
from battlelake.session import cut_lineage

# Accepted request sizes and the default number of cards asked for.
MIN_DECK, MAX_DECK = 1, 7
MIN_CARDS, MAX_CARDS = 1, 10
DEFAULT_CARDS = 3


def _good_size() -> Column:
    # IN evaluates the deck once, where a range comparison would evaluate it twice.
    return F.coalesce(F.size("partial_deck"), F.lit(0)).isin(list(range(MIN_DECK, MAX_DECK + 1)))


def _wanted() -> Column:
    return F.coalesce(F.col("num_recommendations"), F.lit(DEFAULT_CARDS))


def checked_requests(requests: DataFrame) -> DataFrame:
    """Requests with the default filled in, and the reason why a request is turned down (else null)."""
    reason = (
        F.when(~_good_size(), "deck size").when(~_wanted().between(MIN_CARDS, MAX_CARDS), "number of cards")
    )
    return requests.withColumn("rejected", reason).withColumn("num_recommendations", _wanted())


def _valid(requests: DataFrame) -> DataFrame:
    return requests.where(_wanted().between(MIN_CARDS, MAX_CARDS) & _good_size()).select(
        "request_id", card_set(F.col("partial_deck")).alias("cards"), _wanted().alias("wanted")
    )


def request_sets(requests: DataFrame) -> DataFrame:
    """Distinct card sets of the valid requests; each is matched once, however often it is asked."""
    return _valid(requests).select("cards").distinct()


def _ranked(scored: DataFrame) -> DataFrame:
    order = Window.partitionBy("cards", "wanted").orderBy(F.desc("score"), "card_id")
    return scored.withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= F.col("wanted")
    )


def _answer(valid: DataFrame, ranked: DataFrame) -> DataFrame:
    return valid.join(ranked, ["cards", "wanted"]).select(
        "request_id", "place", "card_id", "score", "appearances"
    )


def recommend_pooled(
    requests: DataFrame, mapping: DataFrame, matrix: DataFrame, top_patterns: int = TOP_PATTERNS
) -> DataFrame:
    """Cards of the most similar patterns, pooled and averaged; popular cards fill up short lists."""
    valid = _valid(requests)
    asked = cut_lineage(valid.select("cards", "wanted").distinct())
    matches = similar_patterns(asked.select("cards").distinct(), mapping, top_patterns)
    pooled = (
        matches.join(matrix, "deck_pattern_id")
        .where(~F.array_contains("cards", F.col("next_card")))
        .groupBy("cards", F.col("next_card").alias("card_id"))
        .agg(
            F.sum("effectiveness_score").alias("score_sum"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("total_appearances").alias("appearances"),
        )
    )
    # At most one entry per card of the game, from at most top_patterns patterns.
    per_set = pooled.groupBy("cards").agg(
        F.sum("rows").alias("found"),
        F.collect_list(F.struct("card_id", "score_sum", "rows", "appearances")).alias("pool"),
    )
    # No request needs a popular card beyond this place: it has at most MAX_DECK cards to leave out.
    popular = (
        popular_cards(matrix)
        .orderBy(F.desc("total_appearances"), "next_card")
        .limit(MAX_CARDS + MAX_DECK)
        .agg(F.sort_array(F.collect_list(F.struct(
            (-F.col("total_appearances")).alias("order"),
            F.col("next_card").alias("card_id"),
            F.col("effectiveness_score").alias("score_sum"),
            F.lit(1).cast("bigint").alias("rows"),
            F.col("total_appearances").alias("appearances"),
        ))))
        .scalar()
    )
    missing = F.greatest(
        F.col("wanted").cast("bigint") - F.coalesce("found", F.lit(0).cast("bigint")),
        F.lit(0).cast("bigint"),
    ).cast("int")
    extra = F.transform(
        F.slice(F.filter("popular", lambda p: ~F.array_contains("cards", p["card_id"])), 1, missing),
        lambda p: F.struct(
            p["card_id"].alias("card_id"), p["score_sum"].alias("score_sum"),
            p["rows"].alias("rows"), p["appearances"].alias("appearances"),
        ),
    )
    no_pool = F.array().cast("array<struct<card_id:int,score_sum:double,rows:bigint,appearances:bigint>>")
    candidates = asked.join(per_set, "cards", "left").withColumn("popular", popular).select(
        "cards", "wanted", F.inline(F.concat(F.coalesce("pool", no_pool), extra))
    )
    scores = candidates.groupBy("cards", "wanted", "card_id").agg(
        (F.sum("score_sum") / F.sum("rows")).alias("score"),
        F.sum("appearances").alias("appearances"),
    )
    return _answer(valid, _ranked(scores))


def recommend_single(requests: DataFrame, mapping: DataFrame, matrix: DataFrame) -> DataFrame:
    """Cards of the one pattern that shares most cards with the request."""
    valid = _valid(requests)
    asked = cut_lineage(valid.select("cards", "wanted").distinct())
    best = best_overlaps(asked.select("cards").distinct(), mapping)
    scores = (
        asked.join(best, "cards")
        .join(matrix, "deck_pattern_id")
        .where(~F.array_contains("cards", F.col("next_card")))
        .select(
            "cards", "wanted", F.col("next_card").alias("card_id"),
            F.col("effectiveness_score").alias("score"),
            F.col("total_appearances").alias("appearances"),
        )
    )
    return _answer(valid, _ranked(scores))


def named(recommendations: DataFrame, cards: DataFrame) -> DataFrame:
    """Key and name of each recommended card; null for cards the dimension does not know."""
    dim = cards.select(F.col("id").alias("card_id"), F.col("key").alias("card_key"), F.col("name").alias("card_name"))
    return recommendations.join(dim, "card_id", "left")


def flag_scores(recommendations: DataFrame) -> DataFrame:
    """Mark scores outside 0..1 instead of turning the rows down."""
    return recommendations.withColumn("in_unit_range", F.col("score").between(0, 1))
