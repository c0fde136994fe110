"""Set-similarity search between request decks and known patterns.

Scoring every request against every pattern, or against every pattern that shares a card, grows with the
popularity of a card. Instead both sides are keyed by the subsets of their card sets (at most 127, since
patterns and requests have at most 7 cards), and per subset only the patterns that can win are kept: the
first N by size, then id.

Why that is exact: take a pattern P of p cards among a request's best N, sharing exactly the set S with it.
Suppose N other patterns containing S come before P by (size, id). Each shares at least S and has at most p
cards, so its score is at least P's; where it is equal, the size is equal and the id lower. All N would
precede P in the order (score descending, id ascending), so P would not be among the best N. Hence P is
among the first N of the subset S, and reading every subset of the request finds it with its true overlap.
Other rows found this way are scored at most too low, never too high.

A card set of more than ``MAX_SET_SIZE`` cards has too many subsets. Such a pattern is scored directly against the requests it
shares a card with; such a request meets the index by its cards and keeps the subsets that lie inside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from battlelake.functions.decks import pattern_cards, subsets

# Fixed value: patterns pooled per request.
TOP_PATTERNS = 5
# Patterns and valid requests have at most 7 cards. Wider sets than this are not keyed by all their subsets.
MAX_SET_SIZE = 12
# More cards than any set has; overlaps are counted down from it.
_MOST_CARDS = 2**20


def _known_sets(mapping: DataFrame, per_set: int) -> DataFrame:
    """Card sets of the patterns; of patterns with equal sets the lowest ids suffice."""
    rank = F.row_number().over(Window.partitionBy("known").orderBy("deck_pattern_id"))
    return (
        mapping.select("deck_pattern_id", pattern_cards(F.col("deck_pattern")).alias("known"))
        .withColumn("place", rank)
        .where(F.col("place") <= per_set)
        .select("deck_pattern_id", F.size("known").alias("known_size"), "known")
    )


def _by_subset(sets: DataFrame, cards: str) -> DataFrame:
    rest = [c for c in sets.columns if c != cards]
    return sets.select(*rest, F.explode(subsets(F.col(cards))).alias("shared"))


def _narrow(sets: DataFrame, cards: str) -> DataFrame:
    return sets.where(F.size(cards) <= MAX_SET_SIZE)


def _wide(sets: DataFrame, cards: str) -> DataFrame | None:
    """The sets too wide for subsets, or None; then the plan has no part for them."""
    found = sets.where(F.size(cards) > MAX_SET_SIZE)
    return None if found.isEmpty() else found


def subset_index(mapping: DataFrame, top_n: int = TOP_PATTERNS) -> DataFrame:
    """Per card subset the ``top_n`` patterns that can win: ``shared, deck_pattern_id, known_size``.

    It depends on the mapping alone and can be stored with it.
    """
    rows = _by_subset(_narrow(_known_sets(mapping, top_n), "known"), "known")
    place = F.row_number().over(
        Window.partitionBy("shared").orderBy("known_size", "deck_pattern_id")
    )
    # The limit is applied in every task before the shuffle, so a subset of popular cards is a few rows a task.
    return rows.withColumn("place", place).where(F.col("place") <= top_n).select(
        "shared", "deck_pattern_id", "known_size"
    )


def _overlaps(request_sets: DataFrame, known: DataFrame, index: DataFrame) -> DataFrame:
    """(cards, overlap, the index's other columns): what each request shares with the patterns that can win.

    ``known`` has the patterns' card sets in ``known``; ``index`` their subsets in ``shared``.
    """
    kept = [c for c in index.columns if c != "shared"]
    columns = ["cards", *kept, "overlap"]
    found = _by_subset(_narrow(request_sets, "cards").select("cards", F.col("cards").alias("subset_of")), "subset_of").join(
        index, "shared").withColumn("overlap", F.size("shared")).select(*columns)
    if (asking := _wide(request_sets, "cards")) is not None:
        first = asking.select("cards", F.explode("cards").alias("first"))
        inside = F.forall("shared", lambda c: F.array_contains("cards", c))
        found = found.unionByName(
            first.join(index.withColumn("first", F.get("shared", F.lit(0))), "first").where(inside)
            .withColumn("overlap", F.size("shared")).select(*columns))
    if (patterns := _wide(known, "known")) is not None:
        by_card = patterns.select(*kept, F.explode("known").alias("card"))
        found = found.unionByName(
            request_sets.select("cards", F.explode("cards").alias("card")).join(by_card, "card")
            .groupBy("cards", *kept).agg(F.count(F.lit(1)).cast("int").alias("overlap")).select(*columns))
    return found


def similar_patterns(
    request_sets: DataFrame, mapping: DataFrame, top_n: int = TOP_PATTERNS, index: DataFrame | None = None,
) -> DataFrame:
    """Best ``top_n`` patterns per request set by Jaccard score, ties by lower id.

    ``request_sets``: distinct sorted arrays in ``cards``. All patterns qualify: with fewer than ``top_n``
    overlapping ones, the lowest ids with score 0 follow. ``index``: a stored ``subset_index``, else one is
    built for the requests at hand.
    """
    index = subset_index(mapping, top_n) if index is None else index
    overlapping = _overlaps(request_sets, _known_sets(mapping, top_n), index)
    lowest = (
        mapping.orderBy("deck_pattern_id").limit(top_n)
        .select(F.struct(
            "deck_pattern_id",
            F.size(pattern_cards(F.col("deck_pattern"))).alias("known_size"),
        ).alias("row"))
        .agg(F.collect_list("row"))
        .scalar()
    )
    unrelated = request_sets.select("cards", F.inline(lowest)).withColumn("overlap", F.lit(0))
    union_size = F.size("cards") + F.col("known_size") - F.col("overlap")
    order = Window.partitionBy("cards").orderBy(F.desc("score"), "deck_pattern_id")
    return (
        overlapping.unionByName(unrelated)
        .groupBy("cards", "deck_pattern_id")
        .agg(F.max("overlap").alias("overlap"), F.max("known_size").alias("known_size"))
        .select("cards", "deck_pattern_id", (F.col("overlap") / union_size).alias("score"))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= top_n)
    )


def best_overlaps(request_sets: DataFrame, mapping: DataFrame) -> DataFrame:
    """The pattern sharing most cards with each request set, ties by lower id; none without overlap."""
    known = mapping.select(
        "deck_pattern_id", pattern_cards(F.col("deck_pattern")).alias("known")
    ).groupBy("known").agg(F.min("deck_pattern_id").alias("deck_pattern_id"))
    # The least id of each subset is found in every task before the shuffle.
    index = _by_subset(_narrow(known, "known"), "known").groupBy("shared").agg(F.min("deck_pattern_id").alias("deck_pattern_id"))
    # One number orders by overlap (more first), then id: a fixed-width key keeps the aggregation hashed.
    rank = F.shiftleft((F.lit(_MOST_CARDS) - F.col("overlap")).cast("bigint"), 32) + F.col("deck_pattern_id")
    return (
        _overlaps(request_sets, known, index)
        .groupBy("cards")
        .agg(F.min(rank).alias("rank"))
        .select(
            "cards",
            F.col("rank").bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("deck_pattern_id"),
            (F.lit(_MOST_CARDS) - F.shiftright("rank", 32)).cast("int").alias("overlap"),
        )
    )
