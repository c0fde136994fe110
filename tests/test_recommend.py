"""Similarity search, ids and recommendations against plain Python on small random tables."""

import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from battlelake.operators import mapping as mapping_ops, matching, matrix as matrix_ops, recommend
from battlelake.operators.performance import player_results
from battlelake.plans import training
from battlelake.sources import fixtures


def table(spark, patterns):
    rows = [(pattern, i + 1) for i, pattern in enumerate(patterns)]
    return spark.createDataFrame(rows, "deck_pattern string, deck_pattern_id int")


def sets(spark, requests):
    return spark.createDataFrame([(sorted(set(r)),) for r in requests], "cards array<int>").distinct()


def brute_top(request, patterns, n):
    scored = []
    for i, pattern in enumerate(patterns):
        known = {int(c) for c in pattern.split(",")}
        shared, every = len(request & known), len(request | known)
        scored.append((-shared / every, i + 1))
    return [(i, -s) for s, i in sorted(scored)[:n]]


def brute_best(request, patterns):
    best, score = None, 0
    for i, pattern in enumerate(patterns):
        shared = len(request & {int(c) for c in pattern.split(",")})
        if shared > score:
            best, score = i + 1, shared
    return best, score


def random_patterns(rng, hot_share, cards, count):
    """Distinct ordered patterns; a share of them starts with the same card."""
    found = set()
    while len(found) < count:
        deck = rng.sample(range(1, cards + 1), rng.randint(1, 7))
        if rng.random() < hot_share and 1 not in deck:
            deck[0] = 1
        found.add(",".join(map(str, deck)))
    return sorted(found)


@pytest.mark.parametrize("seed, hot_share, cards, count", [
    (1, 0.0, 12, 300), (2, 0.5, 12, 400), (3, 0.9, 40, 300), (4, 0.3, 8, 3), (5, 0.0, 7, 60),
])
def test_matches_equal_brute_force(spark, seed, hot_share, cards, count):
    rng = random.Random(seed)
    patterns = random_patterns(rng, hot_share, cards, count)
    requests = [set(rng.sample(range(1, cards + 3), rng.randint(1, 7))) for _ in range(60)] + [{999}]
    asked, known = sets(spark, requests), table(spark, patterns)
    top, best = defaultdict(list), {}
    for row in matching.similar_patterns(asked, known).orderBy("place").collect():
        top[tuple(row["cards"])].append((row["deck_pattern_id"], row["score"]))
    for row in matching.best_overlaps(asked, known).collect():
        best[tuple(row["cards"])] = (row["deck_pattern_id"], row["overlap"])
    stored = matching.similar_patterns(asked, known, index=matching.subset_index(known)).collect()
    assert sorted((r["cards"], r["place"], r["deck_pattern_id"]) for r in stored) == sorted(
        (list(k), i + 1, p) for k, found in top.items() for i, (p, _) in enumerate(found))
    for request in requests:
        key = tuple(sorted(request))
        assert top[key] == [(i, pytest.approx(s)) for i, s in brute_top(request, patterns, 5)]
        assert best.get(key, (None, 0)) == brute_best(request, patterns)


def test_no_patterns_at_all(spark):
    asked, known = sets(spark, [{1}]), table(spark, ["1"]).where("false")
    assert matching.similar_patterns(asked, known).count() == 0
    assert matching.best_overlaps(asked, known).count() == 0


def brute_pooled(deck, wanted, patterns, rows):
    by_pattern, popular = defaultdict(list), defaultdict(list)
    for pattern_id, card, score, n in rows:
        by_pattern[pattern_id].append((card, score, n))
        popular[card].append((score, n))
    found = [r for i, _ in brute_top(set(deck), patterns, 5) for r in by_pattern[i] if r[0] not in deck]
    if len(found) < wanted:
        ranked = sorted(
            ((-sum(n for _, n in v), c, sum(s for s, _ in v) / len(v)) for c, v in popular.items() if c not in deck))
        found += [(c, s, -n) for n, c, s in ranked[:wanted - len(found)]]
    pooled = defaultdict(list)
    for card, score, n in found:
        pooled[card].append((score, n))
    final = sorted((-sum(s for s, _ in v) / len(v), c, sum(n for _, n in v)) for c, v in pooled.items())
    return [(c, -s, n) for s, c, n in final[:wanted]]


def test_pooled_recommendations_equal_brute_force(spark):
    rng = random.Random(7)
    patterns = random_patterns(rng, 0.4, 12, 40)
    rows = []
    for i in range(len(patterns)):
        for card in rng.sample(range(1, 13), rng.randint(0, 2)):
            rows.append((i + 1, card, rng.random() * 1.5, rng.randint(1, 9)))
    asked = [(i, rng.sample(range(1, 16), rng.randint(1, 7)), rng.choice([None, 1, 3, 7, 10])) for i in range(80)]
    asked += [(1000 + i, [3, 3, 4], 10) for i in range(50)]
    known = table(spark, patterns)
    scores = spark.createDataFrame(rows, "deck_pattern_id int, next_card int, effectiveness_score double, total_appearances long")
    requests = spark.createDataFrame(asked, "request_id long, partial_deck array<int>, num_recommendations int")
    got = defaultdict(list)
    for r in recommend.recommend_pooled(requests, known, scores).orderBy("request_id", "place").collect():
        got[r["request_id"]].append((r["card_id"], r["score"], r["appearances"]))
    for request_id, deck, wanted in asked:
        expected = brute_pooled(deck, wanted or 3, patterns, rows)
        assert got[request_id] == [(c, pytest.approx(s), n) for c, s, n in expected]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text("abc,12", min_size=1, max_size=6), min_size=1, max_size=40), st.integers(0, 5))
def test_dense_ids(spark, keys, start):
    rows = spark.createDataFrame([(k,) for k in keys], "deck_pattern string")
    got = {r["deck_pattern"]: r["deck_pattern_id"]
           for r in mapping_ops.dense_ids(rows, "deck_pattern", "deck_pattern_id", start).collect()}
    assert got == {k: i + start + 1 for i, k in enumerate(sorted(keys))}


def test_ids_stay_when_batches_come(spark, sf_dir):
    battles = fixtures.battles(spark, sf_dir)
    parts = [battles.where(F.col("battle_time") < "20240110"), battles.where(F.col("battle_time") >= "20240110")]
    first = training.start(parts[0])
    both = training.advance(first, parts[1])
    before = {r[0]: r[1] for r in first.mapping.collect()}
    after = {r["deck_pattern"]: r["deck_pattern_id"] for r in both.mapping.collect()}
    assert all(after[k] == v for k, v in before.items())
    assert sorted(after.values()) == list(range(1, len(after) + 1))


@pytest.mark.parametrize("ways", [1, 2, 5])
def test_any_split_gives_the_same_matrix(spark, sf_dir, ways):
    battles = fixtures.battles(spark, sf_dir)
    results = player_results(battles)
    whole = {(r["deck_pattern"], r["next_card"]): r for r in matrix_ops.effectiveness_matrix(results).collect()}
    # The built-in aggregates over the raw sequences, without pre-aggregation by deck.
    from battlelake.operators.performance import deck_sequences
    direct = deck_sequences(results).groupBy("deck_pattern", "next_card").agg(
        F.count(F.lit(1)).alias("n"), F.avg("performance_score").alias("mean"), F.stddev("performance_score").alias("sd"))
    for r in direct.collect():
        row = whole[(r["deck_pattern"], r["next_card"])]
        assert row["total_appearances"] == r["n"]
        assert row["weighted_performance"] == pytest.approx(r["mean"])
        assert row["performance_consistency"] == (r["sd"] if r["sd"] is None else pytest.approx(r["sd"], abs=1e-7))
    parts = [matrix_ops.pattern_moments(player_results(battles.where(F.pmod("battle_id", F.lit(ways)) == k))) for k in range(ways)]
    for r in matrix_ops.scored(matrix_ops.merge_moments(*parts)).collect():
        row = whole[(r["deck_pattern"], r["next_card"])]
        assert r["effectiveness_score"] == pytest.approx(row["effectiveness_score"], abs=1e-7)
    shares = defaultdict(float)
    for (pattern, _), row in whole.items():
        shares[pattern] += row["frequency_score"]
    assert all(share == pytest.approx(1.0) for share in shares.values())
