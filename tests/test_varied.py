"""Battles whose variety grows: what the fixture holds, the ranked floor, factors of unknown patterns."""

import numpy as np
from pyspark.sql import functions as F

from battlelake.functions.decks import pattern_of
from battlelake.operators import als, matching, recommend
from battlelake.plans import training, varied_queries
from battlelake.session import cut_lineage
from battlelake.sources import fixtures


def test_variety(spark, sf_dir):
    flat = varied_queries._flat(spark, sf_dir)
    n = flat.count()
    assert flat.select(pattern_of(F.col("p1_deck"))).distinct().count() > 0.9 * n
    assert flat.where(F.size(F.array_distinct("p1_deck")) + F.size(F.array_distinct("p2_deck")) < 16).count() == 0
    assert flat.where("p1_deck[0] = 26000000").count() > n / 3 and flat.where("p2_tag = 'P99999'").count() >= n // 3
    assert flat.where("p2_trophies < 31").count() > 0 and flat.where("battle_time > '2025'").count() > 0


def test_floor_removes_rows(spark, sf_dir):
    from battlelake.operators import frontier

    all_modes = frontier.one_on_one(varied_queries._flat(spark, sf_dir))
    assert 0 < frontier.above_ranked_floor(all_modes).count() < all_modes.count()


def test_factors_of_known_patterns_are_the_models(spark, sf_dir):
    """Folding in what the model was fitted with gives its own factors, which fitting ends with."""
    matrix = cut_lineage(training.start(varied_queries._battles(spark, sf_dir)).matrix())
    model = als.fit(matrix)
    own = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    found = {r["id"]: np.array(r["features"]) for r in als.fold_in(model, matrix).collect()}
    assert own.keys() == found.keys() and own
    assert max(np.abs(own[k] - found[k]).max() / max(1e-3, np.abs(own[k]).max()) for k in own) < 1e-2


def test_folding_in_without_known_cards_and_repeats(spark, sf_dir):
    matrix = cut_lineage(training.start(varied_queries._battles(spark, sf_dir)).matrix())
    model = als.fit(matrix)
    card = matrix.first()["next_card"]
    odd = spark.createDataFrame([(-1, 5, 1.0), (-2, card, 1.0), (-2, card, 1.0), (-3, None, 1.0)], "deck_pattern_id int, next_card int, effectiveness_score double")
    assert [r["id"] for r in als.fold_in(model, odd).collect()] == [-2]
    assert als.residuals(model, odd, als.fold_in(model, odd)).where("residual < 1e-9").count() == 1


def test_matching_equals_brute_force(spark, sf_dir):
    """Best five patterns of every eleventh request's set, against all patterns, where one card is in a third of all decks."""
    flat = varied_queries._flat(spark, sf_dir)
    known = cut_lineage(training.start(varied_queries._battles(spark, sf_dir)).mapping)
    asked = cut_lineage(recommend.request_sets(fixtures.requests(flat).where("request_id % 11 = 0")))
    found = {}
    for r in matching.similar_patterns(asked, known).collect():
        found.setdefault(tuple(r["cards"]), []).append((r["place"], r["deck_pattern_id"], round(r["score"], 9)))
    sets = sorted((r["deck_pattern_id"], frozenset(map(int, r["deck_pattern"].split(",")))) for r in known.collect())
    assert len(sets) > 2000 and len(found) > 20
    for cards, got in found.items():
        scored = sorted((-len(s & set(cards)) / len(s | set(cards)), i) for i, s in sets)[:5]
        assert sorted(got) == [(place, i, round(-score, 9)) for place, (score, i) in enumerate(scored, 1)]
