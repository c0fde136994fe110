"""What used to end at a size: wide card sets, large dimensions; and plans that were mended with them."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from battlelake.operators import als, decks, enrich, mapping as mapping_ops, matching
from battlelake.plans import queries as Q, training
from battlelake.sources import dims, fixtures


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def sets_of(spark, rows):
    return spark.createDataFrame([(sorted(r),) for r in rows], "cards array<string>")


def mapping_of(spark, patterns):
    return spark.createDataFrame(
        [(",".join(p), i + 1) for i, p in enumerate(patterns)], "deck_pattern string, deck_pattern_id int")


def test_wide_sets_match_as_by_brute_force(spark):
    import random

    rng = random.Random(3)
    cards = [str(26000000 + k) for k in range(40)]
    patterns = [rng.sample(cards, rng.choice([1, 3, 7, 12, 13, 20])) for _ in range(120)]
    asked = [rng.sample(cards, rng.choice([1, 2, 7, 12, 13, 25])) for _ in range(25)] + [["29000000"]]
    known = mapping_of(spark, patterns)
    kind = matching._known_sets(known, 1).schema["known"].dataType.simpleString()
    requests = sets_of(spark, asked).select(F.col("cards").cast(kind).alias("cards")).distinct()
    got = {}
    for r in matching.similar_patterns(requests, known).collect():
        got.setdefault(frozenset(map(str, r["cards"])), []).append((r["place"], r["deck_pattern_id"], round(r["score"], 9)))
    best = {frozenset(map(str, r["cards"])): (r["deck_pattern_id"], r["overlap"]) for r in matching.best_overlaps(requests, known).collect()}
    for request in map(frozenset, asked):
        scored = sorted((-round(len(request & set(p)) / len(request | set(p)), 9), i + 1) for i, p in enumerate(patterns))[:5]
        assert sorted(got[request]) == [(k + 1, i, -s) for k, (s, i) in enumerate(scored)]
        overlap, number = max((len(request & set(p)), -i) for i, p in enumerate(patterns))
        assert best.get(request) == ((-number + 1, overlap) if overlap else None)


def test_subsets_are_limited_before_they_are_shuffled(spark, sf_dir, no_broadcast):
    text = plan(matching.subset_index(training.start(fixtures.battles(spark, sf_dir)).mapping))
    below = text[text.index("Exchange hashpartitioning(shared"):]
    assert "WindowGroupLimit" in below and "Partial" in below.split("WindowGroupLimit", 1)[1].split("\n", 1)[0]


def test_dense_ids_need_one_exchange(spark, no_broadcast):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    numbered = mapping_ops.dense_ids(rows, "k", "n")
    assert "Exchange" not in plan(numbered) and "Window" not in plan(numbered)
    got = {r["k"]: r["n"] for r in numbered.collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(got))}


def test_bucketed_tables_join_without_an_exchange(spark, sf_dir, no_broadcast):
    totals = entry_points.queries()["player_totals"](spark, sf_dir)
    assert "Exchange" not in plan(totals) and "SortMergeJoin" in plan(totals)
    assert totals.count() > 0


@pytest.mark.parametrize("rows", [0, 5, 5000])
def test_dimensions_of_any_size_and_repeated_ids(spark, rows):
    cards = spark.range(rows).selectExpr("int(id) AS id", "concat('n', id) AS name", "int(id) AS card_index")
    repeated = cards.unionByName(cards.selectExpr("id", "concat('z', name) AS name", "card_index + 1000000 AS card_index"))
    battles = spark.createDataFrame([([1, 3, 7000],), ([],), (None,)], "deck array<int>")
    named = enrich.with_card_names(battles, {"deck": "names"}, repeated).collect()
    known = [f"n{i}" if i < rows else f"Unknown({i})" for i in (1, 3, 7000)]
    assert sorted((r["names"] for r in named), key=str) == sorted([known, [], None], key=str)
    places = decks.indexed(F.col("deck"), decks.card_index_map(repeated))
    got = battles.select(places.alias("p")).collect()
    assert sorted((r["p"] for r in got), key=str) == sorted([[1 if rows > 1 else None, 3 if rows > 3 else None, None], [], None], key=str)
    assert (dims.literal_map(repeated, "id", "name") is None) == (rows > dims.MAX_LITERAL_ROWS)


def test_residuals_tell_fitted_factors_from_others(spark, sf_dir):
    matrix = training.start(fixtures.battles(spark, sf_dir)).matrix().cache()
    model = als.fit(matrix)
    worst = als.residuals(model, matrix).agg(F.max("residual")).first()[0]
    assert worst < 1e-3
    moved = matrix.withColumn("effectiveness_score", F.col("effectiveness_score") + F.rand(1))
    assert als.residuals(model, moved).agg(F.max("residual")).first()[0] > 1e-2
    matrix.unpersist()


def test_winner_first_keeps_one_row_for_a_draw(spark, sf_dir):
    rows = Q.winner_first_canonical(spark, sf_dir).collect()
    assert len(rows) == entry_points.queries()["canonical_battles"](spark, sf_dir).count()
