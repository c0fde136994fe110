"""Hand-made cases of the column functions and operators."""

import math

import pytest
from pyspark.sql import functions as F

from battlelake.functions import decks as deck_fn, scoring, values
from battlelake.operators import canonical, decks, enrich, frontier, matrix, performance, points, recommend
from battlelake.sources import dims, fixtures, logs


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("own, opponent, outcome, expected", [
    (5000, 6000, "win", 1.06), (6000, 5000, "win", 1.0), (5000, 6000, "draw", 0.54),
    (6000, 5000, "draw", 0.5), (6000, 5000, "loss", 0.966667), (5000, 6000, "loss", 1.0),
    (5000, 5000, "loss", 1.0), (0, 50, "win", 1.15), (10**6, 0, "loss", 0.8),
    (None, 5000, "win", 1.0), (5000, None, "draw", 0.5), (None, None, "loss", 1.0),
])
def test_trophy_boost(spark, own, opponent, outcome, expected):
    score = scoring.trophy_boost(
        F.lit(own).cast("int"), F.lit(opponent).cast("int"), F.lit(outcome)
    )
    assert one(spark, score) == pytest.approx(expected, abs=1e-6)


@pytest.mark.parametrize("a, b, expected", [(2, 1, "win"), (1, 2, "loss"), (1, 1, "draw"), (None, 1, "draw")])
def test_outcome(spark, a, b, expected):
    column = scoring.outcome(F.lit(a).cast("int"), F.lit(b).cast("int"))
    assert one(spark, column) == expected
    other = {"win": "loss", "loss": "win", "draw": "draw"}[expected]
    assert one(spark, scoring.outcome(F.lit(b).cast("int"), F.lit(a).cast("int"))) == other


def test_consistency_of_a_single_row(spark):
    assert one(spark, scoring.consistency(F.lit(None).cast("double"))) == 0.5


def test_sequences_of_short_and_missing_decks(spark):
    rows = spark.createDataFrame([([5, 6, 7],), ([5],), ([],), (None,)], "deck array<int>")
    found = sorted(tuple(r) for r in performance.prefix_rows(rows).collect())
    assert found == [("5", 6, 1), ("5,6", 7, 2)]


def test_jaccard(spark):
    ints = lambda *xs: F.array(*[F.lit(x) for x in xs]).cast("array<int>")
    assert one(spark, deck_fn.jaccard(ints(1, 2), ints(2, 3))) == pytest.approx(1 / 3)
    assert one(spark, deck_fn.jaccard(ints(), ints())) == 0.0


def test_subsets(spark):
    found = one(spark, deck_fn.subsets(F.array(*[F.lit(x) for x in (1, 2, 3)])))
    assert sorted(found) == [[1], [1, 2], [1, 2, 3], [1, 3], [2], [2, 3], [3]]


def test_multi_hot_and_its_text_agree(spark):
    rows = spark.createDataFrame([([3, 0, 7],), ([],), ([7, None, 7],)], "deck array<int>")
    wide = rows.select(deck_fn.multi_hot(F.col("deck"), 8).alias("flags"), deck_fn.bit_text(F.col("deck"), 8).alias("text"))
    got = [(r["flags"], r["text"]) for r in wide.collect()]
    assert [text for _, text in got] == ["10010001", "00000000", "00000001"]
    assert all(flags == [c == "1" for c in text] for flags, text in got)
    with pytest.raises(Exception, match="beyond width"):
        rows.select(deck_fn.multi_hot(F.col("deck"), 7)).collect()


def test_padded_key_and_toggle(spark):
    deck = F.array(F.lit(2), F.lit(15), F.lit(117))
    assert one(spark, deck_fn.padded_key(deck)) == "002015117"
    assert one(spark, deck_fn.padded_key(F.array(F.lit(2), F.lit(26000119)))) == "00226000119"
    assert one(spark, deck_fn.toggle(deck, F.lit(15))) == [2, 117]
    assert one(spark, deck_fn.toggle(deck, F.lit(1))) == [2, 15, 117, 1]


def test_times_and_narrowing(spark):
    text = F.lit("20240131T235959.500Z")
    assert str(one(spark, values.battle_ts(text))) == "2024-01-31 23:59:59.500000"
    assert str(one(spark, values.battle_date(text))) == "2024-01-31"
    assert one(spark, values.battle_ts(F.lit("tomorrow"))) is None
    assert one(spark, values.battle_date(F.lit("2024xx31"))) is None
    assert str(one(spark, values.utc_date(values.event_time(text)))) == "2024-01-31"
    assert one(spark, values.narrow(F.lit(40000), "smallint")) is None
    assert one(spark, values.narrow(F.lit(300), "smallint")) == 300
    assert one(spark, values.printable(F.lit(math.inf))) == "Infinity"
    assert one(spark, values.printable(F.lit(math.nan))) == "NaN"
    assert one(spark, values.printable(F.lit(1.5))) is None
    assert one(spark, values.floor_mean(F.lit(-3), F.lit(0))) == -2


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other, text in (("America/New_York", "20240310T023000.000Z"), ("Europe/London", "20241027T000000.000Z")):
            spark.conf.set("spark.sql.session.timeZone", other)
            time = F.lit(text)
            row = spark.range(1).select(
                values.battle_ts(time).cast("string"), values.battle_date(time).cast("string"),
                values.utc_date(values.event_time(time)).cast("string"),
            ).first()
            day = f"{text[:4]}-{text[4:6]}-{text[6:8]}"
            assert tuple(row) == (f"{day} {text[9:11]}:{text[11:13]}:{text[13:15]}", day, day)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


FLAT = (
    "battle_id long, battle_time string, game_mode int, p1_tag string, p1_trophies int, p1_crowns int,"
    " p1_deck array<int>, p2_tag string, p2_trophies int, p2_crowns int, p2_deck array<int>"
)
ONE_TO_EIGHT = list(range(1, 9))
OTHERS = list(range(11, 19))


def flat(spark, *rows):
    return spark.createDataFrame(
        [(i, r.get("time", "20240101T000000.000Z"), r.get("mode", 72000006), r.get("t1", "A"), r.get("tr1", 5001),
          r.get("c1", 3), r.get("d1", ONE_TO_EIGHT), r.get("t2", "B"), r.get("tr2", 5002), r.get("c2", 1),
          r.get("d2", OTHERS)) for i, r in enumerate(rows)], FLAT)


def test_mirrors_by_place_and_as_sets(spark):
    battle = flat(spark, {"d2": ONE_TO_EIGHT[::-1]}, {"d2": ONE_TO_EIGHT})
    assert [r["battle_id"] for r in decks.without_mirrors(battle).collect()] == [0]
    assert decks.without_mirrors(battle, any_order=True).count() == 0


def test_card_points(spark):
    battle = flat(spark, {"d1": [1, 2], "d2": [2, 3]})
    found = {r["card"]: (r["crowns"], r["trophies"]) for r in points.card_points(battle).collect()}
    assert found == {1: (3, 5001), 2: (2, 5001), 3: (-1, 5002)}


def test_draw_seen_from_both_sides(spark):
    both = fixtures.nest(flat(spark, {"c1": 1}, {"t1": "B", "tr1": 5002, "d1": OTHERS, "c1": 1, "t2": "A", "tr2": 5001, "d2": ONE_TO_EIGHT}))
    assert canonical.canonical_battles(both).count() == 1
    assert canonical.distinct_battles(canonical.winner_first(both)).count() == 2


def test_deck_pair_stats(spark):
    battles = flat(
        spark, {}, {"d1": OTHERS, "d2": ONE_TO_EIGHT[::-1], "c1": 2, "c2": 0}, {"c1": 1, "c2": 1}, {"c1": 0},
    )
    (row,) = decks.deck_pair_stats(battles).collect()
    assert (row["deck_a"], row["deck_b"], row["wins"], row["losses"]) == (ONE_TO_EIGHT, OTHERS, 1, 2)
    (merged,) = decks.merge_deck_stats(*[decks.deck_pair_stats(battles)] * 2).collect()
    assert (merged["wins"], merged["losses"]) == (2, 4)


def test_deck_file_is_in_order(spark, tmp_path):
    rows = [([i] * 8, [i + 1] * 8, 1, 0) for i in (5, 3, 9, 1)]
    stats = spark.createDataFrame(rows, "deck_a array<int>, deck_b array<int>, wins long, losses long")
    decks.write_deck_file(stats, str(tmp_path / "stats"))
    lines = [line for part in sorted((tmp_path / "stats").glob("part-*")) for line in part.read_text().split()]
    assert [line.split(",")[0] for line in lines] == ["1", "3", "5", "9"]
    with pytest.raises(Exception, match="exist"):
        decks.write_deck_file(stats, str(tmp_path / "stats"))


def test_unknown_key_is_an_error(spark):
    cards = fixtures.card_dim(spark)
    assert decks.resolve_keys(cards, ["card-7", "card-5"]) == [26000007, 26000005]
    with pytest.raises(KeyError, match="nobody"):
        decks.resolve_keys(cards, ["nobody"])


def test_names_by_map_and_by_join_agree(spark, monkeypatch):
    battles = fixtures.nest(flat(
        spark, {"d1": [26000000, 26000120]}, {"d1": [26000001, 26000001], "d2": []}, {"d1": [26000119], "mode": 1},
    ))
    cards, modes = fixtures.card_dim(spark), dims.game_mode_dim(spark)
    by_map = sorted(map(tuple, enrich.search_documents(battles, cards, modes).collect()))
    monkeypatch.setattr(dims, "MAX_LITERAL_ROWS", 10)
    joined = enrich.search_documents(battles, cards, modes)
    by_join = sorted(map(tuple, joined.collect()))
    assert by_map[0][6] == ["Card 0", "Unknown(26000120)"] and by_map[2][2] == "Unknown"
    assert by_join == by_map


def test_legacy_and_exact_accumulation(spark):
    def moments(*scores):
        mean = sum(scores) / len(scores)
        return spark.createDataFrame(
            [("1", 2, len(scores), float(sum(scores)), float(sum((s - mean) ** 2 for s in scores)), len(scores))],
            "deck_pattern string, next_card int, n long, s double, m2 double, len_sum long",
        )

    first, second = moments(1.0), moments(0.5, 0.4, 0.6)
    exact = matrix.scored(matrix.merge_moments(first, second)).first()
    assert exact["weighted_performance"] == pytest.approx(0.625)
    assert exact["performance_consistency"] == pytest.approx(0.262996, abs=1e-6)
    legacy = matrix.accumulate_legacy(matrix.scored(first), matrix.scored(second)).first()
    assert legacy["weighted_performance"] == pytest.approx(0.75)


def test_frontier_rules(spark):
    battles = flat(
        spark,
        {"t2": "X", "mode": 72000323, "tr2": 30},                                   # below the floor
        {"t2": "Y", "mode": 72000323, "tr2": 40, "time": "20240101T000000.000Z"},
        {"t2": "Y", "mode": 72000323, "tr2": 90, "time": "20240102T000000.000Z"},
        {"t2": "Y", "mode": 72000323, "tr2": 95, "time": "20240102T000000.000Z"},   # same time: first one counts
        {"t2": "Z", "mode": 72000010},                                              # neither ranked nor ladder
        {"t2": "W", "mode": 72999999},                                              # not one on one
        {"t2": "V", "mode": 72000006, "tr2": 10100},
        {"t2": "A", "mode": 72000006},                                              # already asked
    )
    asked = spark.createDataFrame([("A",)], "tag string")
    found = {r["tag"]: tuple(r)[1:] for r in frontier.frontier(battles, asked).collect()}
    assert found == {
        "Y": (9910, 0, "20240102T000000.000Z", ""), "V": (0, 100, "", "20240101T000000.000Z"),
    }
    order = [r["tag"] for r in frontier.next_players(frontier.frontier(battles, asked), 5).collect()]
    assert order == ["V", "Y"]


def test_undecodable_records_are_set_aside(spark):
    records = spark.createDataFrame(
        [("{",), ('{"battle_time":"t","player1":{"deck":[1]},"player2":{"deck":[2]}}',), (None,),
         ('{"battle_time":"t","player1":{"deck":[1]}}',)], "value string")
    good, bad = logs.split_usable(logs.decode(records))
    assert (good.count(), bad.count()) == (1, 3)


def test_raw_log_defaults(spark):
    raw = ('{"battleTime":"t","gameMode":{"id":1},"team":[{"tag":"#A","crowns":1,"cards":[{"id":5}]}],'
           '"opponent":[{"tag":"#B","startingTrophies":7,"trophyChange":-2,"crowns":0,"cards":[]}]}')
    row = logs.normalise_raw(spark.createDataFrame([(raw,)], "value string")).first()
    assert tuple(row["player1"]) == ("A", 0, 1, [5]) and tuple(row["player2"]) == ("B", 5, 0, [])


def test_request_rules(spark):
    asked = spark.createDataFrame(
        [(1, [1], None), (2, [], 3), (3, list(range(8)), 3), (4, [1], 11), (5, [1], 0), (6, None, 3), (7, list(range(7)), 10)],
        "request_id long, partial_deck array<int>, num_recommendations int")
    found = {r["request_id"]: (r["num_recommendations"], r["rejected"]) for r in recommend.checked_requests(asked).collect()}
    assert found == {1: (3, None), 2: (3, "deck size"), 3: (3, "deck size"), 4: (11, "number of cards"),
                     5: (0, "number of cards"), 6: (3, "deck size"), 7: (10, None)}


def test_card_file(spark, tmp_path):
    path = tmp_path / "cards.json"
    path.write_text('[\n{"key":"b","name":"B","id":2,"elixir":3},\n{"key":"a","name":"A","id":1,"is_evolved":true}\n]')
    rows = dims.read_cards(spark, str(path)).collect()
    assert [(r["card_index"], r["key"], r["id"], r["elixir"], r["is_evolved"]) for r in rows] == [
        (0, "b", 2, 3, None), (1, "a", 1, None, True)]


def test_csv_values_that_do_not_fit(spark, tmp_path):
    cards = ",".join(["26000000"] * 8)
    (tmp_path / "a.csv").write_text(f"20240101T000000.000Z,1,A,99999,3,{cards},B,5000,1,{cards}\n")
    row = logs.csv_to_flat(logs.read_battle_csv(spark, str(tmp_path))).first()
    assert row["p1_trophies"] is None and row["p2_trophies"] == 5000
    assert str(row["battle_date"]) == "2024-01-01" and row["p1_deck"] == [26000000] * 8
    assert logs.read_battle_csv(spark, str(tmp_path), max_rows=0).count() == 0


def test_battles_outside_all_seasons_keep_a_row(spark, sf_dir):
    battles = fixtures.battles(spark, sf_dir).where("battle_id <= 3")
    times = F.when(F.col("battle_id") == 1, "20231231T235959.000Z").when(F.col("battle_id") == 2, "no time")
    log = battles.withColumn("battle_time", F.coalesce(times, F.lit("20240110T000000.000Z")))
    seasons = fixtures.season_dim(spark)
    rows = canonical.season_battles(log, seasons)
    assert rows.count() == battles.count()
    outside = rows.where(F.col("season") == canonical.NO_SEASON)
    assert sorted(str(r[0]) for r in outside.select("battle_date").collect()) == ["2023-12-31", "None"]
    total = canonical.season_summary(rows).where("season IS NULL").first()
    assert total["games"] == battles.count()


def test_a_deck_too_long_for_the_file_is_an_error(spark):
    stats = spark.sql("SELECT sequence(1, {n}) AS deck_a, array(1) AS deck_b, 1L AS wins, 0L AS losses", n=9)
    with pytest.raises(Exception, match="no place in the file"):
        decks.flat_deck_columns(stats).collect()
    short = decks.flat_deck_columns(stats.withColumn("deck_a", F.slice("deck_a", 1, 8))).first()
    assert [short[f"a{i}"] for i in range(1, 9)] == list(range(1, 9)) and short["b2"] is None

