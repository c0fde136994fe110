"""What a record costs on its way through the fan-out job, and that cheaper forms give the same."""

import re

from pyspark.sql import functions as F

from battlelake.operators import enrich
from battlelake.plans import stream_queries
from battlelake.sources import logs
from battlelake.streaming import jobs, sinks


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_battles_are_derived_after_they_are_spread(spark, sf_dir, monkeypatch):
    seen = []
    to_records = logs.to_records
    monkeypatch.setattr(logs, "to_records", lambda rows: seen.append(rows) or to_records(rows))
    stream_queries._staged(spark, sf_dir, both_logs=True)
    above, below = seen[0]._jdf.queryExecution().executedPlan().toString().split("Exchange rangepartitioning", 1)
    # The range sample and the exchange read four columns of the events, no decks and no text.
    assert "transform(" in above and "transform(" not in below and "props" not in below


def test_checksum_is_the_sum_of_the_hashes(spark):
    rows = spark.range(5000).select((F.col("id") % 4000).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("b"))
    for some in (rows, rows.where("a = 3"), rows.where("false")):
        exact = sum(r[0] for r in some.select(F.xxhash64("a", "b")).collect())
        assert tuple(some.agg(*sinks._checks(some)).first()) == (some.count(), exact)


def test_checksum_sums_longs(spark):
    rows = spark.range(10).selectExpr("id AS a")
    assert re.findall(r"sum\(cast\([^)]*\) as decimal", plan(rows.agg(*sinks._checks(rows)))) == []


def test_names_of_close_and_of_scattered_ids(spark):
    battles = spark.createDataFrame([([26000001, 26000003, 2147483647, -2147483648, 25999999, None],)], "deck array<int>")
    rest = ["Unknown(2147483647)", "Unknown(-2147483648)", "Unknown(25999999)", None]
    for more in ([], [(-2147483648, "least"), (2147483647, "greatest")]):
        cards = spark.createDataFrame([(26000000, "a"), (26000001, "b"), (26000004, "c"), (26000005, None), (None, "d"), *more], "id int, name string")
        named = enrich.with_card_names(battles, {"deck": "names"}, cards)
        assert named.first()["names"] == ["b", "Unknown(26000003)", *(["greatest", "least"] if more else rest[:2]), *rest[2:]]
        # Ids that lie close are found by place; a map would be searched entry by entry.
        assert ("element_at" in plan(named)) == bool(more)


def test_a_stored_batch_holds_the_text_of_dead_letters_only(spark):
    records = spark.createDataFrame([(stream_queries.CUT_RECORD + "}", "f"), (stream_queries.CUT_RECORD, "g")], "value string, origin string")
    kept = jobs._letters_only(logs.parsed(records))
    assert sorted((r.value, r.origin, r.reason) for r in kept.collect() if r.reason) == [(stream_queries.CUT_RECORD, "g", "no battle in JSON")]
    assert [(r.value, r.origin, r.player1.tag) for r in kept.collect() if not r.reason] == [(None, None, "PX")]
