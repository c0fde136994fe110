"""Files that are appended to, overwritten by force only, and kept in order."""

import pytest
from pyspark.errors import AnalysisException

from battlelake import schemas
from battlelake.operators import decks
from battlelake.sources import logs


def battle(time, trophies=5000, crowns=1, card=26000000):
    side = lambda tag: [tag, trophies, crowns, *range(card, card + 7), None]
    return [time, 72000006, *side("A"), *side("B")]


WIDE = schemas.BATTLE_CSV.replace("smallint", "int").replace("tinyint", "int")


def test_a_batch_sent_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "csv")
    first = [battle("20240101T000000.000Z"), battle("20240102T000000.000Z")]
    # The second has trophies that do not fit their column: null in the file, and known as such.
    second = [battle("20240103T000000.000Z", trophies=70000), battle("20240102T000000.000Z"), battle("20240103T000000.000Z", trophies=70000)]
    logs.write_sorted_csv(spark.createDataFrame(first, WIDE), path)
    for _ in range(2):
        logs.append_sorted_csv(spark.createDataFrame(second, WIDE), path)
    rows = logs.read_battle_csv(spark, path).orderBy("battle_time").collect()
    assert [(r.battle_time[6:8], r.trophies1, r.card18) for r in rows] == [("01", 5000, None), ("02", 5000, None), ("03", None, None)]


def test_empty_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "csv")
    logs.write_sorted_csv(spark.createDataFrame([battle("20240101T000000.000Z")], WIDE), path)
    logs.append_sorted_csv(spark.createDataFrame([], WIDE), path)
    assert logs.read_battle_csv(spark, path).count() == 1


def test_rows_without_a_time_are_added_once(spark, tmp_path):
    path = str(tmp_path / "csv")
    logs.write_sorted_csv(spark.createDataFrame([battle(None), battle("20240102T000000.000Z")], WIDE), path)
    batches = [[battle(None), battle(None, crowns=2)], [battle(None, crowns=2), battle("20240102T000000.000Z"), battle("20240102T000000.000Z", crowns=2)]]
    for batch in batches:
        logs.append_sorted_csv(spark.createDataFrame(batch, WIDE), path)
    rows = logs.read_battle_csv(spark, path).collect()
    assert sorted((r.battle_time or "", r.crowns1) for r in rows) == [("", 1), ("", 2), ("20240102T000000.000Z", 1), ("20240102T000000.000Z", 2)]


def test_a_batch_is_compared_with_the_rows_of_its_times_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "csv")
    logs.write_sorted_csv(spark.createDataFrame([battle("20240101T000000.000Z"), battle("20240103T000000.000Z")], WIDE), path)
    written = []
    monkeypatch.setattr(logs, "write_sorted_csv", lambda rows, *_, **__: written.append(rows))
    logs.append_sorted_csv(spark.createDataFrame([battle("20240102T000000.000Z"), battle("20240103T000000.000Z")], WIDE), path)
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    # One grouping in one exchange, no join on every column; what is outside the batch's times stays in the scan.
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert "GreaterThanOrEqual(battle_time,20240102T000000.000Z)" in plan
    assert [r.battle_time for r in written[0].collect()] == ["20240102T000000.000Z"]


def test_a_table_is_overwritten_by_force_only(spark, tmp_path):
    source, table = str(tmp_path / "csv"), str(tmp_path / "table")
    logs.write_sorted_csv(spark.createDataFrame([battle("20240101T000000.000Z")], WIDE), source)
    assert logs.csv_to_parquet(spark, source, table).count() == 1
    logs.append_sorted_csv(spark.createDataFrame([battle("20240102T000000.000Z")], WIDE), source)
    with pytest.raises(AnalysisException):
        logs.csv_to_parquet(spark, source, table)
    assert spark.read.parquet(table).count() == 1
    assert logs.csv_to_parquet(spark, source, table, force=True).count() == 2


def test_pair_file_keeps_its_order(spark, tmp_path):
    path = tmp_path / "pairs"
    deck = lambda first: list(range(first, first + 8))
    stats = spark.createDataFrame([(deck(k % 7), deck(20 + k), k, 1) for k in range(40)],
                                  "deck_a array<int>, deck_b array<int>, wins bigint, losses bigint").repartition(5)
    decks.write_deck_file(stats, str(path))
    rows = decks.read_deck_file(spark, str(path)).collect()
    lines = [tuple(map(int, x.split(","))) for f in sorted(path.glob("part-*.csv")) for x in f.read_text().split()]
    assert sorted(map(tuple, rows)) == lines == sorted(lines) and len(lines) == 40
