"""The keyed and log-structured parts of the streams: deltas, commits, replacing points, dead letters, progress."""

import json

import pytest
from pyspark.sql import functions as F

from battlelake.operators.matrix import scored
from battlelake.operators.performance import flatten
from battlelake.operators import points
from battlelake.plans import training
from battlelake.session import get_text, names, put_text
from battlelake.sources import dims, fixtures, logs
from battlelake.streaming import jobs, progress, registry, sinks, sources
from battlelake.streaming.delta_log import DeltaLog
from battlelake.streaming.state import StateTables


@pytest.fixture(scope="module")
def battles(spark, sf_dir):
    return fixtures.battles(spark, sf_dir)


def add_records(rows, path, *texts):
    logs.to_records(rows).coalesce(1).write.mode("append").text(path)
    if texts:
        rows.sparkSession.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(path)


def finish(run):
    run.awaitTermination()
    assert run.exception() is None
    return run


def sums(rows, more_keys):
    return rows.groupBy(*more_keys, "k").agg(F.sum("v").alias("v"))


def test_rows_written_stay_flat_over_twenty_batches(spark, tmp_path):
    log = DeltaLog(spark, str(tmp_path / "log"), "k long, v long", ["k"], sums)
    written = []
    for version in range(20):
        rows = spark.range(400).select(F.col("id").alias("k"), F.lit(version + 1).cast("bigint").alias("v"))
        written.append(log.commit(version, rows))
        if version in (0, 7, 19):
            found = log.read().agg(F.count("k"), F.min("v"), F.max("v")).first()
            total = (version + 1) * (version + 2) // 2
            assert tuple(found) == (400, total, total)
    # A version writes its own 400 rows and folds a share of the buckets, once per level.
    assert max(written) <= 3 * 400 and sum(written[10:]) <= 1.3 * sum(written[:10]) + 400
    assert len(log.manifest(19)["parts"]) <= 8 * 3 * log.fanout
    assert log.versions() == [18, 19]
    needed = {p.folder for v in (18, 19) for p in log.manifest(v)["parts"]} | {"18-delta", "19-delta"}
    assert set(names(spark, f"{log.path}/data")) == needed


def test_a_version_written_again_changes_nothing(spark, tmp_path):
    log = DeltaLog(spark, str(tmp_path / "log"), "k long, v long", ["k"], sums, buckets=2, fanout=2)
    rows = lambda v: spark.range(10).select(F.col("id").alias("k"), F.lit(v).cast("bigint").alias("v"))
    for version in (0, 1, 2, 2, 5, 5):
        log.commit(version, rows(version + 1))
    assert log.read().agg(F.sum("v")).first()[0] == 10 * (1 + 2 + 3 + 6)
    assert log.read(2).agg(F.sum("v")).first()[0] == 10 * (1 + 2 + 3)
    log.commit(6, rows(0).where("k < 0"))
    assert log.read().count() == 10


def test_state_over_many_batches_equals_one(spark, battles, tmp_path):
    state = StateTables(spark, str(tmp_path / "state"), buckets=2, fanout=2)
    parts = [battles.where(F.col("battle_id") % 7 == k) for k in range(7)]
    for number, part in enumerate(parts):
        assert state.apply(part, number)
        assert state.apply(part, number) is False
    expected = {(r[0], r[1]): r for r in scored(training.batch_moments(battles)).collect()}
    saved = state.load()
    got = {(r[0], r[1]): r for r in scored(saved.moments).collect()}
    assert got.keys() == expected.keys()
    assert all(got[k]["total_appearances"] == r["total_appearances"] for k, r in expected.items())
    assert all(abs(got[k]["effectiveness_score"] - r["effectiveness_score"]) < 1e-9 for k, r in expected.items())
    row = registry.latest(state.rows(), "continuous_als_model").first()
    assert row["total_patterns"] == saved.mapping.count() == saved.mapping.agg(F.max("deck_pattern_id")).first()[0]
    assert row["total_training_samples"] == len(expected)
    assert state.rows().count() == 1 and state.versions() == [5, 6]
    # One registry for several models: a save replaces its own row only.
    other = registry.row("another", battles.agg(F.max("battle_time")), 3, 4)
    assert {r["model_name"] for r in registry.upsert(state.rows(), other).collect()} == {"another", "continuous_als_model"}


def test_saved_tables_that_are_not_what_was_written_are_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert registry.saved(spark.range(5), path) == 5
    assert registry.saved(spark.range(0), path) == 0
    from pyspark.sql.readwriter import DataFrameReader
    whole = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *paths, **kw: whole(self, *paths, **kw).limit(1))
    with pytest.raises(OSError):
        registry.saved(spark.range(5), path)


def test_small_texts_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "texts")
    assert get_text(spark, f"{path}/a") is None and names(spark, path) == []
    put_text(spark, f"{path}/a", "one é")
    put_text(spark, f"{path}/a", "two")
    assert get_text(spark, f"{path}/a") == "two" and names(spark, path) == ["a"]


def test_fan_out_shows_a_batch_in_all_tables_or_in_none(spark, battles, tmp_path, monkeypatch):
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    cards, modes = fixtures.card_dim(spark), dims.game_mode_dim(spark)
    first, second = battles.where("battle_id % 2 = 0"), battles.where("battle_id % 2 = 1")

    def run():
        return jobs.fan_out_job(sources.record_files(spark, path), cards, modes, out, ckpt, available_now=True)

    add_records(first, path, "{")
    finish(run())
    tables = sinks.Commits(spark, out)
    counts = lambda: [tables.read(t).count() for t in jobs.FAN_OUT_TABLES]
    before = counts()
    assert before[0] == before[1] == first.count() and before[4] == 1 and tables.differing(0) == []

    whole = sinks.write_batch

    def failing(df, batch_id, table, by=None):
        if table.endswith("card_points"):
            raise RuntimeError("lost between two sinks")
        whole(df, batch_id, table, by)

    add_records(second, path)
    monkeypatch.setattr(sinks, "write_batch", failing)
    with pytest.raises(Exception, match="lost between two sinks"):
        run().awaitTermination()
    assert counts() == before and tables.batches() == [0]
    monkeypatch.setattr(sinks, "write_batch", whole)
    finish(run())
    assert counts()[0] == battles.count() and tables.batches() == [0, 1]
    assert tables.commit_of(1)["tables"]["battles"]["rows"] == second.count()
    # Another query's batch of the same number is no replay.
    with pytest.raises(ValueError):
        tables.done(1, "another")
    spark.range(1).write.mode("overwrite").parquet(f"{out}/documents/batch_id=1")
    assert tables.differing(1) == ["documents"]


def test_points_of_a_later_batch_replace_earlier_ones(spark, battles, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    some = battles.limit(40)
    changed = fixtures.revised(some, 1, -3)
    for rows in (some, changed.limit(10), some.limit(0)):
        add_records(rows, path)
        finish(jobs.points_job(sources.record_files(spark, path), out, str(tmp_path / "ckpt"), available_now=True))
    stored = jobs.point_log(spark, out).read()
    assert stored.count() == 40 and stored.where("batch_id = 1").count() == 10
    assert stored.where("batch_id = 1").agg(F.max("player1_crowns")).first()[0] <= 0


def test_equal_tags_within_a_batch_keep_the_declared_one(spark, battles):
    one = flatten(battles.limit(1))
    other = one.withColumn("p1_trophies", F.col("p1_trophies") + 5)
    for rows in (one.unionByName(other), other.unionByName(one)):
        found = points.game_points(rows).collect()
        assert len(found) == 1 and found[0]["player1_trophies"] == other.first()["p1_trophies"]


def test_dedup_reads_no_earlier_batch(spark, battles, tmp_path):
    """Batches of one day: each reads its own records, and copies in any later batch are known."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    day = battles.where("battle_id < 24")
    rows_in = 0
    for k in range(6):
        part = day.where(F.col("battle_id") % 6 <= k)
        rows_in += part.count()
        add_records(part, path)
        run = finish(jobs.dedup_job(sources.record_files(spark, path), out, str(tmp_path / "ckpt"), available_now=True))
        assert sum(p["numInputRows"] for p in run.recentProgress) == part.count()
    stored = sinks.read_batches(spark, f"{out}/battles").count()
    assert stored == day.count() and rows_in > stored


def test_every_record_is_stored_a_copy_or_a_dead_letter(spark, battles, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    some = fixtures.battle_log(battles.limit(50))
    cut = json.dumps({"battle_time": "20240105T000000.000Z", "game_mode": 1})
    add_records(some, path, "no json", cut, '{"game_mode":5}', "")
    run = finish(jobs.dedup_job(sources.record_files(spark, path), out, str(tmp_path / "ckpt"), available_now=True))
    letters = sinks.read_batches(spark, f"{out}/quarantine")
    reasons = {r["value"]: r["reason"] for r in letters.collect()}
    assert reasons == {"no json": "no battle in JSON", cut: "no deck", '{"game_mode":5}': "no battle_time", "": reasons[""]}
    stored = sinks.read_batches(spark, f"{out}/battles").count()
    copies = some.count() - 50
    assert run.lastProgress is not None and some.count() + 4 == stored + letters.count() + copies


def test_row_job_keeps_dead_letters(spark, battles, tmp_path):
    path, folder = str(tmp_path / "in"), tmp_path / "rows"
    folder.mkdir()
    add_records(battles.limit(20), path, "{", "[]")
    target = str(folder)

    def connect(partition_id, epoch_id):
        class Lines:
            def __init__(self):
                self.file = open(f"{target}/{epoch_id}-{partition_id}", "w")

            def write(self, row):
                self.file.write(row["battle_time"] + "\n")

            def close(self):
                self.file.close()

        return Lines()

    finish(jobs.row_job(sources.record_files(spark, path), connect, str(tmp_path / "ckpt"), available_now=True))
    assert sum(len(f.read_text().splitlines()) for f in folder.iterdir()) == 20
    assert sinks.read_batches(spark, f"{tmp_path}/ckpt-quarantine").count() == 2


def test_replayed_letters_come_in_once(spark, battles, tmp_path):
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    whole = logs.to_records(battles.limit(1)).first()[0]
    add_records(battles.where("battle_id > 5").limit(3), path, whole[:-1], "never")
    finish(jobs.dedup_job(sources.record_files(spark, path), out, ckpt, available_now=True))
    mend = lambda text: F.when(text.endswith("}}"), text).when(text.endswith("}"), F.concat(text, F.lit("}"))).otherwise(text)
    for _ in range(2):
        rest = jobs.replay(spark, f"{out}/quarantine", mend, path, 1)
        assert [r["value"] for r in rest.collect()] == ["never"]
        finish(jobs.dedup_job(sources.record_files(spark, path), out, ckpt, available_now=True))
    assert sinks.read_batches(spark, f"{out}/battles").count() == 4


def test_metrics_count_each_battle_once_also_late_and_undated(spark, battles, tmp_path):
    path, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    some = battles.limit(30)
    odd = some.where("battle_id = 1").withColumn("battle_time", F.lit("20231115T120000.000Z")).unionByName(
        some.where("battle_id = 2").withColumn("battle_time", F.lit("not a time")))
    for rows in (some, odd, some, odd, some.limit(0)):
        add_records(rows, path)
        finish(jobs.card_metrics_job(sources.record_files(spark, path), out, ckpt, available_now=True))
    daily = jobs.card_metrics(spark, ckpt)
    assert daily.agg(F.sum("battles")).first()[0] == points.card_points(flatten(some.unionByName(odd))).count()
    assert daily.where("battle_date IS NULL").count() > 0 and daily.where("battle_date = '2023-11-15'").count() > 0


def test_progress_of_every_batch_is_stored(spark, battles, tmp_path):
    path, table = str(tmp_path / "in"), progress.ProgressTable(spark, str(tmp_path / "progress"))
    assert table.read().count() == 0
    spark.streams.addListener(table)
    try:
        for k in range(2):
            add_records(battles.limit(10 + k), path, *["{"] * k)
            run = finish(jobs.card_usage_job(sources.record_files(spark, path), str(tmp_path / "out"), str(tmp_path / "ckpt"), available_now=True))
            table.waited(run)
    finally:
        spark.streams.removeListener(table)
    assert sorted(tuple(r)[1:] for r in table.totals().where("rows > 0").collect()) == [(0, 10, 0), (1, 12, 1)]


def test_series_places_follow_time_also_for_a_hot_player(spark, battles):
    wide = points.game_points(flatten(battles)).withColumn("player1_tag", F.lit("PHOT"))
    rows = points.ordered_series(points.player_trophy_series(wide), 5).collect()
    by_tag = {}
    for r in rows:
        by_tag.setdefault(r["tag"], []).append((r["place"], r["battle_time"]))
    assert len(by_tag["PHOT"]) > len(rows) / 3
    for found in by_tag.values():
        found.sort()
        assert [p for p, _ in found] == list(range(1, len(found) + 1))
        assert [t for _, t in found] == sorted(t for _, t in found)
