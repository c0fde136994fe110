"""Streams over record files: restarts, replays, quarantine and equality with the batch jobs."""

import json

import pytest
from pyspark.sql import functions as F

from battlelake.operators import als
from battlelake.operators.matrix import scored
from battlelake.operators.performance import flatten
from battlelake.plans import training
from battlelake.sources import dims, fixtures, logs
from battlelake.streaming import jobs, registry, sinks, sources
from battlelake.streaming.state import StateTables


@pytest.fixture(scope="module")
def battles(spark, sf_dir):
    return fixtures.battles(spark, sf_dir)


def stage(battles, path, part):
    logs.to_records(battles).coalesce(2).write.mode("append").text(path)
    with open(f"{path}/broken-{part}.txt", "w") as out:
        out.write('{"battle_time"\n')


def finish(run):
    run.awaitTermination()
    assert run.exception() is None
    return run


def halves(battles):
    return battles.where(F.col("battle_time") < "20240116"), battles.where(F.col("battle_time") >= "20240116")


def test_training_restarts_where_it_stopped(spark, battles, tmp_path):
    path, state = str(tmp_path / "in"), StateTables(spark, str(tmp_path / "state"))
    first, second = halves(battles)
    assert state.load() is None
    for part, rows in enumerate((first, second)):
        stage(rows, path, part)
        stream = sources.record_files(spark, path)
        run = finish(jobs.training_job(stream, state, str(tmp_path / "ckpt"), with_model=part == 1, available_now=True))
        if part == 0:
            progress = run.lastProgress["observedMetrics"]["training"]
            assert progress["rows"] == first.count() + 1 and progress["quarantined"] == 1
    assert state.latest_version() == 1
    saved = state.load()
    expected = {(r[0], r[1]): r for r in scored(training.batch_moments(battles)).collect()}
    got = {(r[0], r[1]): r for r in scored(saved.moments).collect()}
    assert got.keys() == expected.keys()
    assert all(got[k]["total_appearances"] == r["total_appearances"] for k, r in expected.items())
    assert sorted(r[0] for r in saved.mapping.select("deck_pattern_id").collect()) == list(
        range(1, saved.mapping.count() + 1))
    # A batch that is run again changes nothing.
    assert state.apply(second, 1) is False
    latest = registry.latest(state.rows(), "continuous_als_model").first()
    assert latest["total_patterns"] == saved.mapping.count()
    model = als.load(latest["model_path"])
    answer = als.recommend_patterns(model, saved.mapping.limit(5), saved.mapping, 4)
    assert answer.count() == 20
    # The model fits what it was trained on.
    error = model.transform(saved.matrix()).agg(F.avg(F.abs(F.col("prediction") - F.col("effectiveness_score")))).first()[0]
    assert error < 0.2


def test_fan_out_has_no_duplicates_after_restart_and_replay(spark, battles, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    cards, modes = fixtures.card_dim(spark), dims.game_mode_dim(spark)
    for part, rows in enumerate(halves(battles)):
        stage(rows, path, part)
        stream = sources.record_files(spark, path)
        finish(jobs.fan_out_job(stream, cards, modes, out, str(tmp_path / "ckpt"), available_now=True))
    stored = sinks.read_batches(spark, f"{out}/battles")
    assert stored.count() == battles.count() == sinks.read_batches(spark, f"{out}/documents").count()
    assert sinks.read_batches(spark, f"{out}/quarantine").count() == 2
    one = halves(battles)[1].drop("battle_id")
    sinks.write_batch(one, 1, f"{out}/battles")
    assert sinks.read_batches(spark, f"{out}/battles").count() == battles.count()


def test_dedup_across_batches(spark, battles, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(2):
        stage(battles, path, part)
        stream = sources.record_files(spark, path)
        finish(jobs.dedup_job(stream, out, str(tmp_path / "ckpt"), available_now=True))
    assert sinks.read_batches(spark, f"{out}/battles").count() == battles.count()
    assert sinks.read_batches(spark, f"{out}/quarantine").count() == 2


def odd_times(battles):
    """Two battles: one sixty days before the others, one with a time that says nothing."""
    late, unread = (battles.where(F.col("battle_id") == i) for i in (1, 2))
    return late.withColumn("battle_time", F.lit("20231115T120000.000Z")).unionByName(
        unread.withColumn("battle_time", F.lit("not a time")))


def test_late_and_undated_battles_stay_and_their_copies_go(spark, battles, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part, rows in enumerate((battles, odd_times(battles), odd_times(battles))):
        stage(rows, path, part)
        finish(jobs.dedup_job(sources.record_files(spark, path), out, str(tmp_path / "ckpt"), available_now=True))
    days = {r[0]: r[1] for r in sinks.read_batches(spark, f"{out}/battles").groupBy("battle_day").count().collect()}
    assert sum(days.values()) == battles.count() + 2
    assert days["2023-11-15"] == days["unknown"] == 1


def test_late_and_undated_battles_count_for_card_usage(spark, battles, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part, rows in enumerate((battles, odd_times(battles))):
        stage(rows, path, part)
        finish(jobs.card_usage_job(sources.record_files(spark, path), out, str(tmp_path / "ckpt"), available_now=True))
    from battlelake.operators.points import card_points
    daily = jobs.card_usage(spark, out)
    every = card_points(flatten(battles.unionByName(odd_times(battles))))
    assert daily.agg(F.sum("battles")).first()[0] == every.count()
    assert daily.where("battle_date = '2023-11-15'").count() > 0
    assert daily.where("battle_date IS NULL").count() > 0


def test_state_refuses_a_fresh_checkpoint(spark, battles, tmp_path):
    path, state = str(tmp_path / "in"), StateTables(spark, str(tmp_path / "state"))
    stage(battles.limit(20), path, 0)
    for ckpt, fails in (("a", False), ("a", False), ("b", True)):
        run = jobs.training_job(sources.record_files(spark, path), state, str(tmp_path / ckpt), with_model=False, available_now=True)
        if fails:
            with pytest.raises(Exception, match="belongs to the query"):
                run.awaitTermination()
        else:
            finish(run)
    assert state.latest_version() == 0


def test_card_usage_is_updated_by_later_batches(spark, battles, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(2):
        stage(battles, path, part)
        stream = sources.record_files(spark, path)
        finish(jobs.card_usage_job(stream, out, str(tmp_path / "ckpt"), available_now=True))
    total = jobs.card_usage(spark, out).agg(F.sum("battles")).first()[0]
    from battlelake.operators.points import card_points
    assert total == 2 * card_points(flatten(battles)).count()


def connector(folder):
    """Connections that write JSON lines; defined inside a function so that tasks need no test module."""

    class FileConnection:
        def __init__(self, partition_id, epoch_id):
            self.file = open(f"{folder}/{epoch_id}-{partition_id}.json", "w")

        def write(self, row):
            import json

            self.file.write(json.dumps(row) + "\n")

        def close(self):
            self.file.close()

    return FileConnection


def test_row_sink_opens_one_connection_per_partition(spark, battles, tmp_path):
    path, folder = str(tmp_path / "in"), tmp_path / "rows"
    folder.mkdir()
    stage(battles.limit(50), path, 0)
    target = str(folder)
    finish(jobs.row_job(
        sources.record_files(spark, path), connector(target),
        str(tmp_path / "ckpt"), available_now=True,
    ))
    lines = [json.loads(line) for file in folder.iterdir() for line in file.read_text().splitlines()]
    assert len(lines) == 50 and len(lines[0]["player1"]["deck"]) == 8


def test_steps_are_removed_with_their_scope(spark, tmp_path):
    from battlelake.session import cut_lineage, hadoop_path, step_scope

    with step_scope(spark):
        stored = cut_lineage(spark.range(3))
        assert stored.count() == 3
        path = stored.inputFiles()[0].rsplit("/", 1)[0]
    target, files = hadoop_path(spark, path)
    assert not files.exists(target)
    kept = cut_lineage(spark.range(4))
    assert kept.count() == 4


def test_audit_log_is_appended(spark, tmp_path):
    requests = spark.createDataFrame([(1, [5]), (2, [6])], "request_id long, partial_deck array<int>")
    answers = spark.createDataFrame(
        [(1, 2, 8, 0.5), (1, 1, 7, 0.9)], "request_id long, place int, card_id int, score double")
    log = registry.audit_log(requests, answers)
    for _ in range(2):
        registry.write_audit_log(log, str(tmp_path / "log"))
    rows = spark.read.parquet(str(tmp_path / "log")).collect()
    assert len(rows) == 2 and [r["card_id"] for r in rows[0]["recommendations"]] == [7, 8]


def test_saved_tables_are_verified(spark, tmp_path):
    rows = spark.range(5)
    path = str(tmp_path / "t")
    rows.write.parquet(path)
    assert registry.verify_saved(rows, path) == (5, ["id"])
    with pytest.raises(IOError):
        registry.verify_saved(spark.range(6), path)


def test_kafka_sources_name_topic_and_offsets(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.topic(spark, "broker:9092", "battles")
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.all_topics(spark, "broker:9092", ["internal"])
