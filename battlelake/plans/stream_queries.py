"""Registered streaming queries: the given tables as record files, one run over all that is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from battlelake.operators import als, points
from battlelake.operators.matrix import scored
from battlelake.plans import queries as batch
from battlelake.plans.queries import query
from battlelake.session import cut_lineage, shuffle_width, work_path
from battlelake.sources import dims, fixtures, logs
from battlelake.streaming import jobs, progress, sinks, sources
from battlelake.streaming.state import StateTables

# The staged files are read in this many micro-batches.
MICRO_BATCHES = 3
# Records no job can use: broken text, and a battle without decks.
BROKEN_RECORDS = ['{"battle_time": ', '{"battle_time":"20240131T000000.000Z","game_mode":72000006}']

# A battle that lost its last sign on the way.
CUT_RECORD = (
    '{"battle_time":"20240115T120000.000Z","game_mode":72000006,"player1":{"tag":"PX","trophies":1,"crowns":1,"deck":[26000000]},'
    '"player2":{"tag":"PY","trophies":1,"crowns":0,"deck":[26000001]}'
)


def _staged(spark: SparkSession, sf_dir: str, both_logs: bool = False) -> DataFrame:
    """The battles (or the log of both players) and the broken records as a stream of record files, in time order."""
    path, files = work_path(spark, "records"), shuffle_width(spark)
    # Events are spread, which a sample reads first; battles and JSON text are built after that by all tasks, and once.
    spread = fixtures.read_events(spark, sf_dir).repartitionByRange(files, "ts", "event_id")
    battles = fixtures.nest(fixtures.battles_flat_from(spread))
    broken = spark.createDataFrame([(text,) for text in BROKEN_RECORDS], "value string").coalesce(1)
    logs.to_records(fixtures.battle_log(battles) if both_logs else battles).unionByName(broken).write.text(path)
    return sources.record_files(spark, path, files_per_batch=-(-(files + 1) // MICRO_BATCHES))


def _finish(run: StreamingQuery) -> None:
    run.awaitTermination()
    if run.exception() is not None:
        raise run.exception()


@query
def stream_documents(spark, sf_dir):
    out, checkpoint = work_path(spark, "documents"), work_path(spark, "checkpoint")
    stream = _staged(spark, sf_dir)
    _finish(jobs.documents_job(
        stream, fixtures.card_dim(spark), dims.game_mode_dim(spark), out, checkpoint, available_now=True
    ))
    return sinks.read_batches(spark, out).drop("timestamp").withColumns({
        c: F.array_join(c, "|") for c in ("player1_deck_names", "player2_deck_names")
    })


def _fanned_out(spark, sf_dir):
    out, checkpoint = work_path(spark, "fan-out"), work_path(spark, "checkpoint")
    stream = _staged(spark, sf_dir, both_logs=True)
    _finish(jobs.fan_out_job(
        stream, fixtures.card_dim(spark), dims.game_mode_dim(spark), out, checkpoint, available_now=True
    ))
    return sinks.Commits(spark, out)


def _in_one(frames):
    every = frames[0]
    for more in frames[1:]:
        every = every.unionByName(more)
    return every


@query
def stream_fan_out(spark, sf_dir):
    """Rows per table of the fan-out job."""
    tables = _fanned_out(spark, sf_dir)
    return _in_one([
        tables.read(table).agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("table_name"), "n")
        for table in ("battles", "documents", "card_points", "quarantine")
    ])


@query
def stream_fan_out_contents(spark, sf_dir):
    """All rows of the fan-out job's five tables, as text."""
    tables = _fanned_out(spark, sf_dir)
    cards = lambda c: F.array_join(c, ",")
    content = {
        "battles": ["battle_time", "game_mode", *(f"player{i}.{c}" for i in (1, 2) for c in ("tag", "trophies", "crowns")),
                    cards("player1.deck"), cards("player2.deck")],
        "documents": ["battle_time", "game_mode_name", *(f"player{i}_{c}" for i in (1, 2) for c in ("tag", "trophies", "crowns")),
                      cards("player1_deck_names"), cards("player2_deck_names")],
        "game_points": [*points.GAME_TAGS, *points.POINT_ORDER],
        "card_points": ["battle_time", "game_mode", "card", "crowns", "trophies"],
        "quarantine": ["value", "reason"],
    }
    return _in_one([
        # Points are one for each tag set of a batch, so copies in several batches give equal rows.
        (rows.select(*columns).distinct() if table == "game_points" else rows).select(
            F.lit(table).alias("table_name"), F.concat_ws("|", *columns).alias("content"))
        for table, columns in content.items() for rows in [tables.read(table)]
    ])


@query
def stream_points_latest(spark, sf_dir):
    """Points of all battles, some of them again in later batches with other crowns: the last one written stays."""
    out, checkpoint = work_path(spark, "points"), work_path(spark, "checkpoint")
    path, battles = work_path(spark, "records"), batch._battles(spark, sf_dir)
    for rows in (battles, fixtures.revised(battles, 30, 2), fixtures.revised(battles, 60, -1)):
        logs.to_records(rows).write.mode("append").text(path)
        _finish(jobs.points_job(sources.record_files(spark, path), out, checkpoint, available_now=True))
    return jobs.point_log(spark, out).read().drop("batch_id")


@query
def stream_dead_letters(spark, sf_dir):
    """Records that cannot be used, with reasons; then one of them mended and sent through again."""
    out, checkpoint, path = (work_path(spark, name) for name in ("deduplicated", "checkpoint", "records"))
    logs.to_records(batch._battles(spark, sf_dir)).write.text(path)
    spark.createDataFrame([(text,) for text in BROKEN_RECORDS + [CUT_RECORD]], "value string").coalesce(1).write.mode("append").text(path)
    run = lambda: _finish(jobs.dedup_job(sources.record_files(spark, path), out, checkpoint, available_now=True))
    run()
    rest = cut_lineage(jobs.replay(spark, f"{out}/quarantine", lambda text: F.when(text == CUT_RECORD, F.concat(text, F.lit("}"))).otherwise(text), path, 1))
    run()
    stored = sinks.read_batches(spark, f"{out}/battles")
    return rest.select("value", "reason").unionByName(
        stored.agg(F.count(F.lit(1)).cast("string").alias("value")).withColumn("reason", F.lit("stored")))


@query
def stream_progress(spark, sf_dir):
    """Rows taken in and records that could not be used, by batch, from the progress table."""
    table = progress.ProgressTable(spark, work_path(spark, "progress"))
    out, checkpoint, path = (work_path(spark, name) for name in ("usage", "checkpoint", "records"))
    spark.streams.addListener(table)
    try:
        for part, rows in enumerate(batch._batches(batch._battles(spark, sf_dir))):
            broken = spark.createDataFrame([(text,) for text in BROKEN_RECORDS[:part]], "value string")
            logs.to_records(rows).unionByName(broken).write.mode("append").text(path)
            run = jobs.card_usage_job(sources.record_files(spark, path), out, checkpoint, available_now=True)
            _finish(run)
            table.waited(run)
    finally:
        spark.streams.removeListener(table)
    return table.totals().select("batch_id", "rows", "quarantined").where("rows > 0")


@query
def stream_matrix(spark, sf_dir):
    state, checkpoint = StateTables(spark, work_path(spark, "state")), work_path(spark, "checkpoint")
    stream = _staged(spark, sf_dir)
    _finish(jobs.training_job(stream, state, checkpoint, with_model=False, available_now=True))
    return batch._rounded_matrix(scored(state.load().moments))


@query
def state_restarted(spark, sf_dir):
    """The matrix after an empty first batch, three batches each by a new process, an empty and a repeated one."""
    path, battles = work_path(spark, "state"), batch._battles(spark, sf_dir)
    first, second, third = batch._batches(battles)
    nothing = battles.where(F.lit(False))
    for number, rows in ((0, nothing), (1, first), (2, second), (3, nothing), (2, second), (4, third)):
        StateTables(spark, path).apply(rows, number)
    return batch._rounded_matrix(scored(StateTables(spark, path).load().moments))


@query
def state_model_reloaded(spark, sf_dir):
    """Whether the factors of the model that the state saved, read back, solve every pattern's normal equations."""
    path = work_path(spark, "state")
    StateTables(spark, path).apply(batch._battles(spark, sf_dir), 0, with_model=True)
    saved = StateTables(spark, path)
    model, matrix = als.load(saved.rows().first()["model_path"]), cut_lineage(saved.load().matrix())
    return als.residuals(model, matrix).select("deck_pattern_id", "ratings", (F.col("residual") < 1e-3).alias("solved"))


@query
def stream_dedup(spark, sf_dir):
    out, checkpoint = work_path(spark, "deduplicated"), work_path(spark, "checkpoint")
    stream = _staged(spark, sf_dir, both_logs=True)
    _finish(jobs.dedup_job(stream, out, checkpoint, available_now=True))
    return batch._flat_text(sinks.read_batches(spark, f"{out}/battles").drop("battle_day"))


@query
def stream_card_usage_window(spark, sf_dir):
    out, checkpoint = work_path(spark, "usage"), work_path(spark, "checkpoint")
    stream = _staged(spark, sf_dir)
    _finish(jobs.card_usage_job(stream, out, checkpoint, available_now=True))
    return jobs.card_usage(spark, out)


@query
def stream_card_metrics(spark, sf_dir):
    """Card usage per day from a log with copies: each battle counts once, the larger tag first."""
    out, checkpoint = work_path(spark, "usage"), work_path(spark, "checkpoint")
    stream = _staged(spark, sf_dir, both_logs=True)
    _finish(jobs.card_metrics_job(stream, out, checkpoint, available_now=True))
    return jobs.card_metrics(spark, checkpoint)


@query
def log_daily_index(spark, sf_dir):
    """Event texts as service log lines, indexed by the day they arrive."""
    lines_path, out = work_path(spark, "log-lines"), work_path(spark, "log-index")
    checkpoint = work_path(spark, "checkpoint")
    fixtures.read_events(spark, sf_dir).select(
        F.concat_ws(" ", F.col("event_id").cast("string"), "event_type", "props").alias("value")
    ).write.text(lines_path)
    _finish(jobs.log_job(sources.service_logs(spark, lines_path), out, checkpoint, available_now=True))
    stored = spark.read.parquet(out)
    expected = F.concat(F.lit("spark-logs-"), F.date_format("ingest_ts", "yyyy.MM.dd"))
    return stored.select("value", (F.col("log_index") == expected).alias("in_index_of_day"))

