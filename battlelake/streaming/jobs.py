"""The streaming jobs. Each takes a stream of records and returns a started query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from battlelake.functions.values import battle_date
from battlelake.operators import canonical, enrich, points
from battlelake.operators.performance import flatten
from battlelake.sources import logs
from battlelake.streaming import sources
from battlelake.streaming.delta_log import DeltaLog
from battlelake.streaming.sinks import Commits, RowWriter, read_batches, write_batch
from battlelake.streaming.state import StateTables


#: A point of a battle and the batch that wrote it.
POINTS = (
    "battle_time string, player1_tag string, player2_tag string, game_mode int, player1_trophies int, player1_crowns int,"
    " player2_trophies int, player2_crowns int, batch_id bigint"
)


def _started(writer: DataStreamWriter, checkpoint: str, available_now: bool, interval: str) -> StreamingQuery:
    """Every job has a checkpoint, so a restart goes on where it stopped."""
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def _per_batch(
    stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str,
    available_now: bool, interval: str = "1 minute",
) -> StreamingQuery:
    return _started(
        stream.writeStream.outputMode("append").foreachBatch(work), checkpoint, available_now, interval
    )


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """What the checkpoint says of its query; a fresh checkpoint says something else."""
    return spark.read.text(f"{checkpoint}/metadata").first()[0]


def _observed(stream: DataFrame, name: str) -> DataFrame:
    """Row counts of each batch in the query's progress, without a job of their own.

    They are exact as long as a job reads its batch once, which is why none asks whether it is empty.
    """
    bad = F.count_if(F.col("reason").isNotNull())
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), bad.alias("quarantined"))


def _letters_only(rows: DataFrame) -> DataFrame:
    """Text and origin stay with the records that cannot be used: a stored batch need not hold the others' twice."""
    return rows.withColumns({c: F.when(F.col("reason").isNotNull(), F.col(c)) for c in ("value", "origin")})


def _usable(batch: DataFrame, batch_id: int, quarantine: str) -> DataFrame:
    """The battles that can be used; the other records are stored as they came, each with its reason."""
    good, letters = logs.split_parsed(batch)
    write_batch(letters, batch_id, quarantine)
    return good


def documents_job(
    records: DataFrame, cards: DataFrame, modes: DataFrame, out: str, checkpoint: str, available_now: bool = False,
) -> StreamingQuery:
    """Named search documents with their arrival time; records that cannot be used beside them."""

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            documents = enrich.search_documents(_usable(batch, batch_id, f"{out}-quarantine"), cards, modes)
            write_batch(documents.withColumn("timestamp", F.current_timestamp()), batch_id, out)
        finally:
            batch.unpersist()

    return _per_batch(_observed(sources.parsed_battles(records), "documents"), work, checkpoint, available_now)


FAN_OUT_TABLES = ("battles", "documents", "game_points", "card_points", "quarantine")


def fan_out_job(
    records: DataFrame, cards: DataFrame, modes: DataFrame, out: str, checkpoint: str, available_now: bool = False,
) -> StreamingQuery:
    """One reading of the topic to four tables: battles, search documents, game points and card points.

    Records that cannot be used go to a fifth table. All five take a batch with one commit: read them by ``Commits``.
    """
    commits = Commits(records.sparkSession, out)

    def work(batch: DataFrame, batch_id: int) -> None:
        writer = _query_id(batch.sparkSession, checkpoint)
        if commits.done(batch_id, writer):
            return
        batch.persist()
        try:
            good, letters = logs.split_parsed(batch)
            flat = flatten(good)
            documents = enrich.search_documents(good, cards, modes).withColumn("timestamp", F.current_timestamp())
            tables = (good, documents, points.game_points(flat), points.card_points(flat), letters)
            commits.write(batch_id, writer, dict(zip(FAN_OUT_TABLES, tables, strict=True)))
        finally:
            batch.unpersist()

    parsed = _observed(_letters_only(sources.parsed_battles(records)), "fan_out")
    return _per_batch(parsed, work, checkpoint, available_now)


def point_log(spark: SparkSession, out: str) -> DeltaLog:
    """Game points as they stand: of all that were written for a tag set, the one of the last batch."""

    def merge(rows: DataFrame, more_keys: list[str]) -> DataFrame:
        return points.latest_points(rows, more_keys, written=["batch_id"])

    return DeltaLog(spark, f"{out}/points", POINTS, points.GAME_TAGS, merge)


def points_job(records: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Game points that replace each other: a battle that comes again, in this batch or a later one, is one point."""
    log = point_log(records.sparkSession, out)

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = _usable(batch, batch_id, f"{out}/quarantine")
            fresh = points.game_points(flatten(good)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            log.commit(batch_id, fresh)
        finally:
            batch.unpersist()

    return _per_batch(_observed(sources.parsed_battles(records), "points"), work, checkpoint, available_now)


def training_job(
    records: DataFrame, state: StateTables, checkpoint: str, with_model: bool = True, available_now: bool = False,
) -> StreamingQuery:
    """Keep mapping, moments and (optionally) the model up to date, batch after batch."""

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = _usable(batch, batch_id, f"{state.path}/quarantine")
            state.apply(good, batch_id, with_model, writer=_query_id(batch.sparkSession, checkpoint))
        finally:
            batch.unpersist()

    return _per_batch(_observed(sources.parsed_battles(records), "training"), work, checkpoint, available_now)


#: The name of the operator whose state is the metrics table.
_AGGREGATE = "stateStoreSave"


def _each_once(rows: DataFrame) -> DataFrame:
    """Parsed records, the larger tag first, without those that came before at any time in the life of the query.

    The keyed state is the memory, on disk beside the executors (RocksDB), so a record costs one look-up however much
    has been stored and a copy is known however late it comes. There is no watermark: nothing is ever too late, and
    the state grows with the distinct battles. It compares whole battles, not hashes. A record that cannot be used is
    known by its text and origin.
    """
    bad = F.col("reason").isNotNull()
    # What cannot be used is told apart by its record alone, and what can by its battle alone.
    blank = {c: F.when(~bad, F.col(c)) for c in canonical.BATTLE_COLUMNS}
    letter = {c: F.when(bad, F.col(c)) for c in ("value", "origin")}
    keyed = canonical.by_tag(rows.withColumns(blank | letter))
    return keyed.dropDuplicates([*canonical.BATTLE_COLUMNS, *letter, "reason"])


def dedup_job(records: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Canonical battles, each once, in ``out``/battles by day; records that cannot be used in ``out``/quarantine.

    A battle without a readable time belongs to the day ``unknown``. In = battles + quarantined + copies.
    """
    day = F.coalesce(battle_date(F.col("battle_time")).cast("string"), F.lit("unknown"))

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = _usable(batch, batch_id, f"{out}/quarantine")
            write_batch(good.withColumn("battle_day", day), batch_id, f"{out}/battles", by="battle_day")
        finally:
            batch.unpersist()

    parsed = _observed(sources.parsed_battles(records), "dedup")
    return _per_batch(_each_once(parsed), work, checkpoint, available_now)


def card_metrics_job(records: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Usage and crown difference of each card per day, kept by the query's own state: each battle counts once.

    De-duplication and aggregation are two keyed states of one query in update mode. ``out`` gets what each batch
    changed; ``card_metrics`` reads the state as it stands. Days are those of the battles, however late they come.
    """
    parsed = _observed(sources.parsed_battles(records), "card_metrics")
    cards = points.card_points(flatten(_each_once(parsed).where("reason IS NULL")))
    daily = cards.withColumn("battle_date", battle_date(F.col("battle_time"))).groupBy("battle_date", "card").agg(
        F.count(F.lit(1)).alias("battles"), F.sum("crowns").alias("crowns"))
    writer = daily.writeStream.outputMode("update").foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, out))
    return _started(writer, checkpoint, available_now, "1 minute")


def card_metrics(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The table of ``card_metrics_job``, from the state after its last batch."""
    operator = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorName") == _AGGREGATE).first()["operatorId"]
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    count, crowns = state.schema["value"].dataType.fieldNames()[:2]
    return state.select("key.battle_date", "key.card", F.col(f"value.{count}").alias("battles"), F.col(f"value.{crowns}").alias("crowns"))


def card_usage_job(records: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Usage and crown difference of each card per day, as one part per batch; ``card_usage`` adds the parts.

    Late battles count for their day, battles without a readable time for the day null. Every record counts: a log
    with copies goes through ``dedup_job`` first.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            cards = points.card_points(flatten(_usable(batch, batch_id, f"{out}/quarantine")))
            daily = cards.groupBy(battle_date(F.col("battle_time")).alias("battle_date"), "card").agg(
                F.count(F.lit(1)).alias("battles"), F.sum("crowns").alias("crowns")
            )
            write_batch(daily, batch_id, f"{out}/usage")
        finally:
            batch.unpersist()

    return _per_batch(_observed(sources.parsed_battles(records), "card_usage"), work, checkpoint, available_now)


def card_usage(spark: SparkSession, out: str) -> DataFrame:
    """The table of ``card_usage_job`` as it stands: one row per day and card."""
    return read_batches(spark, f"{out}/usage").groupBy("battle_date", "card").agg(
        F.sum("battles").alias("battles"), F.sum("crowns").alias("crowns")
    )


def log_job(lines: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Service log lines into one partition per arrival day."""
    writer = lines.writeStream.outputMode("append").format("parquet").partitionBy("log_index").option("path", out)
    return _started(writer, checkpoint, available_now, "1 minute")


def row_job(
    records: DataFrame, connect: Callable, checkpoint: str, available_now: bool = False, quarantine: str | None = None,
) -> StreamingQuery:
    """Decoded battles one by one to an outside store, over one connection per partition and batch.

    Records that cannot be used go to ``quarantine``, by default beside the checkpoint.
    """
    letters = quarantine or f"{checkpoint}-quarantine"

    def work(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            _usable(batch, batch_id, letters).foreachPartition(RowWriter(connect).all_of(batch_id))
        finally:
            batch.unpersist()

    return _per_batch(_observed(sources.parsed_battles(records), "rows"), work, checkpoint, available_now)


def replay(spark: SparkSession, quarantine: str, mend: Callable, records: str, number: int) -> DataFrame:
    """Send dead letters through their job again once ``mend`` (text column to text column) makes them usable.

    The mended records become files of the folder that the job reads; one replay ``number`` is written once. Returns
    the letters that stay as they are.
    """
    usable_now, rest = logs.mended(spark.read.option("basePath", quarantine).parquet(quarantine), mend)
    usable_now.select("value").write.mode("ignore").text(f"{records}/replay={number}")
    return rest
