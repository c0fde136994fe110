"""Readers and normalisers for battle logs, topics and service logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from battlelake import schemas
from battlelake.functions.decks import file_cards
from battlelake.functions.values import battle_date, narrow
from battlelake.session import cut_lineage


def decode(records: DataFrame, schema: StructType | str = schemas.BATTLE, value: str = "value") -> DataFrame:
    """JSON in a text or binary column to its fields; undecodable text gives nulls, never an error."""
    return records.select(F.from_json(F.col(value).cast("string"), schema).alias("record")).select("record.*")


CORRUPT = "_corrupt_record"


def parsed(records: DataFrame, value: str = "value") -> DataFrame:
    """Battles with their record beside them: its text, where it came from, and why it cannot be used.

    ``reason`` is null for usable battles. ``origin`` is the column of that name if the records have one.
    """
    text = F.col(value).cast("string")
    with_corrupt = StructType([*schemas.BATTLE.fields, StructField(CORRUPT, StringType())])
    origin = F.col("origin") if "origin" in records.columns else F.lit(None).cast("string")
    rows = records.select(
        F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT}).alias("record"), text.alias("value"), origin.alias("origin"))
    fields = rows.select("record.*", "value", "origin")
    reason = (
        F.when(F.coalesce(usable(fields), F.lit(False)), F.lit(None).cast("string"))
        .when(F.col("value").isNull(), "no record").when(F.col(CORRUPT).isNotNull(), "no battle in JSON")
        .when(F.col("battle_time").isNull(), "no battle_time").otherwise("no deck")
    )
    return fields.withColumn("reason", reason).drop(CORRUPT)


BATTLE_FIELDS = schemas.BATTLE.fieldNames()
LETTER_FIELDS = ["value", "origin", "reason"]


def split_parsed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable battles, and dead letters: the other records as they came, with the reason of each."""
    good = F.col("reason").isNull()
    return rows.where(good).select(*BATTLE_FIELDS), rows.where(~good).select(*LETTER_FIELDS)


def mended(letters: DataFrame, mend: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """Dead letters after ``mend`` of their text: the records that are usable now, and the letters that stay."""
    again = parsed(letters.select(mend(F.col("value")).alias("value"), "origin"))
    usable_now, rest = again.where(F.col("reason").isNull()), again.where(F.col("reason").isNotNull())
    return usable_now.select("value", "origin"), rest.select(*LETTER_FIELDS)


def decode_beside(records: DataFrame, schema: StructType | str) -> DataFrame:
    """Key and value as text, and the decoded value beside them."""
    return records.selectExpr("CAST(key AS STRING)", "CAST(value AS STRING)").withColumn(
        "json_data", F.from_json("value", schema)
    )


def tolerant(records: DataFrame) -> DataFrame:
    """Any JSON document as a variant; null and flagged where the bytes hold no JSON."""
    parsed = F.try_parse_json(F.col("value").cast("string"))
    return records.withColumn("document", parsed).withColumn("undecodable", F.col("document").isNull())


def except_topics(records: DataFrame, excluded: list[str]) -> DataFrame:
    return records.where(~F.col("topic").isin(excluded))


def usable(battles: DataFrame) -> Column:
    """True for records that every later step can work on."""
    return (
        F.col("battle_time").isNotNull()
        & F.col("player1.deck").isNotNull()
        & F.col("player2.deck").isNotNull()
    )


def split_usable(battles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable records, and the quarantined rest."""
    good = F.coalesce(usable(battles), F.lit(False))
    return battles.where(good), battles.where(~good)


def normalise_raw(records: DataFrame, value: str = "value") -> DataFrame:
    """Raw API records to nested battles: first member of each side, no ``#``, trophies added up."""
    kept = [c for c in records.columns if c != value]

    def player(side: str) -> Column:
        member = F.get(F.col(f"raw.{side}"), F.lit(0))
        trophies = F.coalesce(member["startingTrophies"], F.lit(0)) + F.coalesce(member["trophyChange"], F.lit(0))
        return F.struct(
            F.substring(member["tag"], 2, 2**31 - 1).alias("tag"),
            trophies.alias("trophies"),
            member["crowns"].alias("crowns"),
            F.transform(member["cards"], lambda card: card["id"]).alias("deck"),
        )

    return records.select(*kept, F.from_json(value, schemas.RAW_BATTLE).alias("raw")).select(
        *kept,
        F.col("raw.battleTime").alias("battle_time"),
        F.col("raw.gameMode.id").alias("game_mode"),
        player("team").alias("player1"),
        player("opponent").alias("player2"),
    )


def to_records(battles: DataFrame) -> DataFrame:
    """Battles as JSON text in ``value``, the form published to a topic."""
    fields = ["battle_time", "game_mode", "player1", "player2"]
    return battles.select(F.to_json(F.struct(*fields)).alias("value"))


def read_battle_csv(spark: SparkSession, *paths: str, max_rows: int | None = None) -> DataFrame:
    """Header-less (gzip) CSV battles; values that do not fit their type become null.

    A gzip file is one split; ``max_rows`` caps the read for a look at a file.
    """
    text = spark.read.schema(schemas.BATTLE_CSV).csv(list(paths))
    return text if max_rows is None else text.limit(max_rows)


def csv_to_flat(rows: DataFrame) -> DataFrame:
    def deck(side: str) -> Column:
        return F.array(*[F.col(f"card{side}{i}") for i in range(1, schemas.DECK_SIZE + 1)])

    info = [
        F.col(f"{name}{side}").alias(f"p{side}_{name}")
        for side in schemas.SIDES for name in ("tag", "trophies", "crowns")
    ]
    return rows.select(
        "battle_time", battle_date(F.col("battle_time")).alias("battle_date"), "game_mode",
        *info, deck("1").alias("p1_deck"), deck("2").alias("p2_deck"),
    )


def flat_to_csv(flat: DataFrame) -> DataFrame:
    """The 24 file columns of flat battles."""
    columns = [F.col("battle_time"), F.col("game_mode")]
    for side in schemas.SIDES:
        columns += [F.col(f"p{side}_{n}").alias(f"{n}{side}") for n in ("tag", "trophies", "crowns")]
        columns += [card.alias(f"card{side}{i}") for i, card in enumerate(file_cards(F.col(f"p{side}_deck")), 1)]
    return flat.select(*columns)


def write_sorted_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Distinct rows in time order across files, gzip CSV without header."""
    (
        rows.distinct().repartitionByRange(*rows.columns).sortWithinPartitions(*rows.columns)
        .write.mode(mode).option("compression", "gzip").csv(path)
    )


def append_sorted_csv(rows: DataFrame, path: str) -> None:
    """Adds the rows that the CSV files at ``path`` don't hold yet, so that a batch sent twice adds nothing.

    Values count as the file has them: those that don't fit their column are null on both sides. Equal rows have equal
    times, so only what the files hold between the first and the last time of the batch is compared, on every column and
    in one grouping: a row is new if none of its group is from the files.
    """
    kinds = [field.split() for field in schemas.BATTLE_CSV.split(", ")]
    # Stored, so that the times and the rows written are those of one and the same batch.
    fitted = cut_lineage(rows.select(*[narrow(F.col(name), kind).alias(name) for name, kind in kinds]))
    time = F.col("battle_time")
    first, last, untimed = fitted.agg(F.min(time), F.max(time), F.coalesce(F.bool_or(time.isNull()), F.lit(False))).first()
    near = time.between(F.lit(first), F.lit(last)) | (time.isNull() & F.lit(untimed))
    held = read_battle_csv(rows.sparkSession, path).where(near)
    both = fitted.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True)))
    groups = both.groupBy(*fitted.columns).agg(F.bool_or("held").alias("held"))
    write_sorted_csv(groups.where(~F.col("held")).drop("held"), path, mode="append")


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, force: bool = False) -> DataFrame:
    """All CSV files of a folder to parquet partitioned by day; refuses to overwrite unless forced."""
    flat = csv_to_flat(read_battle_csv(spark, csv_path))
    mode = "overwrite" if force else "errorifexists"
    # Rows of a day are brought together; a day too large for one task is split, small ones share a task.
    flat.hint("rebalance", F.col("battle_date")).write.mode(mode).partitionBy("battle_date").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def save_by_player(rows: DataFrame, name: str, path: str, buckets: int, tag: str = "tag") -> DataFrame:
    """A catalog table in buckets of the player's tag, sorted in each; tables saved so join and group without a shuffle."""
    (
        rows.repartition(buckets, tag).write.bucketBy(buckets, tag).sortBy(tag).mode("overwrite")
        .option("path", path).saveAsTable(name)
    )
    return rows.sparkSession.table(name)


def log_lines(records: DataFrame) -> DataFrame:
    """Log lines with arrival time and the name of the daily index they go to."""
    arrived = records.select("value", F.current_timestamp().alias("ingest_ts"))
    return arrived.withColumn(
        "log_index", F.concat(F.lit("spark-logs-"), F.date_format("ingest_ts", "yyyy.MM.dd"))
    )
