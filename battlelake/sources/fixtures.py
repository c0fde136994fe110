"""Battles, requests and dimensions derived from the ``events`` table by integer arithmetic.

The same formulas are written in SQL in ``plans/oracle.py``, so both engines see equal rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from battlelake.schemas import DECK_SIZE, EVENTS, TIME_FORMAT

PLAYERS = 150
CARDS = 121
NAMED_CARDS = 118
FIRST_CARD = 26000000


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _deck(start: str, step: str) -> str:
    # A lambda keeps the generated code small wherever the deck is used more than once.
    places = ", ".join(str(i) for i in range(DECK_SIZE))
    return f"transform(array({places}), i -> {FIRST_CARD} + ({start} + i * {step}) % {CARDS})"


def battles_flat_from(events: DataFrame) -> DataFrame:
    """One battle per event; works on a static and on a streaming table of events.

    A deck is an arithmetic series of cards: its archetype gives the first card and the step, and reversed
    decks start at the last card and step back.
    """
    last = DECK_SIZE - 1
    return (
        events.selectExpr(
            "event_id AS e", "user_id AS u", "ts", "event_type",
            f"(user_id + 1 + (event_id * 7) % {PLAYERS - 1}) % {PLAYERS} AS u2",
        )
        .selectExpr("*", "int((u + e % 3) % 40) AS a1", "int((u2 + e % 5) % 40) AS a2")
        .selectExpr(
            "*",
            f"a1 * 5 + IF(e % 7 = 0, {last} * (1 + a1 % 4), 0) AS start1",
            f"a2 * 5 + IF(e % 7 = 3, {last} * (1 + a2 % 4), 0) AS start2",
            "IF(e % 7 = 0, -1, 1) * (1 + a1 % 4) AS step1",
            "IF(e % 7 = 3, -1, 1) * (1 + a2 % 4) AS step2",
        )
        .selectExpr(
            "e AS battle_id",
            f"date_format(ts, \"{TIME_FORMAT}\") AS battle_time",
            "CASE event_type WHEN 'click' THEN 72000006 WHEN 'view' THEN 72000323 WHEN 'purchase' THEN 72000010"
            " WHEN 'signup' THEN 72000201 ELSE 72999999 END AS game_mode",
            "concat('P', lpad(string(u), 5, '0')) AS p1_tag",
            "int(5000 + (u * 37) % 3000 + e % 60) AS p1_trophies",
            "int((e * 7 + u) % 4) AS p1_crowns",
            f"{_deck('start1', 'step1')} AS p1_deck",
            "concat('P', lpad(string(u2), 5, '0')) AS p2_tag",
            "int(5000 + (u2 * 37) % 3000 + (e * 3) % 60) AS p2_trophies",
            "int((e * 5 + u2 * 3) % 4) AS p2_crowns",
            f"{_deck('start2', 'step2')} AS p2_deck",
        )
    )


def nest(flat: DataFrame) -> DataFrame:
    """Flat columns to the nested battle record (``battle_id`` is kept beside it)."""

    def player(side: str, name: str) -> str:
        fields = ", ".join(f"'{field}', {side}_{field}" for field in ("tag", "trophies", "crowns", "deck"))
        return f"named_struct({fields}) AS {name}"

    return flat.selectExpr(
        "battle_id", "battle_time", "game_mode", player("p1", "player1"), player("p2", "player2")
    )


def battles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest(battles_flat_from(read_events(spark, sf_dir)))


def battle_log(nested: DataFrame) -> DataFrame:
    """The log as collected from both players: some battles twice, seen from the other side or exactly.

    Every battle once; swapped sides again for ids divisible by 10; an exact copy for ids divisible by 25.
    """
    swapped = F.struct(F.col("player2").alias("player1"), F.col("player1").alias("player2"))
    same = F.struct("player1", "player2")
    copies = F.concat(
        F.array(same),
        F.when(F.col("battle_id") % 10 == 0, F.array(swapped)).otherwise(F.array().cast(_SIDES)),
        F.when(F.col("battle_id") % 25 == 0, F.array(same)).otherwise(F.array().cast(_SIDES)),
    )
    return (
        nested.withColumn("seen", F.explode(copies))
        .select("battle_id", "battle_time", "game_mode", "seen.player1", "seen.player2")
    )


def revised(nested: DataFrame, every: int, more: int) -> DataFrame:
    """Battles with ids divisible by ``every``, again with other crowns of the first player."""
    player = F.col("player1").withField("crowns", F.col("player1.crowns") + more)
    return nested.where(F.col("battle_id") % every == 0).withColumn("player1", player)


_PLAYER_DDL = "struct<tag:string,trophies:int,crowns:int,deck:array<int>>"
_SIDES = f"array<struct<player1:{_PLAYER_DDL},player2:{_PLAYER_DDL}>>"


def raw_log(log: DataFrame) -> DataFrame:
    """The log as raw API text: ``#`` before tags, trophies split in two keys, keys left out when 0."""

    def side(name: str) -> Column:
        trophies = F.col(f"{name}.trophies")
        change = (F.col("battle_id") % 40).cast("int")
        return F.array(F.struct(
            F.concat(F.lit("#"), F.col(f"{name}.tag")).alias("tag"),
            (trophies - change).alias("startingTrophies"),
            F.when(change != 0, change).alias("trophyChange"),
            F.col(f"{name}.crowns").alias("crowns"),
            F.transform(f"{name}.deck", lambda c: F.struct(c.alias("id"))).alias("cards"),
        ))

    record = F.struct(
        F.col("battle_time").alias("battleTime"),
        F.struct(F.col("game_mode").alias("id")).alias("gameMode"),
        side("player1").alias("team"),
        side("player2").alias("opponent"),
    )
    return log.select("battle_id", F.to_json(record).alias("value"))


def card_dim(spark: SparkSession) -> DataFrame:
    """Named cards; the last ids used in decks stay unnamed on purpose."""
    k = F.col("id").cast("int")
    return spark.range(NAMED_CARDS).select(
        (FIRST_CARD + k).alias("id"),
        k.alias("card_index"),
        F.concat(F.lit("card-"), k.cast("string")).alias("key"),
        F.concat(F.lit("Card "), k.cast("string")).alias("name"),
        (1 + k % 9).alias("elixir"),
    )


def season_dim(spark: SparkSession) -> DataFrame:
    return spark.sql(
        "SELECT * FROM VALUES (1, DATE'2024-01-01', DATE'2024-01-08'),"
        " (2, DATE'2024-01-08', DATE'2024-01-22'), (3, DATE'2024-01-22', DATE'2024-02-05')"
        " AS seasons(season, start_date, end_date)"
    )


def requests(flat: DataFrame) -> DataFrame:
    """One recommendation request per battle: its first cards, valid and invalid sizes, some unknown cards.

    Every 17th request asks for cards that no deck has, every 19th mixes one such card in.
    """
    return flat.selectExpr(
        "battle_id AS request_id",
        "concat("
        " slice(p1_deck, 1, CASE WHEN battle_id % 17 = 0 THEN 0"
        "   WHEN battle_id % 19 = 0 THEN least(int(battle_id % 10), 6) ELSE int(battle_id % 10) END),"
        " slice(array(int(29000000 + battle_id % 3)), 1,"
        "   IF(battle_id % 17 = 0 OR battle_id % 19 = 0, 1, 0))) AS partial_deck",
        "IF(battle_id % 13 <> 12, int(battle_id % 12), NULL) AS num_recommendations",
    )
