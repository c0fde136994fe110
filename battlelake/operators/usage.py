"""Card and deck usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from battlelake.operators.decks import all_decks

# Fixed value: decks kept per day by the daily report.
DAILY_TOP = 10


def card_usage_daily(flat: DataFrame) -> DataFrame:
    """Decks holding each card per day, and the card's share of the day's total."""
    usage = (
        all_decks(flat, "battle_date")
        .select("battle_date", F.explode(F.array_distinct("deck")).alias("card"))
        .groupBy("battle_date", "card")
        .agg(F.count(F.lit(1)).alias("usage"))
    )
    day = F.sum("usage").over(Window.partitionBy("battle_date"))
    return usage.withColumn("share", F.col("usage") / day)


def card_usage_total(flat: DataFrame, cards: DataFrame) -> DataFrame:
    """Usage of every card of the dimension (0 when unused) and of every unknown card in use."""
    usage = (
        all_decks(flat)
        .select(F.explode(F.array_distinct("deck")).alias("card"))
        .groupBy("card")
        .agg(F.count(F.lit(1)).alias("usage"))
    )
    names = cards.select(F.col("id").alias("card"), F.col("name").alias("card_name"))
    return usage.join(names, "card", "full").select(
        "card", "card_name", F.coalesce("usage", F.lit(0).cast("bigint")).alias("usage")
    )


def deck_usage(flat: DataFrame) -> DataFrame:
    return (
        all_decks(flat)
        .groupBy(F.sort_array("deck").alias("deck"))
        .agg(F.count(F.lit(1)).alias("usage"))
    )


def top_decks(usage: DataFrame, k: int) -> DataFrame:
    return usage.orderBy(F.desc("usage"), "deck").limit(k)


def deck_usage_daily_top_sum(flat: DataFrame, per_day: int = DAILY_TOP) -> DataFrame:
    """Earlier report: only the first decks of each day count, summed over the days."""
    daily = (
        all_decks(flat, "battle_date")
        .groupBy("battle_date", F.sort_array("deck").alias("deck"))
        .agg(F.count(F.lit(1)).alias("usage"))
    )
    place = F.row_number().over(
        Window.partitionBy("battle_date").orderBy(F.desc("usage"), "deck")
    )
    return (
        daily.withColumn("place", place).where(F.col("place") <= per_day)
        .groupBy("deck").agg(F.sum("usage").alias("usage"))
    )
