"""Declared schemas; nothing is inferred on read."""

from __future__ import annotations

from pyspark.sql import types as T

PLAYER = T.StructType([
    T.StructField("tag", T.StringType()),
    T.StructField("trophies", T.IntegerType()),
    T.StructField("crowns", T.IntegerType()),
    T.StructField("deck", T.ArrayType(T.IntegerType())),
])

BATTLE = T.StructType([
    T.StructField("battle_time", T.StringType()),
    T.StructField("game_mode", T.IntegerType()),
    T.StructField("player1", PLAYER),
    T.StructField("player2", PLAYER),
])

# Keys may be missing in the raw log; they then count as 0.
_RAW_SIDE = (
    "array<struct<tag string, startingTrophies int, trophyChange int, crowns int,"
    " cards array<struct<id int>>>>"
)
RAW_BATTLE = (
    f"battleTime string, gameMode struct<id int>, team {_RAW_SIDE}, opponent {_RAW_SIDE}"
)

DECK_SIZE = 8
SIDES = ("1", "2")


def _csv_side(side: str) -> list[str]:
    cards = [f"card{side}{i} int" for i in range(1, DECK_SIZE + 1)]
    return [f"tag{side} string", f"trophies{side} smallint", f"crowns{side} tinyint", *cards]


# Flat, header-less file: time, mode, then tag, trophies, crowns and eight cards per player.
BATTLE_CSV = ", ".join(["battle_time string", "game_mode int", *_csv_side("1"), *_csv_side("2")])

TOPIC_RECORD = "topic string, key binary, value binary"

REGISTRY = (
    "model_name string, timestamp timestamp_ntz, model_path string, mapping_path string,"
    " matrix_path string, training_path string, total_patterns bigint, total_training_samples bigint"
)

MAPPING = "deck_pattern string, deck_pattern_id int"

MOMENTS = "deck_pattern string, next_card int, n bigint, s double, m2 double, len_sum bigint"

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

# Time stamps of the logs: text that also sorts in time order.
TIME_FORMAT = "yyyyMMdd'T'HHmmss.SSS'Z'"
