"""Card, game-mode and season dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Game-mode ids, names and classes of the battle logs.
GAME_MODES = [
    (72000006, "Ladder", "ladder"),
    (72000044, "Ladder_GoldRush", "ladder"),
    (72000201, "Ladder_CrownRush", "ladder"),
    (72000323, "Ranked1v1", "ranked"),
    (72000327, "Ranked1v1_GoldRush", "ranked"),
    (72000328, "Ranked1v1_CrownRush", "ranked"),
    (72000333, "PickMode_Ladder", "ranked"),
    (72000345, "PickMode_Tournament_GoldRush", "ranked"),
    (72000346, "PickMode_Tournament_CrownRush", "ranked"),
    (72000009, "Tournament", "other"),
    (72000010, "Challenge", "other"),
    (72000066, "Showdown_Ladder", "other"),
    (72000007, "Friendly", "other"),
    (72000291, "Challenge_AllCards_EventDeck", "other"),
]
LADDER_MODES = [mode for mode, _, kind in GAME_MODES if kind == "ladder"]
RANKED_MODES = [mode for mode, _, kind in GAME_MODES if kind == "ranked"]
ONE_ON_ONE_MODES = [mode for mode, _, _ in GAME_MODES]

# A dimension up to this many rows may be turned into a literal map.
MAX_LITERAL_ROWS = 4096


def game_mode_dim(spark: SparkSession) -> DataFrame:
    # VALUES has an exact size, so the planner sends it to the battles and never shuffles them by mode.
    rows = ", ".join(str(row) for row in GAME_MODES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS modes(id, name_en, class)")


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    """Card file: one JSON array of objects; ``card_index`` is the place in the file."""
    schema = (
        "key string, name string, sc_key string, elixir int, type string, rarity string, arena int,"
        " description string, id int, evolved_spells_sc_key string, is_evolved boolean"
    )
    objects = spark.read.text(path, wholetext=True).select(
        F.posexplode(F.from_json("value", f"array<struct<{_struct_fields(schema)}>>"))
        .alias("card_index", "card")
    )
    return objects.select("card.*", "card_index")


def read_game_modes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id int, name_en string").option("multiLine", True).json(path)


def _struct_fields(ddl: str) -> str:
    return ", ".join(
        f"{name}: {kind}" for name, kind in (field.split() for field in ddl.split(","))
    )


def distinct_keys(dim: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value), one row per key: of a key's several values the least stays, whichever way it is looked up."""
    return dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


def literal_lookup(dim: DataFrame, key: str, value: str) -> Callable[[Column], Column] | None:
    """Function of a key column to its value (null without one), or None when the dimension is no ``literal_map``.

    A constant map is searched entry by entry; ids that lie close together are places of a constant array instead.
    """
    kinds, rows = dict(dim.dtypes), distinct_keys(dim, key, value).take(MAX_LITERAL_ROWS + 1)
    ids = [row[0] for row in rows]
    if not ids or len(ids) > MAX_LITERAL_ROWS or kinds[key] not in ("int", "bigint") or max(ids) - min(ids) >= 4 * len(ids):
        names = literal_map(dim, key, value)
        return None if names is None else lambda c: F.try_element_at(names, c)
    found, first = dict(map(tuple, rows)), min(ids)
    places = F.array(*[F.lit(found.get(i)) for i in range(first, max(ids) + 1)]).cast(f"array<{kinds[value]}>")
    return lambda c: F.get(places, F.try_subtract(c, F.lit(first)).try_cast("int"))


def literal_map(dim: DataFrame, key: str, value: str) -> Column | None:
    """The dimension as a map column, or None when it has more than MAX_LITERAL_ROWS rows.

    At most MAX_LITERAL_ROWS + 1 rows ever reach the driver; callers join beyond that size.
    """
    rows = distinct_keys(dim, key, value).take(MAX_LITERAL_ROWS + 1)
    if len(rows) > MAX_LITERAL_ROWS:
        return None
    if not rows:
        kinds = dict(dim.dtypes)
        return F.create_map().cast(f"map<{kinds[key]},{kinds[value]}>")
    return F.create_map(*[F.lit(cell) for row in rows for cell in row])


def map_of(dim: DataFrame, key: str, value: str) -> Column:
    """The dimension as a constant map column at any size; a large one is one JSON text that is folded into a constant.

    It is for dimensions whose places go into every row (flags per card), which no row could hold if they were many.
    """
    found = literal_map(dim, key, value)
    if found is not None:
        return found
    kinds = dict(dim.dtypes)
    entries = distinct_keys(dim, key, value).select(F.to_json(F.struct(F.col(key).alias("k"), F.col(value).alias("v"))).alias("e"))
    text = "[" + ",".join(r["e"] for r in entries.collect()) + "]"
    return F.map_from_entries(F.from_json(F.lit(text), f"array<struct<k:{kinds[key]},v:{kinds[value]}>>"))
