"""Small scalar helpers: times, text forms of numbers, safe narrowing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from battlelake.schemas import TIME_FORMAT


# The same text form as TIME_FORMAT, taken apart without a time zone, so that no clock change moves a battle.
_TIME_PARTS = r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2}\.\d{3})Z$"


def battle_ts(battle_time: Column) -> Column:
    """Time stamp of the text form; null when it does not parse."""
    plain = F.regexp_replace(battle_time, _TIME_PARTS, "$1-$2-$3 $4:$5:$6")
    return F.when(battle_time.rlike(_TIME_PARTS), plain.try_cast("timestamp_ntz"))


def event_time(battle_time: Column) -> Column:
    """The instant of the text form, for watermarks; the trailing Z is read as UTC."""
    return F.try_to_timestamp(battle_time, F.lit(TIME_FORMAT.replace("'Z'", "X")))


def utc_date(instant: Column) -> Column:
    """Day in UTC of an instant, whatever the session's time zone."""
    days = F.floor(F.unix_seconds(instant) / 86400).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def battle_date(battle_time: Column) -> Column:
    """Day of the battle, read from the first eight characters; null when they are no date."""
    year, month, day = (F.substring(battle_time, start, n) for start, n in ((1, 4), (5, 2), (7, 2)))
    return F.concat_ws("-", year, month, day).try_cast("date")


def version_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def floor_mean(a: Column, b: Column) -> Column:
    return F.floor((a + b) / 2)


def printable(value: Column) -> Column:
    """Text for values JSON cannot carry (NaN, infinities); null for ordinary numbers."""
    odd = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(odd, value.cast("string"))


def narrow(value: Column, kind: str) -> Column:
    """Cast to a smaller type; null instead of an error when the value does not fit."""
    return value.try_cast(kind)


def asset_path(root: str, key: Column) -> Column:
    return F.concat(F.lit(root.rstrip("/") + "/"), key, F.lit(".png"))


def matches_name(name: Column, query: str) -> Column:
    return F.lower(name).contains(query.lower())
