"""Column expressions shared by the operators. Times are whole numbers of nanoseconds or milliseconds since 1970, UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NS = 1_000_000_000


def fixed(x: Column, digits: int = 6) -> Column:
    """x to a number of digits, halves up, the same way in every engine."""
    scale = 10**digits
    return F.floor(x * scale + F.lit(0.5)).cast("double") / scale


def div(x: Column, by: int) -> Column:
    """Whole division of longs towards zero; doubles are never involved."""
    return F.call_function("div", x, F.lit(by).cast("long"))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def utc_date(ms: Column) -> Column:
    """The ISO date of milliseconds."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def identifier(*parts: Column, length: int = 64) -> Column:
    """SHA-256 in hexadecimal of parts joined by |, cut to a length."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, length)


def to_long(x: Column) -> Column:
    """A long from text; empty or malformed text gives null."""
    return F.nullif(F.trim(x), F.lit("")).try_cast("long")


def to_double(x: Column, positive: bool = False, nonnegative: bool = False) -> Column:
    """A finite double from text, in a range if asked for; else null."""
    value = F.nullif(F.trim(x), F.lit("")).try_cast("double")
    good = ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    good = good & (value > 0) if positive else good & (value >= 0) if nonnegative else good
    return F.when(good, value)


def event_ns(seconds: Column) -> Column:
    """Nanoseconds of decimal seconds in text; null if they are finer than that."""
    exact = seconds.try_cast("decimal(38,18)") * F.lit(NS).cast("decimal(10,0)")
    return F.when(exact == F.floor(exact), exact.cast("long"))


def calendar(ms: Column) -> dict[str, Column]:
    """Time of day and day of week (Monday 0) as points of circles."""
    import math

    day = F.pmod(ms, F.lit(86_400_000)) / F.lit(86_400_000.0)
    week = F.pmod(div(ms, 86_400_000) + 3, F.lit(7)) / F.lit(7.0)
    turn = F.lit(2 * math.pi)
    return {"hour_sin": F.sin(turn * day), "hour_cos": F.cos(turn * day), "weekday_sin": F.sin(turn * week), "weekday_cos": F.cos(turn * week)}


def canonical_json(pairs: Column) -> Column:
    """JSON of a map with its keys in order and no spaces."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(pairs))))
