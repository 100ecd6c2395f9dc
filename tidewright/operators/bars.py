"""Bars of trades in fixed intervals, and what is missing among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import div

#: The order of trades: when they were received, when they happened, their number (null last).
TRADE_ORDER = ("received_at_ns", "event_ts_ms", "sequence")
_LAST = (1 << 63) - 1


def order_key(columns: Sequence[str] = TRADE_ORDER) -> Column:
    """A struct that orders trades in time; a null number sorts last."""
    return F.struct(*(F.coalesce(c, F.lit(_LAST)).alias(c) for c in columns))


def ohlcv(trades: DataFrame, width_ns: int, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """One row per key and interval with trades. Sums are exact decimals; the aggregation is partial before its one shuffle."""
    key = order_key()
    start = div(F.col("received_at_ns"), width_ns) * width_ns
    size, money = F.col("size").cast("decimal(20,6)"), (F.col("price") * F.col("size")).cast("decimal(28,6)")
    side = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, size)), F.lit(0)).cast("double")
    return trades.groupBy(*by, start.alias("start_ns")).agg(
        F.min_by("price", key).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", key).alias("close"),
        F.sum(size).cast("double").alias("volume"),
        F.sum(money).cast("double").alias("turnover"),
        side("Buy").alias("buy_volume"),
        side("Sell").alias("sell_volume"),
        F.count("*").alias("trade_count"),
        F.min("received_at_ns").alias("first_event_ns"),
        F.max("received_at_ns").alias("last_event_ns"),
    )


def availability(bars: DataFrame, width_ns: int, latency_ms: int = 1000) -> DataFrame:
    """end_ms, the bar's last millisecond, and available_at_ns, from when it may be used."""
    end = div(F.col("start_ns"), 1_000_000) + width_ns // 1_000_000 - 1
    return bars.withColumn("end_ms", end).withColumn("available_at_ns", (F.col("end_ms") + 1 + latency_ms) * 1_000_000)


def missing_runs(bars: DataFrame, width_ns: int, start_ns: int, end_ns: int, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per key the intervals without a bar in [start_ns, end_ns) and the longest run of them, edges included."""
    w = Window.partitionBy(*by).orderBy("start_ns")
    steps = bars.where((F.col("start_ns") >= start_ns) & (F.col("start_ns") < end_ns)).select(*by, "start_ns", F.coalesce(F.lag("start_ns").over(w), F.lit(start_ns - width_ns)).alias("before"))
    steps = steps.withColumn("gap", div(F.col("start_ns") - F.col("before"), width_ns) - 1)
    out = steps.groupBy(*by).agg(F.count("*").alias("present"), F.max("gap").alias("inner_gap"), F.max("start_ns").alias("last_start"))
    total = (end_ns - start_ns) // width_ns
    trailing = div(F.lit(end_ns) - F.col("last_start"), width_ns) - 1
    return out.select(*by, (F.lit(total) - F.col("present")).alias("missing"), F.greatest("inner_gap", trailing).alias("longest_run"))


def bucket_extremes(trades: DataFrame, width_ns: int, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """High and low per bucket: what lets later range joins skip buckets that can't hit a barrier."""
    return trades.groupBy(*by, div(F.col("received_at_ns"), width_ns).alias("bucket")).agg(F.max("price").alias("high"), F.min("price").alias("low"))
