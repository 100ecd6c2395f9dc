"""Envelopes of the raw feed into typed tables. The same expressions serve batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import canonical_json, to_double, to_long, utc_date
from ..schemas import TICKER_NUMBERS, VERSION

COMMON = ("schema_version", "source", "session_id", "symbol", "exchange_ts_ms", "received_at_ns", "source_path", "source_line")


def envelopes(lines: DataFrame) -> DataFrame:
    """(value, source_path, source_line) as envelopes with problem: null, or the first rule that a line breaks."""
    field = lambda name: F.get_json_object("value", f"$.{name}")
    e = lines.select(
        "source_path", "source_line",
        F.col("value").alias("raw"),
        to_long(field("schema_version")).cast("int").alias("schema_version"), field("source").alias("source"), field("session_id").alias("session_id"),
        field("kind").alias("kind"), field("symbol").alias("symbol"), to_long(field("exchange_ts_ms")).alias("exchange_ts_ms"), to_long(field("received_at_ns")).alias("received_at_ns"),
        field("payload").alias("payload"),
    )
    parts = F.split("source_path", "/")
    n = F.size(parts)
    at = lambda back: F.when(n >= back, F.element_at(parts, -back))  # noqa: E731  kind/symbol/YYYY/MM/DD/file
    dated = F.when(n >= 6, F.concat_ws("-", at(4), at(3), at(2)))
    problem = (
        F.when(F.get_json_object("raw", "$").isNull(), "not_json")
        .when(~F.col("schema_version").eqNullSafe(F.lit(VERSION)), "version")
        .when(F.coalesce(F.col("kind"), F.lit("")) == "", "kind")
        .when(F.coalesce(F.col("symbol"), F.lit("")) == "", "symbol")
        .when(~F.coalesce(F.col("exchange_ts_ms") > 0, F.lit(False)), "exchange_time")
        .when(~F.coalesce(F.col("received_at_ns") > 0, F.lit(False)), "received_time")
        .when(F.col("payload").isNull(), "payload")
        .when((at(6) != F.col("kind")) | (at(5) != F.col("symbol")), "path")
        .when(dated != utc_date(F.expr("received_at_ns div 1000000")), "date")
    )
    return e.withColumn("problem", problem).drop("raw")


def _levels(side: str) -> tuple[Column, Column]:
    parsed = F.from_json(F.get_json_object("payload", f"$.{side}"), "array<array<string>>")
    return F.transform(parsed, lambda x: to_double(x[0], positive=True)), F.transform(parsed, lambda x: to_double(x[1], positive=True))


def orderbook(e: DataFrame) -> DataFrame:
    field = lambda name: to_long(F.get_json_object("payload", f"$.{name}"))
    bids, asks = _levels("bids"), _levels("asks")
    return e.where(F.col("problem").isNull() & (F.col("kind") == "orderbook")).select(
        *COMMON, field("matching_engine_ts_ms").alias("matching_engine_ts_ms"), field("update_id").alias("update_id"), field("sequence").alias("sequence"),
        bids[0].alias("bid_prices"), bids[1].alias("bid_sizes"), asks[0].alias("ask_prices"), asks[1].alias("ask_sizes"),
    )


def trades(e: DataFrame) -> DataFrame:
    """One row per trade of each batch; trades with another side than Buy or Sell, or without a positive price and size, go."""
    kind = "array<struct<T: bigint, i: string, S: string, p: string, v: string, L: string, seq: bigint, BT: boolean, RPI: boolean>>"
    each = e.where(F.col("problem").isNull() & (F.col("kind") == "trades")).select(*COMMON, F.explode(F.from_json("payload", kind)).alias("t"))
    out = each.select(
        *COMMON, F.col("t.T").alias("event_ts_ms"), F.col("t.i").alias("trade_id"), F.col("t.S").alias("side"), to_double(F.col("t.p"), positive=True).alias("price"),
        to_double(F.col("t.v"), positive=True).alias("size"), F.col("t.L").alias("tick_direction"), F.col("t.seq").alias("sequence"), F.col("t.BT").alias("is_block_trade"), F.col("t.RPI").alias("is_rpi_trade"),
    )
    return out.where(F.col("side").isin("Buy", "Sell") & F.col("price").isNotNull() & F.col("size").isNotNull() & F.col("trade_id").isNotNull())


def ticker(e: DataFrame) -> DataFrame:
    field = lambda name: F.get_json_object("payload", f"$.{name}")
    return e.where(F.col("problem").isNull() & (F.col("kind") == "ticker")).select(
        *COMMON, *(to_double(field(j)).alias(c) for c, j in TICKER_NUMBERS.items()),
        to_long(field("nextFundingTime")).alias("next_funding_time_ms"), to_long(field("fundingIntervalHour")).cast("int").alias("funding_interval_hours"), field("tickDirection").alias("tick_direction"),
    )


def kline(e: DataFrame) -> DataFrame:
    """Confirmed candles whose interval agrees with their kind, kline_<interval>, with the digest of their payload in canonical form."""
    field = lambda name: F.get_json_object("payload", f"$.{name}")
    rows = e.where(F.col("problem").isNull() & F.col("kind").startswith("kline_") & (F.lower(field("confirm")) == "true") & (F.concat(F.lit("kline_"), field("interval")) == F.col("kind")))
    digest = F.sha2(canonical_json(F.from_json("payload", "map<string,string>")), 256)
    numbers = (to_double(field(c)).alias(c) for c in ("open", "high", "low", "close", "volume", "turnover"))
    return rows.select(*COMMON, field("interval").alias("interval"), to_long(field("start")).alias("start_ms"), to_long(field("end")).alias("end_ms"), *numbers, digest.alias("payload_sha256"))


def latest_candles(candles: DataFrame) -> DataFrame:
    """One row per (symbol, interval, start_ms): the last received; of equal times the first line.

    Equal times with different payloads are an error that ambiguous_revisions lists.
    """
    from .joins import latest_by

    order = [F.col("received_at_ns"), F.struct((-F.col("source_line")).alias("l"), F.col("source_path").alias("p"))]
    return latest_by(candles, ["symbol", "interval", "start_ms"], order)


def history_rows(raw: DataFrame, symbol: str, date: str) -> DataFrame:
    """Rows of a day's trade file (CSV with a header, names in any case) typed, with problem: null or the first rule that a row breaks."""
    aliases = {"timestamp": "timestamp", "symbol": "symbol", "side": "side", "size": "size", "price": "price", "trdmatchid": "trade_id", "rpi": "rpi"}
    named = raw.select(*(F.col(f"`{c}`").alias(aliases[c.strip().lower()]) for c in raw.columns if c.strip().lower() in aliases))
    from ..functions.scalars import event_ns

    rows = named.select(
        event_ns(F.col("timestamp")).alias("received_at_ns"), "symbol", "side", to_double(F.col("size"), positive=True).alias("size"), to_double(F.col("price"), positive=True).alias("price"), F.col("trade_id")
    )
    problem = (
        F.when(F.col("received_at_ns").isNull(), "time")
        .when(utc_date(F.expr("received_at_ns div 1000000")) != date, "day")
        .when(F.col("symbol") != symbol, "symbol")
        .when(~F.col("side").isin("Buy", "Sell"), "side")
        .when(F.col("price").isNull() | F.col("size").isNull(), "number")
    )
    return rows.withColumn("problem", problem)
