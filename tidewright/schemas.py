"""The fixed schemas of stored tables. Times are whole numbers; enumerations are text."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

VERSION = 1
_TYPES = {"int": IntegerType(), "long": LongType(), "string": StringType(), "double": DoubleType(), "boolean": BooleanType(), "array<double>": ArrayType(DoubleType())}


def _struct(columns: str) -> StructType:
    """A schema from name and type pairs, without a session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(","))])


_COMMON = "schema_version int, source string, session_id string, symbol string, exchange_ts_ms long, received_at_ns long, source_path string, source_line long"
#: Column and JSON name of a ticker's numbers (fixed values of the feed).
TICKER_NUMBERS = {
    "last_price": "lastPrice", "index_price": "indexPrice", "mark_price": "markPrice", "bid_price": "bid1Price", "bid_size": "bid1Size",
    "ask_price": "ask1Price", "ask_size": "ask1Size", "open_interest": "openInterest", "open_interest_value": "openInterestValue", "funding_rate": "fundingRate",
    "volume_24h": "volume24h", "turnover_24h": "turnover24h", "price_24h_fraction": "price24hPcnt", "high_price_24h": "highPrice24h", "low_price_24h": "lowPrice24h",
    "previous_price_1h": "prevPrice1h", "previous_price_24h": "prevPrice24h",
}

ENVELOPE = _struct("schema_version int, source string, session_id string, kind string, symbol string, exchange_ts_ms long, received_at_ns long, payload string")
ORDERBOOK = _struct(f"{_COMMON}, matching_engine_ts_ms long, update_id long, sequence long, bid_prices array<double>, bid_sizes array<double>, ask_prices array<double>, ask_sizes array<double>")
TRADES = _struct(f"{_COMMON}, event_ts_ms long, trade_id string, side string, price double, size double, tick_direction string, sequence long, is_block_trade boolean, is_rpi_trade boolean")
TICKER = _struct(f"{_COMMON}, {', '.join(f'{c} double' for c in TICKER_NUMBERS)}, next_funding_time_ms long, funding_interval_hours int, tick_direction string")
KLINE = _struct(f"{_COMMON}, interval string, start_ms long, end_ms long, open double, high double, low double, close double, volume double, turnover double, payload_sha256 string")
TRADE_BAR = _struct(
    "schema_version int, source string, symbol string, interval_seconds int, start_ms long, end_ms long, available_at_ns long, first_event_ns long, last_event_ns long, "
    "open double, high double, low double, close double, volume double, turnover double, buy_volume double, sell_volume double, trade_count long"
)
TABLES = {"orderbook": ORDERBOOK, "trades": TRADES, "ticker": TICKER, "kline": KLINE, "trade_bar": TRADE_BAR}


def check(df, schema: StructType) -> None:
    """Raises if df hasn't exactly the names and types of a schema, in order."""
    found, wanted = [(f.name, f.dataType) for f in df.schema], [(f.name, f.dataType) for f in schema]
    if found != wanted:
        raise ValueError(f"schema differs: {sorted(set(map(str, found)) ^ set(map(str, wanted)))}")
