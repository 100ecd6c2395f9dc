"""The test tables in the roles that the operators take: trades, tickers, books, revisions, candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.scalars import div, micros

ANCHOR = "purchase"
HOUR_NS = 3600 * 1_000_000_000
BAR_NS = 6 * HOUR_NS


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    us = micros(F.col("ts"))
    k = F.get_json_object("props", "$.k").cast("double")
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        (us * 1000).alias("received_at_ns"),
        div(us, 1000).alias("event_ts_ms"),
        F.col("event_id").alias("sequence"),
        (F.lit(1000.0) + F.col("value")).alias("price"),
        (k + 1).alias("size"),
        F.when(F.col("user_id") % 2 == 0, "Buy").otherwise("Sell").alias("side"),
        (F.col("event_id") % 17 == 0).alias("is_block"),
        (F.col("event_id") % 23 == 0).alias("is_rpi"),
        F.concat(F.lit("s"), div(us, 604_800_000_000).cast("string")).alias("session_id"),
        "user_id",
    )


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir)
    return t.select(
        "symbol", "received_at_ns", "event_ts_ms", "sequence", "session_id",
        F.col("price").alias("mark_price"),
        (F.col("price") - F.pmod("sequence", F.lit(7))).alias("index_price"),
        (F.lit(1000.0) + F.col("user_id")).alias("open_interest"),
        F.when(F.col("sequence") % 5 != 0, F.pmod("sequence", F.lit(11)) * 0.0001).alias("funding_rate"),
    )


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    sizes = lambda start: F.transform(F.slice(e, start, 32), lambda x: F.abs(x.cast("double")))
    prices = lambda sign: F.transform(F.sequence(F.lit(1), F.lit(32)), lambda i: F.lit(1000.0) + F.lit(sign * 0.5) * i)
    return read(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("L"), F.col("label").cast("string")).alias("symbol"),
        (F.lit(1_704_067_200_000_000_000) + F.col("vec_id") * HOUR_NS).alias("received_at_ns"),
        F.col("vec_id").alias("update_id"),
        prices(-1).alias("bid_prices"), sizes(1).alias("bid_sizes"), prices(1).alias("ask_prices"), sizes(33).alias("ask_sizes"),
    )


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem")
    payload = F.sha2(F.concat_ws("|", *(F.col(c).cast("string") for c in ("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"))), 256)
    return line.select(
        "l_orderkey", "l_linenumber", micros(F.col("l_shipdate")).alias("received_us"), payload.alias("payload_sha256"),
        "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
    )


#: The same roles in SQL, as common table expressions.
SQL = {
    "ticks": """ticks AS (
  SELECT event_type AS symbol, epoch_us(ts) * 1000 AS received_at_ns, epoch_us(ts) // 1000 AS event_ts_ms, event_id AS sequence,
    1000.0::DOUBLE + value AS price, json_extract_string(props, '$.k')::DOUBLE + 1 AS size,
    CASE WHEN user_id % 2 = 0 THEN 'Buy' ELSE 'Sell' END AS side, event_id % 17 = 0 AS is_block, event_id % 23 = 0 AS is_rpi,
    's' || (epoch_us(ts) // 604800000000)::VARCHAR AS session_id, user_id
  FROM events)""",
    "tickers": """tickers AS (
  SELECT symbol, received_at_ns, event_ts_ms, sequence, session_id, price AS mark_price, price - sequence % 7 AS index_price,
    1000.0::DOUBLE + user_id AS open_interest, CASE WHEN sequence % 5 <> 0 THEN (sequence % 11)::DOUBLE * 0.0001::DOUBLE END AS funding_rate
  FROM ticks)""",
    "books": """books AS (
  SELECT 'L' || label AS symbol, 1704067200000000000 + vec_id * 3600000000000 AS received_at_ns, vec_id AS update_id,
    list_transform(range(1, 33), lambda i: 1000.0::DOUBLE - 0.5::DOUBLE * i) AS bid_prices,
    list_transform(list_slice(embedding, 1, 32), lambda x: abs(x::DOUBLE)) AS bid_sizes,
    list_transform(range(1, 33), lambda i: 1000.0::DOUBLE + 0.5::DOUBLE * i) AS ask_prices,
    list_transform(list_slice(embedding, 33, 64), lambda x: abs(x::DOUBLE)) AS ask_sizes
  FROM embeddings)""",
    "revisions": """revisions AS (
  SELECT l_orderkey, l_linenumber, epoch_us(l_shipdate) AS received_us,
    sha256(concat_ws('|', l_partkey::VARCHAR, l_suppkey::VARCHAR, l_returnflag, l_linestatus)) AS payload_sha256,
    l_partkey, l_suppkey, l_extendedprice, l_quantity
  FROM lineitem)""",
    "bars": """bars AS (
  SELECT symbol, received_at_ns // 21600000000000 * 21600000000000 AS start_ns,
    arg_min(price, (received_at_ns, event_ts_ms, sequence)) AS open, max(price) AS high, min(price) AS low,
    arg_max(price, (received_at_ns, event_ts_ms, sequence)) AS close,
    sum(size::DECIMAL(20, 6))::DOUBLE AS volume, sum((price * size)::DECIMAL(28, 6))::DOUBLE AS turnover,
    coalesce(sum(size::DECIMAL(20, 6)) FILTER (side = 'Buy'), 0)::DOUBLE AS buy_volume,
    coalesce(sum(size::DECIMAL(20, 6)) FILTER (side = 'Sell'), 0)::DOUBLE AS sell_volume,
    count(*)::BIGINT AS trade_count, min(received_at_ns) AS first_event_ns, max(received_at_ns) AS last_event_ns
  FROM ticks GROUP BY ALL)""",
}


def with_sql(*names: str) -> str:
    """A WITH clause of these roles and those that they rest on."""
    rests = {"tickers": ["ticks"], "bars": ["ticks"]}
    order: list[str] = []
    for n in names:
        for m in (*rests.get(n, ()), n):
            if m not in order:
                order.append(m)
    return "WITH " + ",\n".join(SQL[n] for n in order)
