"""Order books in arrays: all within a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def depth(books: DataFrame, levels: Sequence[int]) -> DataFrame:
    """bid_L, ask_L, imbalance_L and notional_L of the first L levels."""
    out = {}
    for n in levels:
        bid, ask = total(F.slice("bid_sizes", 1, n)), total(F.slice("ask_sizes", 1, n))
        money = total(F.zip_with(F.slice("bid_prices", 1, n), F.slice("bid_sizes", 1, n), lambda p, s: p * s))
        money = money + total(F.zip_with(F.slice("ask_prices", 1, n), F.slice("ask_sizes", 1, n), lambda p, s: p * s))
        out |= {f"bid_{n}": bid, f"ask_{n}": ask, f"imbalance_{n}": F.when(bid + ask == 0, 0.0).otherwise((bid - ask) / (bid + ask)), f"notional_{n}": money}
    return books.withColumns(out)


def top(books: DataFrame) -> DataFrame:
    """mid, microprice (each price weighted by the other side's size) and spread_bps of the best level."""
    bid, ask, b, a = (F.element_at(c, 1) for c in ("bid_prices", "ask_prices", "bid_sizes", "ask_sizes"))
    mid = (bid + ask) / 2
    return books.withColumns({"mid": mid, "microprice": (ask * b + bid * a) / (b + a), "spread_bps": (ask - bid) / mid * 10_000})


def levels(books: DataFrame, n: int) -> DataFrame:
    """top_bids and top_asks: (price, size) of the best n levels, from levels in any order."""
    pairs = lambda side: F.arrays_zip(F.col(f"{side}_prices").alias("price"), F.col(f"{side}_sizes").alias("size"))
    return books.withColumns({"top_bids": F.slice(F.reverse(F.array_sort(pairs("bid"))), 1, n), "top_asks": F.slice(F.array_sort(pairs("ask")), 1, n)})


def reason(least_levels: int, age_ns: Column, most_age_ns: int) -> Column:
    """Why a book can't be used, or ok: missing, stale, short or invalid, in this order."""
    sizes = [F.size(c) for c in ("bid_prices", "bid_sizes", "ask_prices", "ask_sizes")]
    crossed = F.element_at("bid_prices", 1) >= F.element_at("ask_prices", 1)
    zero = F.exists("bid_sizes", lambda x: x <= 0) | F.exists("ask_sizes", lambda x: x <= 0)
    return (
        F.when(F.col("bid_prices").isNull(), "missing")
        .when(age_ns > most_age_ns, "stale")
        .when(F.least(*sizes) < least_levels, "short")
        .when(F.least(*sizes) != F.greatest(*sizes), "short")
        .when(crossed | zero, "invalid")
        .otherwise("ok")
    )


def level_size(prices: Column, sizes: Column, price: Column) -> Column:
    """The size at a price, equal within a relative 1e-10; null if no level has it."""
    near = F.filter(F.arrays_zip(prices.alias("p"), sizes.alias("s")), lambda x: F.abs(x["p"] - price) <= F.greatest(F.abs(price) * 1e-10, F.lit(1e-12)))
    return F.when(F.size(near) > 0, F.try_element_at(near, F.lit(1))["s"])


def rebuild(messages: DataFrame, at_ns: int, n: int) -> DataFrame:
    """The best n levels per symbol at a time, from level updates: (symbol, received_at_ns, sequence, side, price, size).

    The last update of each level counts; size 0 has deleted it. Prices are compared as decimals.
    """
    exact = messages.where(F.col("received_at_ns") <= at_ns).withColumn("price", F.col("price").cast("decimal(38,18)"))
    last = exact.groupBy("symbol", "side", "price").agg(F.max_by("size", F.struct("received_at_ns", "sequence")).alias("size")).where("size > 0")
    sign = F.when(F.col("side") == "Buy", -F.col("price")).otherwise(F.col("price"))
    listed = last.groupBy("symbol", "side").agg(F.slice(F.array_sort(F.collect_list(F.struct(sign.alias("k"), F.col("price").cast("double").alias("price"), "size"))), 1, n).alias("l"))
    return listed.select("symbol", "side", F.transform("l", lambda x: F.struct(x["price"].alias("price"), x["size"].alias("size"))).alias("levels"))
