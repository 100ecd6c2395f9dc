"""Window functions over bars and trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import div
from .bars import TRADE_ORDER
from .spans import trailing_sums


def _w(by: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*by).orderBy(*order)


def returns(bars: DataFrame, steps: Sequence[int], by: Sequence[str] = ("symbol",), order: str = "start_ns", price: str = "close") -> DataFrame:
    """return_k: price over that of k bars before, less 1."""
    w = _w(by, [order])
    return bars.withColumns({f"return_{k}": F.col(price) / F.lag(price, k).over(w) - 1 for k in steps})


def realized_volatility(bars: DataFrame, lengths: Sequence[int], by: Sequence[str] = ("symbol",), order: str = "start_ns") -> DataFrame:
    """vol_n: the root of the sum of the last n squared log returns; null until there are n."""
    w = _w(by, [order])
    squared = F.pow(F.log(F.col("close") / F.lag("close").over(w)), 2)
    out = bars.withColumn("_sq", squared)
    for n in lengths:
        frame = w.rowsBetween(1 - n, 0)
        out = out.withColumn(f"vol_{n}", F.when(F.count("_sq").over(frame) == n, F.sqrt(F.sum("_sq").over(frame))))
    return out.drop("_sq")


def true_range(bars: DataFrame, length: int, by: Sequence[str] = ("symbol",), order: str = "start_ns") -> DataFrame:
    """atr_bps: the mean of the last length true ranges over the close, in basis points."""
    w = _w(by, [order])
    before = F.lag("close").over(w)
    out = bars.withColumn("_tr", F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))).withColumn("_has", before)
    frame = w.rowsBetween(1 - length, 0)
    mean = F.when(F.count("_has").over(frame) == length, F.avg("_tr").over(frame) / F.col("close") * 10_000)
    return out.withColumn("atr_bps", mean).drop("_tr", "_has")


def range_and_volume(bars: DataFrame, short: int, long: int, by: Sequence[str] = ("symbol",), order: str = "start_ns") -> DataFrame:
    """range_bps of the bar, and volume_ratio: mean volume of the last short bars over that of the last long ones, 0 over 0."""
    w = _w(by, [order])
    few, many = F.avg("volume").over(w.rowsBetween(1 - short, 0)), F.avg("volume").over(w.rowsBetween(1 - long, 0))
    return bars.withColumn("range_bps", (F.col("high") - F.col("low")) / F.col("close") * 10_000).withColumn("volume_ratio", F.when(many == 0, 0.0).otherwise(few / many))


def trailing(trades: DataFrame, width_ns: int, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per trade what was traded in [t - width, t]: count, base, notional, imbalance and return.

    A window's sums are exact: differences of running sums at its ends. First and last prices are those that aren't null.
    """
    signed = F.when(F.col("side") == "Buy", F.col("size")).otherwise(-F.col("size"))
    exact = {"base": F.col("size"), "notional": F.col("price") * F.col("size"), "flow": signed}
    rows = trades.select(*by, *TRADE_ORDER, "price", *(c.cast("decimal(24,6)").alias(n) for n, c in exact.items()))
    out = trailing_sums(rows, by, width_ns, list(exact), 1_000_000)
    return out.select(
        *by, "received_at_ns", "sequence", "trade_count", "base", "notional",
        F.when(F.col("base") == 0, 0.0).otherwise(F.col("flow") / F.col("base")).alias("imbalance"),
        F.when(F.col("trade_count") < 2, 0.0).otherwise(F.col("last_price") / F.col("first_price") - 1).alias("trade_return"),
    )


def prefix_sums(trades: DataFrame, columns: dict[str, str], by: Sequence[str], order: Sequence[str], time: str, bucket_ns: int) -> DataFrame:
    """trades with running sums (decimal) of expressions by name: sums within buckets of time, on top of the sums of the buckets before."""
    rows = trades.withColumn("_b", div(F.col(time), bucket_ns))
    value = lambda e: F.expr(e).cast("decimal(24,6)")
    totals = rows.groupBy(*by, "_b").agg(*(F.sum(value(e)).alias(f"_{n}") for n, e in columns.items()))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "_b", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in columns))
    w = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.withColumns({n: F.sum(value(e)).over(w) for n, e in columns.items()})
    return inner.join(starts, [*by, "_b"]).select(*trades.columns, *((F.col(n) + F.col(f"_{n}")).cast("double").alias(n) for n in columns))


def decision_grid(bounds: DataFrame, step_ns: int, offset_ns: int, first: str, last: str) -> DataFrame:
    """bounds with decision_at_ns: each point of a grid, aligned to 1970 plus an offset, from first to last."""
    low = F.ceil((F.col(first) - offset_ns).cast("decimal(20,0)") / step_ns).cast("long") * step_ns + offset_ns
    high = div(F.col(last) - offset_ns, step_ns) * step_ns + offset_ns
    return bounds.where(low <= high).withColumn("decision_at_ns", F.explode(F.sequence(low, high, F.lit(step_ns).cast("long"))))


def calendar_features(rows: DataFrame, ms: str) -> DataFrame:
    from ..functions.scalars import calendar

    return rows.withColumns(calendar(F.col(ms)))
