"""Labels that look forward from a decision: barriers, maker fills, and what follows a fill."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import div
from .bars import TRADE_ORDER, order_key
from .joins import range_pairs
from .spans import Expand, first_fills, first_hits, hits_after_fill


@dataclass(frozen=True)
class Barriers:
    """Distances in basis points: volatility scaled to the horizon, by a multiple, clipped."""

    stop_multiple: float = 1.0
    take_profit_ratio: float = 1.5
    least_bps: float = 10.0
    most_bps: float = 250.0

    def distances(self, volatility: Column, lookback: int, horizon: Column) -> tuple[Column, Column]:
        raw = volatility / F.sqrt(F.lit(float(lookback))) * F.sqrt(horizon.cast("double")) * self.stop_multiple * 10_000
        stop = F.least(F.greatest(raw, F.lit(self.least_bps)), F.lit(self.most_bps))
        return stop, stop * self.take_profit_ratio


def barrier_prices(entry: Column, side: Column, stop_bps: Column, profit_bps: Column) -> tuple[Column, Column]:
    """Stop and take-profit prices of a side."""
    up = F.when(side == "LONG", 1.0).otherwise(-1.0)
    return entry * (1 - up * stop_bps / 10_000), entry * (1 + up * profit_bps / 10_000)


def _crossed(side: str, stop: str, profit: str, low: str, high: str) -> tuple[Column, Column]:
    long = F.col(side) == "LONG"
    return (
        F.when(long, F.col(low) <= F.col(stop)).otherwise(F.col(high) >= F.col(stop)),
        F.when(long, F.col(high) >= F.col(profit)).otherwise(F.col(low) <= F.col(profit)),
    )


def barrier_outcomes(decisions: DataFrame, trades: DataFrame, bucket_ns: int, id: str = "decision_id", expand: Expand | None = None) -> DataFrame:
    """The first barrier that trades in (decision_at_ns, label_end_ns] reach.

    decisions: id, symbol, side, decision_at_ns, label_end_ns, entry_price, stop_price, profit_price. Trades at one order key that
    reach both barriers are AMBIGUOUS; none is TIMEOUT at the last trade, or without a price where nothing traded. No row per pair of decision
    and trade is made: each decision looks its first hits up among the trades of its horizon. With expand, decisions are what it makes of the rows given, which
    have symbol, decision_at_ns and the farthest label_end_ns.
    """
    return _resolved(first_hits(decisions, trades, "decision_at_ns", "label_end_ns", bucket_ns, expand))


def covered(rows: DataFrame, trades: DataFrame, end: str, name: str = "covered") -> DataFrame:
    """rows with whether the symbol's trades reach the end of their horizon; a label beyond the last trade isn't known yet.

    One row per symbol is counted up and joined.
    """
    last = trades.groupBy("symbol").agg(F.max("received_at_ns").alias("_last"))
    return rows.join(last, "symbol", "left").withColumn(name, F.coalesce(F.col("_last") >= F.col(end), F.lit(False))).drop("_last")


def _resolved(rows: DataFrame) -> DataFrame:
    s, p = F.col("stop_key"), F.col("profit_key")
    outcome = (
        F.when(s.isNull() & p.isNull(), "TIMEOUT")
        .when(s.isNotNull() & p.isNotNull() & (s == p), "AMBIGUOUS")
        .when(p.isNull() | (s < p), "SL_FIRST")
        .otherwise("TP_FIRST")
    )
    up = F.when(F.col("side") == "LONG", 1.0).otherwise(-1.0)
    exit_price = F.when(F.col("outcome") == "SL_FIRST", F.col("stop_price")).when(F.col("outcome") == "TP_FIRST", F.col("profit_price")).when(F.col("outcome") == "TIMEOUT", F.col("last_price"))
    rows = rows.withColumn("outcome", outcome)
    rows = rows.withColumn("return_bps", up * (exit_price / F.col("entry_price") - 1) * 10_000)
    resolution = F.when(F.col("outcome") != "TIMEOUT", F.lower("outcome")).when(F.col("last_price").isNull(), "no_trades").otherwise("horizon_end")
    return rows.withColumn("resolution", resolution)


def barrier_outcomes_on_bars(decisions: DataFrame, bars: DataFrame, bucket_ns: int, id: str = "decision_id") -> DataFrame:
    """As barrier_outcomes, on bars (available_at_ns, high, low, close): both barriers within one bar are AMBIGUOUS, and keep the time."""
    b = bars.select("symbol", "high", "low", "close", "available_at_ns")
    pairs = range_pairs(decisions.select(id, "symbol", "side", "decision_at_ns", "label_end_ns", "stop_price", "profit_price"), b, ["symbol"], "decision_at_ns", "label_end_ns", "available_at_ns", bucket_ns)
    stop, profit = _crossed("side", "stop_price", "profit_price", "low", "high")
    hits = pairs.groupBy(id).agg(
        F.min(F.when(stop, F.col("available_at_ns"))).alias("stop_key"),
        F.min(F.when(profit, F.col("available_at_ns"))).alias("profit_key"),
        F.max_by("close", "available_at_ns").alias("last_price"),
        F.count("*").alias("trades_seen"),
    )
    rows = _resolved(decisions.join(hits, id, "left"))
    return rows.withColumn("hit_at_ns", F.least("stop_key", "profit_key"))


def eligible() -> Column:
    """Whether a print may fill a resting order: neither a block nor a hidden one; null counts as not."""
    return ~F.coalesce("is_block", F.lit(False)) & ~F.coalesce("is_rpi", F.lit(False))


_FOUND = ("_trades", "_first_ns", "_full_ns", "_partial", "_volume")


def maker_fills(orders: DataFrame, trades: DataFrame, bucket_ns: int, id: str = "order_id", expand: Expand | None = None) -> DataFrame:
    """Fills of resting orders by contra trades in (active_at_ns, expires_at_ns), both ends open.

    orders: id, symbol, side (LONG, SHORT), entry_price, queue_ahead, size, active_at_ns, expires_at_ns. Prints at the price deplete the queue, then
    fill the order; a print through it fills the rest, and its volume doesn't count as traded at the price. Ineligible prints only count
    among window_trades. Trade sizes aren't negative. Each order looks its fills up among the trades of its window, without a row per pair.
    With expand, orders are what it makes of the rows given, which have symbol, active_at_ns and the farthest expires_at_ns.
    """
    t = trades.select("symbol", "price", F.col("size").cast("decimal(24,6)").alias("trade_size"), F.col("side").alias("trade_side"), eligible().alias("ok"), *TRADE_ORDER)
    out = first_fills(orders, t, bucket_ns, expand)
    full = F.col("_full_ns").isNotNull()
    status = F.when(full, "FULL_FILL").when(F.col("_partial") > 0, "PARTIAL_FILL").otherwise("NO_FILL")
    return out.select(
        *(c for c in out.columns if c not in _FOUND), F.col("_trades").alias("window_trades"), F.col("_first_ns").alias("first_fill_ns"), F.col("_full_ns").alias("full_fill_ns"),
        status.alias("fill_status"),
        F.when(full, F.lit(1.0)).otherwise(F.coalesce(F.col("_partial") / F.col("size"), F.lit(0.0))).alias("fill_fraction"),
        F.col("_volume").alias("contra_volume"),
    )


def queue_ahead(books: DataFrame, side: str, price: str, multiple: float = 1.0) -> DataFrame:
    """post_only (the order wouldn't trade at once) and queue: 0 inside the spread, else the size at its price; null where no level has it."""
    from .book import level_size

    bid, ask = F.element_at("bid_prices", 1), F.element_at("ask_prices", 1)
    p, long = F.col(price), F.col(side) == "LONG"
    near = F.greatest(F.abs(p) * 1e-10, F.lit(1e-12))
    post_only = F.when(long, p < ask - near).otherwise(p > bid + near)
    inside = F.when(long, p > bid + near).otherwise(p < ask - near)
    at = F.when(long, level_size(F.col("bid_prices"), F.col("bid_sizes"), p)).otherwise(level_size(F.col("ask_prices"), F.col("ask_sizes"), p))
    return books.withColumn("post_only", post_only).withColumn("queue", F.when(~post_only, F.lit(None)).when(inside, 0.0).otherwise(at * multiple))


def post_fill(fills: DataFrame, trades: DataFrame, bucket_ns: int, id: str = "order_id") -> DataFrame:
    """Barrier outcomes from eligible trades strictly after the fill's print, to horizon_end_ns.

    fills: id, symbol, side, fill_ns, fill_sequence, fill_price (of the print that filled the order), horizon_end_ns, entry_price, stop_price,
    profit_price. A fill's print that lies at the stop or beyond is AMBIGUOUS. covered: whether trades reach the horizon's end.
    """
    crossed = F.when(F.col("side") == "LONG", F.col("fill_price") <= F.col("stop_price")).otherwise(F.col("fill_price") >= F.col("stop_price"))
    out = covered(_resolved(hits_after_fill(fills, trades.where(eligible()), bucket_ns)), trades, "horizon_end_ns")
    at_fill = F.coalesce(crossed, F.lit(False))
    return out.withColumns({
        "outcome": F.when(at_fill, "AMBIGUOUS").otherwise(F.col("outcome")), "return_bps": F.when(~at_fill, F.col("return_bps")),
        "resolution": F.when(at_fill, "fill_trade_also_crossed_stop_barrier").otherwise(F.col("resolution")),
    })


def breaks_between(windows: DataFrame, snapshots: DataFrame, most_gap_ns: int, start: str, end: str, id: str) -> DataFrame:
    """windows with continuous: whether snapshots from the last one at or before start to end have no longer gap and one session.

    The breaks are counted up once; a window is continuous if the counts as of both ends are equal.
    """
    from .joins import asof

    w = Window.partitionBy("symbol").orderBy("received_at_ns", "sequence")
    gap = F.col("received_at_ns") - F.lag("received_at_ns").over(w) > most_gap_ns
    broken = F.coalesce(gap | (F.col("session_id") != F.lag("session_id").over(w)), F.lit(False)).cast("long")
    counted = snapshots.withColumn("_broken", broken).withColumn("breaks", F.sum("_broken").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    at = lambda rows, when, name: asof(rows, counted.select("symbol", F.col("received_at_ns").alias("snapshot_ns"), "sequence", F.col("breaks").alias(name), F.col("received_at_ns").alias(f"{name}_ns")), ["symbol"], when, "snapshot_ns", [name, f"{name}_ns"], order=["sequence"])
    both = at(at(windows, start, "breaks_start"), end, "breaks_end")
    whole = (F.col("breaks_start") == F.col("breaks_end")) & (F.col(end) - F.col("breaks_end_ns") <= most_gap_ns)
    return both.select(*windows.columns, F.coalesce(whole, F.lit(False)).alias("continuous"))


def bars_complete(windows: DataFrame, bars: DataFrame, width_ns: int, start: str, end: str, id: str) -> DataFrame:
    """windows with complete: whether each interval that begins in [start, end) has its bar."""
    w = windows.withColumn("_last", F.col(end) - 1)
    pairs = range_pairs(w, bars.select("symbol", F.col("start_ns").alias("bar_ns")), ["symbol"], start, "_last", "bar_ns", 8 * width_ns, open_start=False)
    counts = pairs.groupBy(id).agg(F.count("*").alias("_n"))
    first = F.ceil(F.col(start).cast("decimal(20,0)") / width_ns).cast("long")
    expected = div(F.col(end) - 1, width_ns) - first + 1
    return windows.join(counts, id, "left").withColumn("complete", F.coalesce("_n", F.lit(0)) == expected).drop("_n")
