"""Streams of envelopes: normalised books, throttled samples, bars, dedup and a journal.

Visibility goes by the time of receipt. A watermark on it only bounds state; a late row is admitted while its state lasts.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.scalars import NS


def received_at(rows: DataFrame, received_ns: str = "received_at_ns") -> DataFrame:
    """rows with received_at as a timestamp (microseconds) for watermarks and windows."""
    return rows.withColumn("received_at", F.timestamp_micros(F.expr(f"{received_ns} div 1000")))


def deduplicated(rows: DataFrame, keys: list[str], delay: str = "10 minutes") -> DataFrame:
    """The first of equal keys within the watermark's delay."""
    return received_at(rows).withWatermark("received_at", delay).dropDuplicatesWithinWatermark(keys)


def bars(trades: DataFrame, width: str, delay: str = "10 minutes") -> DataFrame:
    """OHLCV in tumbling windows of the time of receipt."""
    key = F.struct("received_at_ns", "event_ts_ms", "sequence")
    out = received_at(trades).withWatermark("received_at", delay).groupBy("symbol", F.window("received_at", width)).agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", key).alias("close"),
        F.sum(F.col("size").cast("decimal(20,6)")).cast("double").alias("volume"), F.count("*").alias("trade_count"),
    )
    return out.select("symbol", (F.unix_micros("window.start") * 1000).alias("start_ns"), "open", "high", "low", "close", "volume", "trade_count")


def sliding(trades: DataFrame, width: str, step: str, delay: str = "10 minutes") -> DataFrame:
    return received_at(trades).withWatermark("received_at", delay).groupBy("symbol", F.window("received_at", width, step)).agg(F.count("*").alias("n"), F.max("price").alias("high"))


BOOK_STATE = "session string, update_id long, sequence long, last_emit_ns long, bids map<double,double>, asks map<double,double>"
BOOK_OUT = "symbol string, received_at_ns long, update_id long, bid_prices array<double>, bid_sizes array<double>, ask_prices array<double>, ask_sizes array<double>"


def normalise_books(messages: DataFrame, depth: int = 50, interval_ns: int = NS, ttl_ms: int = 3_600_000) -> DataFrame:
    """Samples of order books from snapshots and deltas, one state per symbol.

    messages: symbol, session_id, type (snapshot, delta), received_at_ns, update_id, sequence, bids, asks (array<array<double>> of price and size). A
    snapshot, or update_id 1, replaces the book; a delta counts only if both its numbers are above the last ones; size 0 deletes. Another
    session clears the state. A message of type snapshot always emits; others once interval_ns has passed.
    """

    def run(key: tuple, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        session, update_id, sequence, last_emit, bids, asks = state.get if state.exists else (None, None, None, None, {}, {})
        bids, asks = dict(bids), dict(asks)
        out = []
        rows = pd.concat(list(batches)).sort_values(["received_at_ns", "update_id"], kind="stable")
        for m in rows.itertuples(index=False):
            if m.session_id != session:
                session, update_id, sequence, last_emit, bids, asks = m.session_id, None, None, None, {}, {}
            if m.type == "snapshot" or m.update_id == 1:
                bids, asks = {}, {}
            elif update_id is None or m.update_id <= update_id or m.sequence <= sequence:
                continue
            for side, changes in ((bids, m.bids), (asks, m.asks)):
                for price, size in (map(float, level) for level in changes):
                    if not price > 0 or not 0 <= size < float("inf"):
                        continue
                    if size == 0:
                        side.pop(price, None)
                    else:
                        side[price] = size
            update_id, sequence = int(m.update_id), int(m.sequence)
            if m.type == "snapshot" or last_emit is None or m.received_at_ns - last_emit >= interval_ns:
                last_emit = int(m.received_at_ns)
                b, a = sorted(bids, reverse=True)[:depth], sorted(asks)[:depth]
                out.append((key[0], last_emit, update_id, b, [bids[p] for p in b], a, [asks[p] for p in a]))
        state.update((session, update_id, sequence, last_emit, bids, asks))
        state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame(out, columns=["symbol", "received_at_ns", "update_id", "bid_prices", "bid_sizes", "ask_prices", "ask_sizes"])

    return messages.groupBy("symbol").applyInPandasWithState(run, BOOK_OUT, BOOK_STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


SETTLED = "decision_id string, symbol string, decision_at_ns long, outcome string, return_bps double"
PENDING = "pending array<struct<decision_id: string, decision_at_ns: bigint, settle_ns: bigint, entry: double, stop: double, profit: double, long: boolean, outcome: string, price: double, last: double>>, session string"


def settle(events: DataFrame, ttl_ms: int = 86_400_000) -> DataFrame:
    """Deferred settlement of decisions by the trades that follow, one state per symbol.

    events, in one stream: symbol, session_id, received_at_ns, price for trades; decisions also have decision_id, settle_ns, entry, stop, profit and long. A decision
    settles once data past settle_ns is seen; another session leaves what is pending UNRESOLVED.
    """

    def run(key: tuple, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        pending, session = state.get if state.exists else ([], None)
        pending = [list(p) for p in pending]
        out = []
        for e in pd.concat(list(batches)).sort_values("received_at_ns", kind="stable").itertuples(index=False):
            if session is not None and e.session_id != session:
                out += [(p[0], key[0], p[1], "UNRESOLVED", None) for p in pending]
                pending = []
            session = e.session_id
            if isinstance(e.decision_id, str):
                pending.append([e.decision_id, int(e.received_at_ns), int(e.settle_ns), float(e.entry), float(e.stop), float(e.profit), bool(e.long), None, None, None])
                continue
            kept = []
            for p in pending:
                if e.received_at_ns > p[2]:
                    outcome, price = p[7] or "TIMEOUT", p[8] if p[7] else p[9]
                    up = 1 if p[6] else -1
                    out.append((p[0], key[0], p[1], outcome, None if price is None else up * (price / p[3] - 1) * 1e4))
                    continue
                if p[7] is None and e.received_at_ns > p[1]:
                    p[9] = float(e.price)
                    if e.price <= p[4] if p[6] else e.price >= p[4]:
                        p[7], p[8] = "SL_FIRST", p[4]
                    elif e.price >= p[5] if p[6] else e.price <= p[5]:
                        p[7], p[8] = "TP_FIRST", p[5]
                kept.append(p)
            pending = kept
        state.update(([tuple(p) for p in pending], session))
        state.setTimeoutDuration(ttl_ms)
        yield pd.DataFrame(out, columns=["decision_id", "symbol", "decision_at_ns", "outcome", "return_bps"])

    return events.groupBy("symbol").applyInPandasWithState(run, SETTLED, PENDING, "append", GroupStateTimeout.ProcessingTimeTimeout)


def append_once(path: str):
    """A foreachBatch function that writes each batch to a folder of its number: a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write
