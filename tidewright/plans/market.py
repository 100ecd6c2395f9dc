"""Bars, windows, grids and books."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import ANCHOR, BAR_NS, HOUR_NS, books, ticks, with_sql
from ..functions.scalars import div, fixed, identifier
from ..operators import bars as B
from ..operators import book as K
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import windows as W
from .common import Registry, r, rounded

M = Registry()
DAY_NS = 24 * HOUR_NS
#: The test events' span: 30 days from 2024-01-01.
SPAN = (1_704_067_200_000_000_000, 1_704_067_200_000_000_000 + 30 * DAY_NS)
_BARS = with_sql("bars")


def bars(spark, sf):
    return B.ohlcv(ticks(spark, sf), BAR_NS)


def _lagged(column: str, k: int) -> str:
    return f"lag({column}, {k}) OVER (PARTITION BY symbol ORDER BY start_ns)"


@M.add(f"""{_BARS}, rets AS (SELECT *, close / {_lagged('close', 1)} - 1 AS ret FROM bars)
SELECT a.symbol, a.start_ns, a.open, a.high, a.low, a.close, a.volume, a.trade_count, (a.start_ns + 21600000000000) // 1000000 * 1000000 + 1000000000 AS available_at_ns,
  {r('a.ret')} AS return_1, CASE WHEN a.symbol = 'purchase' AND a.ret IS NOT NULL THEN 0.0 ELSE {r('a.ret - b.ret')} END AS relative_return
FROM rets a LEFT JOIN rets b ON b.symbol = 'purchase' AND b.start_ns = a.start_ns""")
def anchor_relative_bars(spark, sf):
    rets = W.returns(B.availability(bars(spark, sf), BAR_NS), [1])
    out = J.with_anchor(rets, ANCHOR, "start_ns", ["return_1"])
    relative = F.when((F.col("symbol") == ANCHOR) & F.col("return_1").isNotNull(), 0.0).otherwise(fixed(F.col("return_1") - F.col("anchor_return_1")))
    return out.select("symbol", "start_ns", "open", "high", "low", "close", "volume", "trade_count", "available_at_ns", fixed(F.col("return_1")).alias("return_1"), relative.alias("relative_return"))


@M.add(f"{_BARS} SELECT * FROM bars")
def ohlcv_bars(spark, sf):
    return bars(spark, sf)


@M.add(f"{_BARS} SELECT symbol, start_ns, start_ns // 1000000 + 21600000 - 1 AS end_ms, (start_ns // 1000000 + 21600000 + 1000) * 1000000 AS available_at_ns FROM bars")
def bar_availability(spark, sf):
    return B.availability(bars(spark, sf), BAR_NS).select("symbol", "start_ns", "end_ms", "available_at_ns")


@M.add(f"""{with_sql('ticks')}, present AS (SELECT DISTINCT symbol, received_at_ns // 3600000000000 * 3600000000000 AS s FROM ticks WHERE received_at_ns >= {SPAN[0]} AND received_at_ns < {SPAN[1]}),
g AS (SELECT symbol, s, (s - coalesce(lag(s) OVER (PARTITION BY symbol ORDER BY s), {SPAN[0]} - 3600000000000)) // 3600000000000 - 1 AS gap FROM present)
SELECT symbol, 720 - count(*) AS missing, greatest(max(gap), ({SPAN[1]} - max(s)) // 3600000000000 - 1) AS longest_run FROM g GROUP BY symbol""")
def missing_bar_runs(spark, sf):
    return B.missing_runs(B.ohlcv(ticks(spark, sf), HOUR_NS), HOUR_NS, *SPAN)


@M.add(f"{_BARS} SELECT symbol, start_ns, " + ", ".join(f"{r('close / ' + _lagged('close', k) + ' - 1')} AS return_{k}" for k in (1, 3, 5, 15)) + " FROM bars")
def bar_returns(spark, sf):
    out = W.returns(bars(spark, sf), (1, 3, 5, 15))
    return rounded(out, *(f"return_{k}" for k in (1, 3, 5, 15))).select("symbol", "start_ns", *(f"return_{k}" for k in (1, 3, 5, 15)))


_SQ = f"{_BARS}, q AS (SELECT *, pow(ln(close / {_lagged('close', 1)}), 2) AS sq FROM bars)"


def _vol(n: int) -> str:
    w = f"OVER (PARTITION BY symbol ORDER BY start_ns ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count(sq) {w} = {n} THEN {r(f'sqrt(sum(sq) {w})')} END AS vol_{n}"


@M.add(f"{_SQ} SELECT symbol, start_ns, {_vol(5)}, {_vol(15)} FROM q")
def bar_realized_vol(spark, sf):
    return rounded(W.realized_volatility(bars(spark, sf), (5, 15)), "vol_5", "vol_15").select("symbol", "start_ns", "vol_5", "vol_15")


@M.add(f"""{_BARS}, t AS (SELECT *, {_lagged('close', 1)} AS before FROM bars), u AS (SELECT *, greatest(high - low, abs(high - before), abs(low - before)) AS tr FROM t)
SELECT symbol, start_ns, CASE WHEN count(before) OVER w = 14 THEN {r('avg(tr) OVER w / close * 10000')} END AS atr_bps FROM u WINDOW w AS (PARTITION BY symbol ORDER BY start_ns ROWS 13 PRECEDING)""")
def bar_atr(spark, sf):
    return rounded(W.true_range(bars(spark, sf), 14), "atr_bps").select("symbol", "start_ns", "atr_bps")


@M.add(f"""{_BARS} SELECT symbol, start_ns, {r('(high - low) / close * 10000')} AS range_bps, CASE WHEN avg(volume) OVER l = 0 THEN 0.0 ELSE {r('avg(volume) OVER s / avg(volume) OVER l')} END AS volume_ratio
FROM bars WINDOW s AS (PARTITION BY symbol ORDER BY start_ns ROWS 4 PRECEDING), l AS (PARTITION BY symbol ORDER BY start_ns ROWS 59 PRECEDING)""")
def bar_range_volume_ratio(spark, sf):
    return rounded(W.range_and_volume(bars(spark, sf), 5, 60), "range_bps", "volume_ratio").select("symbol", "start_ns", "range_bps", "volume_ratio")


@M.add(f"""{with_sql('ticks')}
SELECT symbol, received_at_ns, sequence, count(*) OVER w AS trade_count, (sum(size::DECIMAL(24,6)) OVER w)::DOUBLE AS base, {r('(sum((price * size)::DECIMAL(24,6)) OVER w)::DOUBLE')} AS notional,
  {r("(sum((CASE WHEN side = 'Buy' THEN size ELSE -size END)::DECIMAL(24,6)) OVER w)::DOUBLE / (sum(size::DECIMAL(24,6)) OVER w)::DOUBLE")} AS imbalance,
  CASE WHEN count(*) OVER w < 2 THEN 0.0 ELSE {r('arg_max(price, (received_at_ns, event_ts_ms, sequence)) OVER w / arg_min(price, (received_at_ns, event_ts_ms, sequence)) OVER w - 1')} END AS trade_return
FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY received_at_ns RANGE BETWEEN 21600000000000 PRECEDING AND CURRENT ROW)""")
def trailing_trade_aggregates(spark, sf):
    return rounded(W.trailing(ticks(spark, sf), BAR_NS), "notional", "imbalance", "trade_return")


@M.add(f"""{with_sql('ticks')}
SELECT symbol, received_at_ns, sequence, (sum(size::DECIMAL(24,6)) OVER w)::DOUBLE AS cum_size, {r('(sum((price * size)::DECIMAL(24,6)) OVER w)::DOUBLE', 4)} AS cum_notional, count(*) OVER w AS cum_count
FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY received_at_ns, sequence ROWS UNBOUNDED PRECEDING)""")
def prefix_sums(spark, sf):
    t = ticks(spark, sf).select("symbol", "received_at_ns", "sequence", "price", "size")
    out = W.prefix_sums(t, {"cum_size": "size", "cum_notional": "price * size", "cum_count": "1"}, ["symbol"], ["received_at_ns", "sequence"], "received_at_ns", DAY_NS)
    return rounded(out.withColumn("cum_count", F.col("cum_count").cast("long")), "cum_notional", digits=4).drop("price", "size")


@M.add(f"{with_sql('ticks')} SELECT symbol, received_at_ns // 3600000000000 AS bucket, max(price) AS high, min(price) AS low FROM ticks GROUP BY ALL")
def bucket_high_low(spark, sf):
    return B.bucket_extremes(ticks(spark, sf), HOUR_NS)


_GRID_SQL = """grid AS (
  SELECT symbol, unnest(generate_series((first_ns - 300000000000 + 21599999999999) // 21600000000000 * 21600000000000 + 300000000000, last_ns, 21600000000000)) AS decision_at_ns
  FROM (SELECT symbol, min(received_at_ns) AS first_ns, max(received_at_ns) AS last_ns FROM ticks GROUP BY symbol))"""


def grid(spark, sf):
    bounds = ticks(spark, sf).groupBy("symbol").agg(F.min("received_at_ns").alias("first_ns"), F.max("received_at_ns").alias("last_ns"))
    return W.decision_grid(bounds, BAR_NS, 300_000_000_000, "first_ns", "last_ns").select("symbol", "decision_at_ns")


@M.add(f"{with_sql('ticks')}, {_GRID_SQL} SELECT symbol, decision_at_ns FROM grid")
def decision_grid(spark, sf):
    return grid(spark, sf)


_ASOF = f"""{with_sql('ticks')}, {_GRID_SQL},
found AS (SELECT g.symbol, g.decision_at_ns, max(t.received_at_ns) AS tick_ns FROM grid g LEFT JOIN ticks t ON t.symbol = g.symbol AND t.received_at_ns <= g.decision_at_ns GROUP BY ALL)"""


@M.add(f"""{_ASOF} SELECT f.symbol, f.decision_at_ns, f.tick_ns, t.price, f.decision_at_ns - f.tick_ns AS age_ns, f.decision_at_ns - f.tick_ns <= 3600000000000 AS fresh
FROM found f LEFT JOIN (SELECT symbol, received_at_ns, arg_max(price, sequence) AS price FROM ticks GROUP BY ALL) t ON t.symbol = f.symbol AND t.received_at_ns = f.tick_ns""")
def asof_backward(spark, sf):
    t = ticks(spark, sf).select("symbol", "received_at_ns", "sequence", "price", F.col("received_at_ns").alias("tick_ns"))
    out = J.asof(grid(spark, sf), t, ["symbol"], "decision_at_ns", "received_at_ns", ["tick_ns", "price"], order=["sequence"])
    age = F.col("decision_at_ns") - F.col("tick_ns")
    return out.select("symbol", "decision_at_ns", "tick_ns", "price", age.alias("age_ns"), (age <= HOUR_NS).alias("fresh"))


@M.add(f"""{with_sql('ticks')}, {_GRID_SQL},
found AS (SELECT g.symbol, g.decision_at_ns, min(t.received_at_ns) AS tick_ns FROM grid g LEFT JOIN ticks t ON t.symbol = g.symbol AND t.received_at_ns >= g.decision_at_ns GROUP BY ALL)
SELECT f.symbol, f.decision_at_ns, f.tick_ns, t.price FROM found f LEFT JOIN (SELECT symbol, received_at_ns, arg_min(price, sequence) AS price FROM ticks GROUP BY ALL) t ON t.symbol = f.symbol AND t.received_at_ns = f.tick_ns""")
def asof_forward(spark, sf):
    t = ticks(spark, sf).select("symbol", "received_at_ns", "sequence", "price", F.col("received_at_ns").alias("tick_ns"))
    return J.asof(grid(spark, sf), t, ["symbol"], "decision_at_ns", "received_at_ns", ["tick_ns", "price"], order=["sequence"], forward=True)


@M.add(f"""{_ASOF} SELECT f.symbol, f.decision_at_ns, CASE WHEN f.decision_at_ns - f.tick_ns <= 3600000000000 THEN t.price END AS price,
  CASE WHEN f.tick_ns IS NULL THEN 'missing' WHEN f.decision_at_ns - f.tick_ns > 3600000000000 THEN 'stale' END AS reason
FROM found f LEFT JOIN (SELECT symbol, received_at_ns, arg_max(price, sequence) AS price FROM ticks GROUP BY ALL) t ON t.symbol = f.symbol AND t.received_at_ns = f.tick_ns""")
def staleness_gate(spark, sf):
    """The last price at each decision unless it is older than an hour, with the reason where there is none."""
    t = ticks(spark, sf).select("symbol", "received_at_ns", "sequence", "price")
    out = J.asof(grid(spark, sf), t, ["symbol"], "decision_at_ns", "received_at_ns", ["price"], order=["sequence"], most_age=HOUR_NS, reason="reason")
    return out.select("symbol", "decision_at_ns", "price", "reason")


@M.add(f"""{_ASOF}, q AS (SELECT f.symbol, CASE WHEN f.tick_ns IS NULL THEN 'missing' WHEN f.decision_at_ns - f.tick_ns > 3600000000000 THEN 'stale' ELSE 'usable' END AS reason FROM found f)
SELECT symbol, reason, count(*) AS n FROM q GROUP BY GROUPING SETS ((symbol, reason), (reason))""")
def reason_counters(spark, sf):
    """How many decisions each reason skips, by symbol and over all."""
    gate = staleness_gate(spark, sf).withColumn("reason", F.coalesce("reason", F.lit("usable")))
    return gate.groupingSets([["symbol", "reason"], ["reason"]], "symbol", "reason").agg(F.count("*").alias("n"))


@M.add(f"""{with_sql('tickers')}, {_GRID_SQL},
seen AS (SELECT symbol, received_at_ns, arg_max(open_interest, sequence) AS oi FROM tickers GROUP BY ALL),
found AS (SELECT g.symbol, g.decision_at_ns, max(a.received_at_ns) AS n, max(a.received_at_ns) FILTER (a.received_at_ns <= g.decision_at_ns - 21600000000000) AS b
  FROM grid g LEFT JOIN seen a ON a.symbol = g.symbol AND a.received_at_ns <= g.decision_at_ns GROUP BY ALL)
SELECT f.symbol, f.decision_at_ns, x.oi AS oi_now, y.oi AS oi_before, {r('x.oi / y.oi - 1')} AS oi_change
FROM found f LEFT JOIN seen x ON x.symbol = f.symbol AND x.received_at_ns = f.n LEFT JOIN seen y ON y.symbol = f.symbol AND y.received_at_ns = f.b""")
def asof_lagged_change(spark, sf):
    from ..bindings import tickers

    t = tickers(spark, sf).select("symbol", "received_at_ns", "sequence", F.col("open_interest").alias("oi_now"), F.col("open_interest").alias("oi_before"))
    g = grid(spark, sf).withColumn("before_ns", F.col("decision_at_ns") - BAR_NS)
    out = J.asof(g, t, ["symbol"], "decision_at_ns", "received_at_ns", ["oi_now"], order=["sequence"])
    out = J.asof(out, t.drop("oi_now"), ["symbol"], "before_ns", "received_at_ns", ["oi_before"], order=["sequence"])
    return out.select("symbol", "decision_at_ns", "oi_now", "oi_before", fixed(F.col("oi_now") / F.col("oi_before") - 1).alias("oi_change"))


@M.add(f"""{_BARS} SELECT a.symbol, a.start_ns, b.close AS anchor_close, b.volume AS anchor_volume, CASE WHEN a.symbol = 'purchase' THEN 0.0 ELSE {r('a.close - b.close')} END AS close_difference
FROM bars a LEFT JOIN bars b ON b.symbol = 'purchase' AND b.start_ns = a.start_ns""")
def anchor_context(spark, sf):
    out = J.with_anchor(bars(spark, sf), ANCHOR, "start_ns", ["close", "volume"])
    difference = F.when(F.col("symbol") == ANCHOR, 0.0).otherwise(fixed(F.col("close") - F.col("anchor_close")))
    return out.select("symbol", "start_ns", "anchor_close", "anchor_volume", difference.alias("close_difference"))


_DAY = "((event_ts_ms % 86400000) / 86400000.0::DOUBLE)"
_WEEK = "((event_ts_ms // 86400000 + 3) % 7 / 7.0::DOUBLE)"
_TURN = "6.283185307179586::DOUBLE"


@M.add(f"""{with_sql('ticks')} SELECT sequence, {r(f'sin({_TURN} * {_DAY})')} AS hour_sin, {r(f'cos({_TURN} * {_DAY})')} AS hour_cos, {r(f'sin({_TURN} * {_WEEK})')} AS weekday_sin, {r(f'cos({_TURN} * {_WEEK})')} AS weekday_cos FROM ticks""")
def calendar_features(spark, sf):
    names = ("hour_sin", "hour_cos", "weekday_sin", "weekday_cos")
    return rounded(W.calendar_features(ticks(spark, sf), "event_ts_ms"), *names).select("sequence", *names)


@M.add(f"""{with_sql('ticks')} SELECT sequence, substr(sha256(symbol || '|' || received_at_ns::VARCHAR), 1, 32) AS decision_id, sha256(symbol || '|' || received_at_ns::VARCHAR) AS long_id,
  strftime(make_timestamp(received_at_ns // 1000), '%Y-%m-%d') AS utc_date, upper(regexp_extract(session_id, '[0-9]+$')) AS session_number FROM ticks""")
def decision_ids(spark, sf):
    from ..functions.scalars import utc_date

    parts = (F.col("symbol"), F.col("received_at_ns").cast("string"))
    return ticks(spark, sf).select("sequence", identifier(*parts, length=32).alias("decision_id"), identifier(*parts).alias("long_id"), utc_date(F.col("event_ts_ms")).alias("utc_date"), F.upper(F.regexp_extract("session_id", "[0-9]+$", 0)).alias("session_number"))


def _sum(side: str, n: int) -> str:
    return f"list_sum(list_slice({side}_sizes, 1, {n}))"


def _level(n: int) -> str:
    b, a = _sum("bid", n), _sum("ask", n)
    money = " + ".join(f"list_sum(list_transform(range(1, {n + 1}), lambda i: {s}_prices[i] * {s}_sizes[i]))" for s in ("bid", "ask"))
    return f"{r(b)} AS bid_{n}, {r(a)} AS ask_{n}, {r(f'({b} - {a}) / ({b} + {a})')} AS imbalance_{n}, {r(money)} AS notional_{n}"


@M.add(f"{with_sql('books')} SELECT symbol, update_id, {_level(1)}, {_level(5)}, {_level(25)} FROM books")
def book_depth(spark, sf):
    names = [f"{c}_{n}" for n in (1, 5, 25) for c in ("bid", "ask", "imbalance", "notional")]
    return rounded(K.depth(books(spark, sf), (1, 5, 25)), *names).select("symbol", "update_id", *names)


@M.add(f"""{with_sql('books')} SELECT symbol, update_id, (bid_prices[1] + ask_prices[1]) / 2 AS mid, {r('(ask_prices[1] * bid_sizes[1] + bid_prices[1] * ask_sizes[1]) / (bid_sizes[1] + ask_sizes[1])')} AS microprice,
  {r('(ask_prices[1] - bid_prices[1]) / ((bid_prices[1] + ask_prices[1]) / 2) * 10000')} AS spread_bps FROM books""")
def book_microprice(spark, sf):
    return rounded(K.top(books(spark, sf)), "microprice", "spread_bps").select("symbol", "update_id", "mid", "microprice", "spread_bps")


@M.add(f"{with_sql('books')} SELECT update_id, bid_prices[1] AS best_bid, bid_sizes[1] AS best_bid_size, ask_prices[5] AS ask_5, ask_sizes[5] AS ask_size_5 FROM books")
def book_top_levels(spark, sf):
    b = K.levels(books(spark, sf), 5)
    e = lambda c, i, f: F.element_at(c, i)[f]
    return b.select("update_id", e("top_bids", 1, "price").alias("best_bid"), e("top_bids", 1, "size").alias("best_bid_size"), e("top_asks", 5, "price").alias("ask_5"), e("top_asks", 5, "size").alias("ask_size_5"))


@M.add(f"""{with_sql('books')}, b AS (SELECT update_id, update_id * 37 % 4000 AS age, CASE WHEN update_id % 11 = 0 THEN NULL ELSE bid_prices END AS p, bid_sizes AS s, ask_prices AS q, ask_sizes AS t, CASE WHEN update_id % 7 = 0 THEN 10 ELSE 32 END AS n FROM books)
SELECT update_id, CASE WHEN p IS NULL THEN 'missing' WHEN age > 2500 THEN 'stale' WHEN n < 32 THEN 'short' WHEN p[1] >= q[1] OR list_min(s) <= 0 OR list_min(t) <= 0 THEN 'invalid' ELSE 'ok' END AS reason FROM b""")
def book_reason_codes(spark, sf):
    u = F.col("update_id")
    b = books(spark, sf).withColumn("bid_prices", F.when(u % 11 != 0, F.slice("bid_prices", 1, F.when(u % 7 == 0, 10).otherwise(32))))
    return b.select("update_id", K.reason(32, u * 37 % 4000, 2500).alias("reason"))


@M.add(f"""{with_sql('ticks')}, m AS (SELECT symbol, side, (price * 2)::BIGINT / 2.0::DOUBLE AS price, received_at_ns, sequence, CASE WHEN sequence % 3 = 0 THEN 0.0 ELSE size END AS size FROM ticks),
l AS (SELECT symbol, side, price, arg_max(size, (received_at_ns, sequence)) AS size FROM m WHERE received_at_ns <= {SPAN[0] + 20 * DAY_NS} GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY symbol, side ORDER BY CASE WHEN side = 'Buy' THEN -price ELSE price END) AS k FROM l WHERE size > 0)
SELECT symbol, side, k::INTEGER - 1 AS level, price, size FROM n WHERE k <= 5""")
def book_rebuild(spark, sf):
    t = ticks(spark, sf).withColumn("price", F.rint(F.col("price") * 2) / 2).withColumn("size", F.when(F.col("sequence") % 3 == 0, 0.0).otherwise(F.col("size")))
    return K.rebuild(t, SPAN[0] + 20 * DAY_NS, 5).select("symbol", "side", F.posexplode("levels").alias("level", "l")).select("symbol", "side", "level", "l.price", "l.size")


@M.add(f"""{with_sql('tickers')}, w AS (SELECT symbol, sequence, received_at_ns, funding_rate, index_price FROM tickers)
SELECT symbol, sequence, last_value(funding_rate IGNORE NULLS) OVER (PARTITION BY symbol, received_at_ns // 86400000000000 ORDER BY received_at_ns, sequence ROWS UNBOUNDED PRECEDING) AS funding_rate, index_price FROM w""")
def ticker_delta_merge(spark, sf):
    from pyspark.sql import Window

    from ..bindings import tickers

    w = Window.partitionBy("symbol", div(F.col("received_at_ns"), DAY_NS)).orderBy("received_at_ns", "sequence").rowsBetween(Window.unboundedPreceding, 0)
    return tickers(spark, sf).select("symbol", "sequence", F.last("funding_rate", ignorenulls=True).over(w).alias("funding_rate"), "index_price")


@M.add(f"""{with_sql('ticks')}, f AS (SELECT user_id, received_at_ns, CASE WHEN received_at_ns - lag(received_at_ns) OVER w < 86400000000000 THEN 0 ELSE 1 END AS n FROM ticks WINDOW w AS (PARTITION BY user_id ORDER BY received_at_ns)),
s AS (SELECT user_id, received_at_ns, sum(n) OVER (PARTITION BY user_id ORDER BY received_at_ns) AS k FROM f)
SELECT user_id, min(received_at_ns) // 1000 AS start_us, count(*) AS events FROM s GROUP BY user_id, k""")
def session_windows(spark, sf):
    t = ticks(spark, sf).withColumn("at", F.timestamp_micros(div(F.col("received_at_ns"), 1000)))
    return t.groupBy("user_id", F.session_window("at", "24 hours")).agg(F.count("*").alias("events")).select("user_id", F.unix_micros("session_window.start").alias("start_us"), "events")


@M.add(f"""{with_sql('ticks')}, e AS (SELECT symbol, received_at_ns // 1000 AS us, price FROM ticks), x AS (SELECT symbol, price, unnest([us // 21600000000 * 21600000000 - 21600000000, us // 21600000000 * 21600000000]) AS start_us FROM e)
SELECT symbol, start_us, count(*) AS n, max(price) AS high FROM x GROUP BY ALL""")
def sliding_windows(spark, sf):
    t = ticks(spark, sf).withColumn("at", F.timestamp_micros(div(F.col("received_at_ns"), 1000)))
    out = t.groupBy("symbol", F.window("at", "12 hours", "6 hours")).agg(F.count("*").alias("n"), F.max("price").alias("high"))
    return out.select("symbol", F.unix_micros("window.start").alias("start_us"), "n", "high")


@M.add(f"""{_BARS} SELECT symbol, count(*) AS n_rows, {r('count(*) / 120.0::DOUBLE')} AS coverage, count(*) / 120.0::DOUBLE >= 0.95 AS passes, symbol = 'purchase' AS required FROM bars GROUP BY symbol""")
def coverage_gate(spark, sf):
    return Q.coverage(bars(spark, sf), "symbol", 120, 0.95, ANCHOR)
