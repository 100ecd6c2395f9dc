"""Gates and counters over the test tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import ANCHOR, read, ticks, with_sql
from ..operators import gates as G
from ..operators import quality as Q
from .common import Registry, r

K = Registry()

_EXECUTED = """x AS (SELECT sequence, symbol, CASE WHEN size < 20 THEN 'NO_FILL' WHEN size < 40 THEN 'PARTIAL_FILL' WHEN size < 95 THEN 'FULL_FILL' WHEN size < 98 THEN 'LOST' END AS fill_status,
  CASE WHEN price < 1002 THEN 'AMBIGUOUS' WHEN price < 1020 THEN 'TP_FIRST' WHEN price < 1060 THEN 'SL_FIRST' WHEN price < 1100 THEN 'TIMEOUT' END AS outcome,
  CASE WHEN NOT is_block THEN price - 1030 END AS outcome_return_bps FROM ticks)"""


def executed(spark, sf):
    size, price = F.col("size"), F.col("price")
    fill = F.when(size < 20, "NO_FILL").when(size < 40, "PARTIAL_FILL").when(size < 95, "FULL_FILL").when(size < 98, "LOST")
    outcome = F.when(price < 1002, "AMBIGUOUS").when(price < 1020, "TP_FIRST").when(price < 1060, "SL_FIRST").when(price < 1100, "TIMEOUT")
    return ticks(spark, sf).select("sequence", "symbol", fill.alias("fill_status"), outcome.alias("outcome"), F.when(~F.col("is_block"), price - 1030).alias("outcome_return_bps"))


@K.add(f"""{with_sql('ticks')}, {_EXECUTED} SELECT sequence, symbol, fill_status, outcome, CASE WHEN fill_status IS NULL OR fill_status NOT IN ('NO_FILL', 'PARTIAL_FILL', 'FULL_FILL') THEN 'unknown_fill'
  WHEN fill_status <> 'FULL_FILL' THEN 'usable' WHEN outcome IS NULL OR outcome NOT IN ('TP_FIRST', 'SL_FIRST', 'TIMEOUT') THEN 'ambiguous' WHEN outcome_return_bps IS NULL THEN 'unpriced' ELSE 'usable' END AS use FROM x""")
def execution_usable(spark, sf):
    return executed(spark, sf).select("sequence", "symbol", "fill_status", "outcome", G.execution_use().alias("use"))


@K.add(f"""{with_sql('ticks')}, {_EXECUTED}, w AS (SELECT symbol, 'label_no_fill' AS reason FROM x WHERE fill_status = 'NO_FILL' UNION ALL SELECT symbol, 'label_timeout' FROM x WHERE outcome = 'TIMEOUT'
  UNION ALL SELECT symbol, 'skipped_unpriced' FROM x WHERE outcome_return_bps IS NULL UNION ALL SELECT symbol, 'skipped_no_outcome' FROM x WHERE outcome IS NULL)
SELECT symbol, reason, count(*) AS n FROM w GROUP BY ALL""")
def skip_reasons(spark, sf):
    reasons = {
        "label_no_fill": F.col("fill_status") == "NO_FILL",
        "label_timeout": F.col("outcome") == "TIMEOUT",
        "skipped_unpriced": F.col("outcome_return_bps").isNull(),
        "skipped_no_outcome": F.col("outcome").isNull(),
    }
    return G.reason_counts(executed(spark, sf), ["symbol"], reasons)


@K.add(f"""{with_sql('ticks')} SELECT sequence, size, price FROM ticks""")
def profile_without_calendar(spark, sf):
    t = ticks(spark, sf).withColumns({c: F.lit(0.0) for c in G.CALENDAR})
    return t.select("sequence", *G.feature_profile(["size", *G.CALENDAR, "price"], "no_calendar"))


@K.add(f"""{with_sql('ticks')}, s AS (SELECT symbol, price - 1002 AS price, size - 3 AS size, CASE WHEN is_rpi THEN 'None' ELSE side END AS side FROM ticks), c AS (
  SELECT symbol, count(*) AS n, count(*) FILTER (price <= 0 OR price IS NULL) AS bad_price, count(*) FILTER (size <= 0 OR size IS NULL) AS bad_size, count(*) FILTER (side NOT IN ('Buy', 'Sell')) AS bad_side FROM s GROUP BY symbol)
SELECT *, bad_price + bad_size + bad_side = 0 AS valid FROM c""")
def series_validity(spark, sf):
    t = ticks(spark, sf).withColumns({"price": F.col("price") - 1002, "size": F.col("size") - 3, "side": F.when(F.col("is_rpi"), "None").otherwise(F.col("side"))})
    return G.series_gate(t, ["symbol"])


@K.add(f"""{with_sql('ticks')}, c AS (SELECT symbol, count(*) AS n FROM ticks GROUP BY symbol) SELECT count(*) AS symbols, count(*) FILTER (n / 1500.0 >= 0.95) AS passing, bool_or(symbol = '{ANCHOR}' AND n / 1500.0 >= 0.95) AS anchor_passes,
  count(*) FILTER (n / 1500.0 >= 0.95) >= 2 AND bool_or(symbol = '{ANCHOR}' AND n / 1500.0 >= 0.95) AS accepted FROM c""")
def symbol_gate(spark, sf):
    return G.symbol_gate(Q.coverage(ticks(spark, sf), "symbol", 1500, 0.95, ANCHOR), "symbol")


@K.add("""SELECT coalesce(a.path, c.path) AS path, CASE WHEN c.path IS NULL THEN 'missing' WHEN a.path IS NULL THEN 'unexpected' ELSE 'changed' END AS kind
FROM (SELECT o_orderkey AS path, o_orderstatus AS status FROM orders WHERE o_totalprice > 100000) a
FULL JOIN (SELECT o_orderkey AS path, CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS status FROM orders WHERE o_totalprice < 300000) c ON a.path = c.path
WHERE a.path IS NULL OR c.path IS NULL OR a.status IS DISTINCT FROM c.status""")
def candidate_differences(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_orderstatus").alias("status"), "o_totalprice", "o_orderpriority")
    changed = F.when(F.col("o_orderpriority") == "1-URGENT", "F").otherwise(F.col("status"))
    return G.differences(o.where("o_totalprice > 100000"), o.where("o_totalprice < 300000").withColumn("status", changed), "path", ["status"])


@K.add("""WITH l AS (SELECT DISTINCT o_custkey AS k FROM orders), s AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0), j AS (SELECT l.k AS lk, s.k AS sk FROM l FULL JOIN s ON l.k = s.k)
SELECT count(*) FILTER (sk IS NULL) AS left_only, count(*) FILTER (lk IS NULL) AS right_only, count(*) FILTER (lk = sk) AS common, count(*) FILTER (sk IS NULL OR lk IS NULL) = 0 AS equal FROM j""")
def universe_equality(spark, sf):
    left = read(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return G.same_universe(left, read(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@K.add("SELECT event_id, event_type, value FROM events")
def disjoint_batches(spark, sf):
    e = read(spark, sf, "events").select("event_id", "event_type", "value")
    kinds = [r_[0] for r_ in e.select("event_type").distinct().orderBy("event_type").collect()]
    return G.disjoint_union([e.where(F.col("event_type") == k) for k in kinds], ["event_id"])


@K.add("""WITH c AS (SELECT ts::DATE AS date, count(*) >= 100 AS complete, CASE WHEN ts::DATE < DATE '2024-01-20' THEN 1 ELSE 2 END AS version FROM events WHERE ts::DATE <> DATE '2024-01-05' GROUP BY ALL),
d AS (SELECT unnest(generate_series(DATE '2024-01-03', DATE '2024-01-25', INTERVAL 1 DAY))::DATE AS date), k AS (SELECT * FROM c WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25')
SELECT d.date::VARCHAR AS date, CASE WHEN k.date IS NULL THEN 'missing' WHEN NOT complete THEN 'incomplete' WHEN version <> (SELECT arg_min(version, date) FROM k) THEN 'other_parameters' ELSE 'selected' END AS verdict FROM d LEFT JOIN k ON k.date = d.date""")
def day_selection(spark, sf):
    date = F.to_date("ts")
    days = read(spark, sf, "events").where(date != F.lit("2024-01-05").cast("date")).groupBy(date.alias("date")).agg((F.count("*") >= 100).alias("complete"))
    days = days.withColumn("version", F.when(F.col("date") < F.lit("2024-01-20").cast("date"), 1).otherwise(2))
    return G.select_days(days, "2024-01-03", "2024-01-25", ["version"]).withColumn("date", F.col("date").cast("string"))


@K.add(f"""{with_sql('ticks')}, c AS (SELECT *, coalesce(received_at_ns >= max(received_at_ns) OVER (PARTITION BY symbol, user_id % 10 ORDER BY sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS causal, user_id % 10 AS day FROM ticks),
g AS (SELECT *, event_ts_ms - lag(event_ts_ms) OVER (PARTITION BY symbol, day ORDER BY sequence) AS gap FROM c WHERE causal), h AS (SELECT symbol, day, max(gap) AS gap FROM g GROUP BY ALL)
SELECT c.symbol, c.day, count(*) AS records, count(*) AS events, count(DISTINCT session_id) AS files, sum(size)::BIGINT AS bytes, {r('(max(event_ts_ms) - min(event_ts_ms)) / 1000.0::DOUBLE', 3)} AS duration_seconds,
  greatest(coalesce(any_value(h.gap), 0), 0) AS max_gap_ms FROM c LEFT JOIN h ON h.symbol = c.symbol AND h.day = c.day GROUP BY c.symbol, c.day""")
def stream_audit(spark, sf):
    t = ticks(spark, sf).withColumns({"day": F.col("user_id") % 10, "size": F.col("size").cast("long")})
    return G.stream_audit(t, ["symbol", "day"], "event_ts_ms", "received_at_ns", ["sequence"], "session_id", "size")


@K.add(f"""{with_sql('ticks')}, b AS (SELECT CASE WHEN size / 4 < 2 THEN 'below_2' WHEN size / 4 < 5 THEN '2_to_5' WHEN size / 4 < 10 THEN '5_to_10' WHEN size / 4 < 20 THEN '10_to_20' ELSE '20_plus' END AS bin, price - 1030 AS pnl FROM ticks WHERE size < 60)
SELECT g.bin, count(b.bin) AS n, {r('avg(pnl)')} AS mean_bps, {r('count(*) FILTER (pnl > 0) / nullif(count(b.bin), 0)::DOUBLE')} AS win_rate
FROM (SELECT unnest(['below_2', '2_to_5', '5_to_10', '10_to_20', '20_plus']) AS bin) g LEFT JOIN b ON b.bin = g.bin GROUP BY g.bin""")
def expected_bin_labels(spark, sf):
    t = ticks(spark, sf).where("size < 60")  # the bin of the highest is empty and listed
    return G.expected_bins(t.select((F.col("size") / 4).alias("net"), (F.col("price") - 1030).alias("pnl")), "net", "pnl")
