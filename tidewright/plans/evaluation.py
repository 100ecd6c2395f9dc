"""Splits, metrics, expectations, picks, replays and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..bindings import HOUR_NS, read, ticks, with_sql
from ..functions.scalars import fixed
from ..operators import evaluate as E
from ..operators import joins as J
from ..operators import replay as Y
from .common import Registry, r

V = Registry()
DAY_NS = 24 * HOUR_NS
#: Width of a test window, least training time, embargo, calibration.
_FOLDS = (3 * DAY_NS, 12 * DAY_NS, DAY_NS, 2 * DAY_NS)

_FOLDS_SQL = f"""b AS (SELECT min(received_at_ns) AS f, max(received_at_ns) AS l FROM ticks), n AS (SELECT f, (l - f - {_FOLDS[1]}) // {_FOLDS[0]} AS n FROM b),
folds AS (SELECT (i - greatest(n - 4, 0) + 1)::INTEGER AS fold, f + {_FOLDS[1]} + i * {_FOLDS[0]} AS test_start_ns, f + {_FOLDS[1]} + (i + 1) * {_FOLDS[0]} AS test_end_ns
  FROM (SELECT f, n, unnest(range(greatest(n - 4, 0), n)) AS i FROM n))"""


def folds(spark, sf):
    bounds = ticks(spark, sf).agg(F.min("received_at_ns").alias("first_ns"), F.max("received_at_ns").alias("last_ns"))
    return E.folds(bounds, _FOLDS[0], _FOLDS[1], 4)


@V.add(f"{with_sql('ticks')}, {_FOLDS_SQL} SELECT * FROM folds")
def temporal_folds(spark, sf):
    return folds(spark, sf)


def _labelled(spark, sf):
    return ticks(spark, sf).select("sequence", "symbol", F.col("received_at_ns").alias("decision_at_ns"), (F.col("received_at_ns") + 12 * HOUR_NS).alias("label_end_ns"))


@V.add(f"""{with_sql('ticks')}, {_FOLDS_SQL}, x AS (SELECT fold, CASE WHEN received_at_ns >= test_start_ns AND received_at_ns < test_end_ns THEN 'test' WHEN received_at_ns + 43200000000000 <= test_start_ns - {_FOLDS[2]} THEN 'train' END AS part FROM ticks, folds)
SELECT fold, part, count(*) AS n FROM x WHERE part IS NOT NULL GROUP BY ALL""")
def purged_membership(spark, sf):
    return E.membership(_labelled(spark, sf), folds(spark, sf), "decision_at_ns", "label_end_ns", _FOLDS[2]).groupBy("fold", "part").agg(F.count("*").alias("n"))


@V.add(f"""{with_sql('ticks')}, {_FOLDS_SQL}, x AS (SELECT fold, CASE WHEN received_at_ns >= test_start_ns AND received_at_ns < test_end_ns THEN 'test'
  WHEN received_at_ns >= test_start_ns - {_FOLDS[2] + _FOLDS[3]} AND received_at_ns + 43200000000000 <= test_start_ns - {_FOLDS[2]} THEN 'calibration' WHEN received_at_ns + 43200000000000 <= test_start_ns - {2 * _FOLDS[2] + _FOLDS[3]} THEN 'fit' END AS part FROM ticks, folds)
SELECT fold, part, count(*) AS n FROM x WHERE part IS NOT NULL GROUP BY ALL""")
def nested_calibration(spark, sf):
    return E.membership(_labelled(spark, sf), folds(spark, sf), "decision_at_ns", "label_end_ns", _FOLDS[2], _FOLDS[3]).groupBy("fold", "part").agg(F.count("*").alias("n"))


@V.add(f"""{with_sql('ticks')}, n AS (SELECT sequence, row_number() OVER (ORDER BY received_at_ns, sequence) - 1 AS place, count(*) OVER () AS n FROM ticks),
w AS (SELECT DISTINCT i * (n - 1) // 499 AS place FROM (SELECT DISTINCT n FROM n), range(500) t(i)) SELECT sequence FROM n JOIN w USING (place)""")
def time_uniform_sample(spark, sf):
    return E.uniform_sample(ticks(spark, sf).select("received_at_ns", "sequence"), ["received_at_ns", "sequence"], 500).select("sequence")


#: Candidates: prints with made-up probabilities of the three outcomes, for both sides.
_CANDS = """cands AS (
  SELECT sequence, received_at_ns // 3600000000000 * 3600000000000 AS decision_at_ns, symbol, s.side, (sequence * 7 + s.k) % 3 AS y, user_id % 3 AS model,
    (1 + (sequence * 13 + s.k * 5) % 17)::DOUBLE AS a, (1 + (sequence * 29 + s.k * 3) % 19)::DOUBLE AS b, (1 + (sequence * 31 + s.k) % 23)::DOUBLE AS c, 25.0::DOUBLE + sequence % 200 AS stop, (sequence % 41 - 20)::DOUBLE AS funding
  FROM ticks, (VALUES ('LONG', 1), ('SHORT', 2)) s(side, k)),
probs AS (SELECT *, a / (a + b + c) AS p0, b / (a + b + c) AS p1, c / (a + b + c) AS p2 FROM cands)"""


def cands(spark, sf):
    t = ticks(spark, sf).drop("side").withColumn("s", F.explode(F.array(F.struct(F.lit("LONG").alias("side"), F.lit(1).alias("k")), F.struct(F.lit("SHORT").alias("side"), F.lit(2).alias("k")))))
    n, k = F.col("sequence"), F.col("s.k")
    part = lambda m, q, by: (1 + (n * m + k * q) % by).cast("double")
    t = t.select(
        "sequence", F.expr("received_at_ns div 3600000000000 * 3600000000000").alias("decision_at_ns"), "symbol", "s.side", ((n * 7 + k) % 3).cast("int").alias("y"), (F.col("user_id") % 3).alias("model"),
        part(13, 5, 17).alias("a"), part(29, 3, 19).alias("b"), part(31, 1, 23).alias("c"), (F.lit(25.0) + n % 200).alias("stop"), (n % 41 - 20).cast("double").alias("funding"),
    )
    whole = F.col("a") + F.col("b") + F.col("c")
    return t.withColumn("probabilities", F.array(*(F.col(x) / whole for x in "abc")))


@V.add(f"{with_sql('ticks')}, {_CANDS} SELECT y::INTEGER AS y, count(*) AS n, {r('count(*) / (sum(count(*)) OVER ())::DOUBLE')} AS share, {r('(count(*) + 1) / ((sum(count(*)) OVER ())::DOUBLE + 3)')} AS smoothed FROM cands GROUP BY y")
def class_prior(spark, sf):
    out = E.class_prior(cands(spark, sf), "y", 3)
    return out.select("y", "n", fixed(F.col("share")).alias("share"), fixed(F.col("smoothed")).alias("smoothed"))


_P_Y = "CASE y WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END"


@V.add(f"""{with_sql('ticks')}, {_CANDS} SELECT symbol, {r(f'avg(-ln({_P_Y}))')} AS log_loss, {r("avg(pow(p0 - (y = 0)::INTEGER, 2) + pow(p1 - (y = 1)::INTEGER, 2) + pow(p2 - (y = 2)::INTEGER, 2))")} AS brier,
  {r("avg((CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END = y)::INTEGER)")} AS accuracy, count(*) AS n FROM probs GROUP BY symbol""")
def log_loss_brier(spark, sf):
    out = E.metrics(cands(spark, sf), ["symbol"])
    return out.select("symbol", *(fixed(F.col(c)).alias(c) for c in ("log_loss", "brier", "accuracy")), "n")


@V.add(f"""{with_sql('ticks')}, {_CANDS}, t AS (SELECT *, greatest(p0, p1, p2) AS m FROM probs) SELECT least(floor(m * 10), 9)::INTEGER AS bin, count(*) AS n, {r('avg(m)')} AS confidence,
  {r("avg((CASE WHEN p0 = m THEN 0 WHEN p1 = m THEN 1 ELSE 2 END = y)::INTEGER)")} AS accuracy FROM t GROUP BY ALL""")
def ece_bins(spark, sf):
    out = E.confidence_bins(cands(spark, sf))
    return out.select("bin", "n", fixed(F.col("confidence")).alias("confidence"), fixed(F.col("accuracy")).alias("accuracy"))


_PRIOR = (0.3, 0.4, 0.3)
# The calibration grid, stated apart from the operator's.
_TEMPERATURES = "(0.5::DOUBLE), (0.75::DOUBLE), (1::DOUBLE), (1.25::DOUBLE), (1.5::DOUBLE), (2::DOUBLE), (3::DOUBLE), (5::DOUBLE)"
_WEIGHTS = "(0::DOUBLE), (0.1::DOUBLE), (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE)"


def _mixed(i: int) -> str:
    return f"((1 - w) * pow(p{i}, 1 / t) / (pow(p0, 1 / t) + pow(p1, 1 / t) + pow(p2, 1 / t)) + w * {_PRIOR[i]})"


@V.add(f"""{with_sql('ticks')}, {_CANDS} SELECT t AS temperature, w AS weight, {r(f'avg(-ln(CASE y WHEN 0 THEN {_mixed(0)} WHEN 1 THEN {_mixed(1)} ELSE {_mixed(2)} END))')} AS log_loss
FROM probs, (VALUES {_TEMPERATURES}) g(t), (VALUES {_WEIGHTS}) h(w) GROUP BY ALL""")
def temperature_calibration_grid(spark, sf):
    out = E.calibration_grid(cands(spark, sf), 3, F.array(*(F.lit(p) for p in _PRIOR)))
    return out.withColumn("log_loss", fixed(F.col("log_loss")))


@V.add(f"""{with_sql('ticks')}, {_CANDS}, g AS (SELECT t AS temperature, w AS weight, avg(-ln(CASE y WHEN 0 THEN {_mixed(0)} WHEN 1 THEN {_mixed(1)} ELSE {_mixed(2)} END)) AS log_loss
FROM probs, (VALUES {_TEMPERATURES}) g(t), (VALUES {_WEIGHTS}) h(w) GROUP BY ALL)
SELECT temperature, weight, {r('log_loss')} AS log_loss FROM g ORDER BY g.log_loss + CASE WHEN temperature = 1 AND weight = 0 THEN 0 ELSE 1e-15::DOUBLE END, NOT (temperature = 1 AND weight = 0), temperature, weight LIMIT 1""")
def best_calibration(spark, sf):
    grid = E.calibration_grid(cands(spark, sf), 3, F.array(*(F.lit(p) for p in _PRIOR)))
    return E.best_calibration(grid).withColumn("log_loss", fixed(F.col("log_loss")))


@V.add(f"""{with_sql('ticks')}, {_CANDS}, s AS (SELECT symbol, side, a AS v FROM cands),
f AS (SELECT symbol, side, avg(v) AS m FROM s GROUP BY ALL HAVING count(*) >= 150), d AS (SELECT side, avg(v) AS m FROM s GROUP BY ALL), w AS (SELECT avg(v) AS m FROM s),
u AS (SELECT DISTINCT symbol, side FROM cands)
SELECT u.symbol, u.side, {r('coalesce(f.m, d.m, w.m)')} AS estimate FROM u LEFT JOIN f USING (symbol, side) LEFT JOIN d USING (side), w""")
def hierarchical_means(spark, sf):
    c = cands(spark, sf)
    out = J.fallback(c.select("symbol", "side").distinct(), c, "a", ["symbol", "side"], 150)
    return out.withColumn("estimate", fixed(F.col("estimate")))


_NET = "(p0 * stop * 1.5 - p1 * stop + p2 * 2) - (2 + p0 * 2 + (p1 + p2) * 5.5) - (1 + p1 * 3 + p2 * 1) - p2 * greatest(funding, 0)"


def _scored(spark, sf):
    c = cands(spark, sf)
    p = [F.element_at("probabilities", i) for i in (1, 2, 3)]
    return c.withColumn("net", fixed(E.expected_net_bps(*p, F.col("stop") * 1.5, F.col("stop"), F.lit(2.0), F.col("funding"))))


@V.add(f"{with_sql('ticks')}, {_CANDS} SELECT sequence, side, {r(_NET)} AS net FROM probs")
def expected_net(spark, sf):
    return _scored(spark, sf).select("sequence", "side", "net")


@V.add(f"{with_sql('ticks')}, {_CANDS} SELECT sequence, side, {r(f'p0 * ({r(_NET)}) - p1 * 8.5')} AS net FROM probs")
def expected_net_execution(spark, sf):
    p = [F.element_at("probabilities", i) for i in (1, 2)]
    return _scored(spark, sf).select("sequence", "side", fixed(E.expected_execution_bps(*p, F.col("net"), F.lit(8.5))).alias("net"))


@V.add(f"{with_sql('ticks')}, {_CANDS} SELECT sequence, side, {r('least(0.05::DOUBLE, 0.007::DOUBLE / ((stop + 11.5) / 10000))')} AS fraction FROM cands")
def position_size(spark, sf):
    return cands(spark, sf).select("sequence", "side", fixed(E.position_fraction(F.col("stop") + 11.5)).alias("fraction"))


@V.add(f"{with_sql('ticks')}, {_CANDS} SELECT sequence, side, {r('3 + CASE WHEN y = 0 THEN 2 ELSE 5.5 END + CASE y WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 0 END + CASE WHEN sequence % 3 = 0 THEN funding ELSE 0 END')} AS costs FROM cands")
def realized_costs(spark, sf):
    c = cands(spark, sf).withColumn("outcome", F.element_at(F.array(*(F.lit(x) for x in E.CLASSES)), F.col("y") + 1))
    return c.select("sequence", "side", fixed(E.realized_costs(F.col("outcome"), F.col("sequence") % 3 == 0, F.col("funding"))).alias("costs"))


_PICKS = f"""scored AS (SELECT *, {r(_NET)} AS net FROM probs),
ranked AS (SELECT *, row_number() OVER w AS k, lead(net) OVER w AS second, count(*) OVER d AS candidates, count(*) FILTER (net >= 1) OVER d AS eligible FROM scored
  WINDOW w AS (PARTITION BY model, decision_at_ns ORDER BY net DESC, symbol, side, sequence), d AS (PARTITION BY model, decision_at_ns)),
picks AS (SELECT model, decision_at_ns, symbol, side, sequence, net, y, stop, funding, candidates, eligible, CASE WHEN second >= 1 THEN net - second END AS margin FROM ranked WHERE k = 1 AND net >= 1)"""


def picks(spark, sf):
    s = _scored(spark, sf).select("model", "decision_at_ns", "symbol", "side", "sequence", "net", "y", "stop", "funding")
    return E.top_candidates(s, ["model", "decision_at_ns"], "net", 1.0, [F.col("symbol"), F.col("side"), F.col("sequence")])


@V.add(f"{with_sql('ticks')}, {_CANDS}, {_PICKS} SELECT model, decision_at_ns, symbol, side, sequence, net, candidates, eligible, {r('margin')} AS margin FROM picks")
def top_candidate_per_decision(spark, sf):
    return picks(spark, sf).select("model", "decision_at_ns", "symbol", "side", "sequence", "net", "candidates", "eligible", fixed(F.col("margin")).alias("margin"))


_LEDGER = """input AS (SELECT model, decision_at_ns, decision_at_ns + (1 + sequence % 9) * 3600000000000 AS exit_at_ns, least(0.05::DOUBLE, 0.007::DOUBLE / ((stop + 11.5) / 10000)) AS size,
    (CASE y WHEN 0 THEN stop * 1.5 WHEN 1 THEN -stop ELSE 2 END - 8.5)::DOUBLE AS pnl_bps, row_number() OVER (PARTITION BY model ORDER BY decision_at_ns) AS k FROM picks),
fold AS (
  SELECT model, k, decision_at_ns, exit_at_ns, size, pnl_bps, true AS taken, exit_at_ns AS until, 1 + size * pnl_bps / 10000 AS equity, [(exit_at_ns, size * pnl_bps / 10000)] AS recent FROM input WHERE k = 1
  UNION ALL
  SELECT i.model, i.k, i.decision_at_ns, i.exit_at_ns, i.size, i.pnl_bps, g.go, CASE WHEN g.go THEN i.exit_at_ns ELSE f.until END, CASE WHEN g.go THEN f.equity * (1 + i.size * i.pnl_bps / 10000) ELSE f.equity END,
    CASE WHEN g.go THEN list_append(list_filter(f.recent, lambda x: x[1] >= i.decision_at_ns - 86400000000000), (i.exit_at_ns, i.size * i.pnl_bps / 10000)) ELSE f.recent END
  FROM fold f JOIN input i ON i.model = f.model AND i.k = f.k + 1,
    LATERAL (SELECT i.decision_at_ns >= f.until AND coalesce(list_sum(list_transform(list_filter(f.recent, lambda x: x[1] >= i.decision_at_ns - 86400000000000), lambda x: x[2])), 0) > -0.01 AS go) g)"""
_REPLAY = f"{with_sql('ticks').replace('WITH ', 'WITH RECURSIVE ', 1)}, {_CANDS}, {_PICKS}, {_LEDGER}"


def _ledger_input(spark, sf):
    pnl = F.when(F.col("y") == 0, F.col("stop") * 1.5).when(F.col("y") == 1, -F.col("stop")).otherwise(2.0) - 8.5
    return picks(spark, sf).select("model", "decision_at_ns", (F.col("decision_at_ns") + (1 + F.col("sequence") % 9) * HOUR_NS).alias("exit_at_ns"), E.position_fraction(F.col("stop") + 11.5).alias("size"), pnl.alias("pnl_bps"))


@V.add(f"{_REPLAY} SELECT model, decision_at_ns, exit_at_ns, {r('size')} AS size, pnl_bps, {r('equity')} AS equity FROM fold WHERE taken")
def one_position_replay(spark, sf):
    out = Y.one_position(_ledger_input(spark, sf), "model")
    return out.withColumns({"size": fixed(F.col("size")), "equity": fixed(F.col("equity"))})


@V.add(f"""{_REPLAY}, e AS (SELECT model, decision_at_ns, equity, greatest(1, max(equity) OVER (PARTITION BY model ORDER BY decision_at_ns ROWS UNBOUNDED PRECEDING)) AS peak FROM fold WHERE taken)
SELECT model, decision_at_ns, {r('peak')} AS peak, {r('1 - equity / peak')} AS drawdown FROM e""")
def drawdown_curve(spark, sf):
    out = Y.drawdown(Y.one_position(_ledger_input(spark, sf), "model"), "model")
    return out.select("model", "decision_at_ns", fixed(F.col("peak")).alias("peak"), fixed(F.col("drawdown")).alias("drawdown"))


_SUMMARY = f"""count(*) AS trades, {r('avg(pnl_bps)')} AS mean_bps, {r('avg((pnl_bps > 0)::INTEGER)')} AS win_rate, {r('sum(greatest(pnl_bps, 0)) / nullif(sum(greatest(-pnl_bps, 0)), 0)')} AS profit_factor,
  {r('exp(sum(ln(1 + size * pnl_bps / 10000))) - 1')} AS equity_return"""


def _summarized(df):
    return df.withColumns({c: fixed(F.col(c)) for c in ("mean_bps", "win_rate", "profit_factor", "equity_return")})


@V.add(f"{_REPLAY} SELECT model, {_SUMMARY} FROM fold WHERE taken GROUP BY model")
def trade_summary(spark, sf):
    out = Y.one_position(_ledger_input(spark, sf), "model").withColumn("ret", F.col("size") * F.col("pnl_bps") / 10_000)
    return _summarized(out.groupBy("model").agg(*E.summary(out, ["model"], "pnl_bps", "ret")))


@V.add(f"{with_sql('ticks')}, {_CANDS}, {_PICKS}, l AS (SELECT *, 0.01::DOUBLE AS size, (CASE y WHEN 0 THEN stop * 1.5 WHEN 1 THEN -stop ELSE 2 END)::DOUBLE AS pnl_bps FROM picks) SELECT symbol, side, {_SUMMARY} FROM l GROUP BY GROUPING SETS ((symbol), (side), ())")
def breakdown_grouping_sets(spark, sf):
    pnl = F.when(F.col("y") == 0, F.col("stop") * 1.5).when(F.col("y") == 1, -F.col("stop")).otherwise(2.0)
    rows = picks(spark, sf).withColumn("pnl_bps", pnl).withColumn("ret", 0.01 * F.col("pnl_bps") / 10_000)
    return _summarized(rows.groupingSets([["symbol"], ["side"], []], "symbol", "side").agg(*E.summary(rows, [], "pnl_bps", "ret")))


@V.add(f"""{with_sql('ticks')}, {_CANDS}, {_PICKS}, b AS (SELECT (net >= 20)::INTEGER + (net >= 40)::INTEGER + (net >= 80)::INTEGER + (net >= 9999)::INTEGER AS bin, net FROM picks)
SELECT g.bin, count(b.bin) AS n, {r('avg(b.net)')} AS mean_net FROM (SELECT unnest(range(5))::INTEGER AS bin) g LEFT JOIN b ON b.bin = g.bin GROUP BY g.bin""")
def expected_bins(spark, sf):
    b = picks(spark, sf).select(E.binned(F.col("net"), (20, 40, 80, 9999)).alias("bin"), "net").groupBy("bin").agg(F.count("*").alias("n"), F.avg("net").alias("m"))
    listed = spark.range(5).select(F.col("id").cast("int").alias("bin"))
    return listed.join(b, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), fixed(F.col("m")).alias("mean_net"))


@V.add(f"""{with_sql('ticks')}, {_CANDS}, {_PICKS}, d AS (SELECT model, ntile(10) OVER (PARTITION BY model ORDER BY net, decision_at_ns) AS decile, net FROM picks)
SELECT model, decile, count(*) AS n, {r('avg(net)')} AS mean_net FROM d GROUP BY model, decile""")
def expected_deciles(spark, sf):
    """Deciles of every model's picks. A ledger holds one pick a decision: the fold's output, not the corpus."""
    p = picks(spark, sf).withColumn("decile", F.ntile(10).over(Window.partitionBy("model").orderBy("net", "decision_at_ns")).cast("long"))
    return p.groupBy("model", "decile").agg(F.count("*").alias("n"), fixed(F.avg("net")).alias("mean_net"))


@V.add(f"""{with_sql('ticks')}, {_CANDS}, k AS (SELECT a, stop, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0::DOUBLE AS ra, rank() OVER (ORDER BY stop) + (count(*) OVER (PARTITION BY stop) - 1) / 2.0::DOUBLE AS rs FROM cands)
SELECT count(*) AS n, {r('corr(a, stop)')} AS pearson, {r('corr(ra, rs)')} AS spearman FROM k""")
def spearman_pearson(spark, sf):
    out = E.rank_correlation(cands(spark, sf).select("a", "stop"), "a", "stop")
    return out.select("n", fixed(F.col("pearson")).alias("pearson"), fixed(F.col("spearman")).alias("spearman"))


@V.add(f"""WITH m AS (SELECT p_brand || p_type AS feature, avg(p_retailprice) AS v FROM part GROUP BY ALL) SELECT feature, {r('v / sum(v) OVER ()', 9)} AS importance FROM m ORDER BY v / sum(v) OVER () DESC, feature LIMIT 25""")
def importance_topk(spark, sf):
    p = read(spark, sf, "part").select(F.concat("p_brand", "p_type").alias("feature"), "p_retailprice")
    return E.importance(p, "feature", "p_retailprice").withColumn("importance", fixed(F.col("importance"), 9))


_THROTTLE = with_sql("ticks").replace("WITH ", "WITH RECURSIVE ", 1)


@V.add(f"""{_THROTTLE}, e AS (SELECT symbol, received_at_ns, row_number() OVER (PARTITION BY symbol ORDER BY received_at_ns) AS k FROM ticks),
g AS (SELECT symbol, k, received_at_ns, received_at_ns AS last, true AS emitted FROM e WHERE k = 1
  UNION ALL SELECT e.symbol, e.k, e.received_at_ns, CASE WHEN e.received_at_ns - g.last >= 7200000000000 THEN e.received_at_ns ELSE g.last END, e.received_at_ns - g.last >= 7200000000000 FROM g JOIN e ON e.symbol = g.symbol AND e.k = g.k + 1)
SELECT symbol, received_at_ns FROM g WHERE emitted""")
def greedy_throttle(spark, sf):
    return Y.throttle(ticks(spark, sf), "symbol", "received_at_ns", 2 * HOUR_NS)


@V.add(f"""{with_sql('ticks')}, {_CANDS} SELECT sequence, side, {r('ln(1 + a)')} AS log_a, CASE WHEN side = 'LONG' THEN 1 ELSE -1 END AS side_code, (symbol = 'click')::INTEGER AS is_click, (symbol = 'purchase')::INTEGER AS is_purchase FROM cands WHERE y <> 2""")
def model_matrix(spark, sf):
    c = cands(spark, sf).where("y <> 2")
    return c.select("sequence", "side", fixed(F.log1p("a")).alias("log_a"), F.when(F.col("side") == "LONG", 1).otherwise(-1).alias("side_code"), *((F.col("symbol") == s).cast("int").alias(f"is_{s}") for s in ("click", "purchase")))


_FILL = "CASE sequence % 3 WHEN 0 THEN 'FULL_FILL' WHEN 1 THEN 'PARTIAL_FILL' ELSE 'NO_FILL' END"
_EXECUTION = _REPLAY.replace("decision_at_ns + (1 + sequence % 9) * 3600000000000 AS exit_at_ns", "decision_at_ns + CASE WHEN sequence % 3 = 0 THEN (1 + sequence % 9) * 3600000000000 ELSE 1800000000000 END AS exit_at_ns").replace(
    "least(0.05::DOUBLE, 0.007::DOUBLE / ((stop + 11.5) / 10000)) AS size", "least(0.05::DOUBLE, 0.007::DOUBLE / ((stop + 11.5) / 10000)) * (CASE WHEN sequence % 3 = 1 THEN 0.4::DOUBLE ELSE 1 END) AS size"
).replace("(CASE y WHEN 0 THEN stop * 1.5 WHEN 1 THEN -stop ELSE 2 END - 8.5)::DOUBLE AS pnl_bps", "(CASE sequence % 3 WHEN 0 THEN CASE y WHEN 0 THEN stop * 1.5 WHEN 1 THEN -stop ELSE 2 END - 8.5 WHEN 1 THEN -12 ELSE 0 END)::DOUBLE AS pnl_bps")


def _execution(spark, sf):
    p = picks(spark, sf)
    n = F.col("sequence") % 3
    pnl = F.when(F.col("y") == 0, F.col("stop") * 1.5).when(F.col("y") == 1, -F.col("stop")).otherwise(2.0) - 8.5
    rows = p.select(
        "model", "decision_at_ns", (F.col("decision_at_ns") + (1 + F.col("sequence") % 9) * HOUR_NS).alias("exit_at_ns"), (F.col("decision_at_ns") + HOUR_NS // 2).alias("expires_at_ns"),
        F.when(n == 0, "FULL_FILL").when(n == 1, "PARTIAL_FILL").otherwise("NO_FILL").alias("fill_status"), F.lit(0.4).alias("fill_fraction"), F.lit(12.0).alias("unwind_bps"),
        E.position_fraction(F.col("stop") + 11.5).alias("size"), pnl.alias("pnl_bps"),
    )
    return Y.one_position(Y.execution_picks(rows, "model"), "model")


@V.add(f"{_EXECUTION} SELECT model, decision_at_ns, exit_at_ns, {r('size')} AS size, pnl_bps, {r('equity')} AS equity FROM fold WHERE taken")
def execution_replay(spark, sf):
    return _execution(spark, sf).withColumns({"size": fixed(F.col("size")), "equity": fixed(F.col("equity"))})


@V.add(f"{_EXECUTION} SELECT model, count(*) AS attempts, count(*) FILTER (pnl_bps <> 0) AS positions, {r('count(*) FILTER (pnl_bps > 0) / (count(*) FILTER (pnl_bps <> 0))::DOUBLE')} AS win_rate FROM fold WHERE taken GROUP BY model")
def execution_win_rate(spark, sf):
    return Y.win_rate_of_positions(_execution(spark, sf), "model").withColumn("win_rate", fixed(F.col("win_rate")))


@V.add(f"""{with_sql('ticks')}, {_CANDS}, f AS (SELECT *, {_FILL} AS status FROM cands) SELECT status, symbol, side, count(*) AS attempts, {r('avg(stop)')} AS mean_stop, {r('sum(a)')} AS total
FROM f GROUP BY GROUPING SETS ((status), (symbol), (side), (symbol, side), ())""")
def attempt_breakdown(spark, sf):
    n = F.col("sequence") % 3
    c = cands(spark, sf).withColumn("status", F.when(n == 0, "FULL_FILL").when(n == 1, "PARTIAL_FILL").otherwise("NO_FILL"))
    sets = [["status"], ["symbol"], ["side"], ["symbol", "side"], []]
    return c.groupingSets(sets, "status", "symbol", "side").agg(F.count("*").alias("attempts"), fixed(F.avg("stop")).alias("mean_stop"), fixed(F.sum("a")).alias("total"))


@V.add(f"""{with_sql('ticks')}, {_CANDS}, o AS (SELECT sequence, CASE WHEN sequence % 11 = 0 THEN 'AMBIGUOUS' ELSE ['TP_FIRST', 'SL_FIRST', 'TIMEOUT'][y + 1] END AS outcome, CASE WHEN sequence % 7 > 0 THEN stop END AS ret FROM cands)
SELECT count(*) FILTER (outcome <> 'AMBIGUOUS' AND ret IS NOT NULL) AS usable, count(*) FILTER (outcome = 'AMBIGUOUS') AS ambiguous, count(*) FILTER (outcome <> 'AMBIGUOUS' AND ret IS NULL) AS unpriced FROM o""")
def usable_labels(spark, sf):
    c = cands(spark, sf)
    outcome = F.when(F.col("sequence") % 11 == 0, "AMBIGUOUS").otherwise(F.element_at(F.array(*(F.lit(x) for x in E.CLASSES)), F.col("y") + 1))
    o = c.select(outcome.alias("outcome"), F.when(F.col("sequence") % 7 > 0, F.col("stop")).alias("ret"))
    known = F.col("outcome").isin(*E.CLASSES)
    return o.agg(F.count_if(known & F.col("ret").isNotNull()).alias("usable"), F.count_if(~known).alias("ambiguous"), F.count_if(known & F.col("ret").isNull()).alias("unpriced"))


@V.add(f"""{with_sql('ticks')}, {_FOLDS_SQL}, x AS (SELECT sequence, fold, CASE WHEN received_at_ns >= test_start_ns AND received_at_ns < test_end_ns THEN 'test' WHEN received_at_ns + 43200000000000 <= test_start_ns - {_FOLDS[2]} THEN 'train' END AS part FROM ticks, folds)
SELECT a.fold AS train_fold, b.fold AS test_fold, count(*) AS shared FROM x a JOIN x b ON a.sequence = b.sequence AND a.part = 'train' AND b.part = 'test' GROUP BY ALL""")
def fold_overlap(spark, sf):
    m = E.membership(_labelled(spark, sf), folds(spark, sf), "decision_at_ns", "label_end_ns", _FOLDS[2]).select("sequence", "fold", "part")
    train = m.where("part = 'train'").select("sequence", F.col("fold").alias("train_fold"))
    test = m.where("part = 'test'").select("sequence", F.col("fold").alias("test_fold"))
    return train.join(test, "sequence").groupBy("train_fold", "test_fold").agg(F.count("*").alias("shared"))


@V.add(f"""{with_sql('ticks')}, b AS (SELECT max(received_at_ns) AS l FROM ticks), d AS (SELECT DISTINCT received_at_ns AS t FROM ticks), n AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS k, count(*) OVER () AS n FROM d)
SELECT 1 AS fold, t AS test_start_ns, l + 1 AS test_end_ns FROM n, b WHERE k = floor(n * 0.7::DOUBLE)::BIGINT""")
def holdout_window(spark, sf):
    t = ticks(spark, sf)
    return E.holdout(t.agg(F.max("received_at_ns").alias("last_ns")), t, "received_at_ns")


@V.add("""WITH j AS (SELECT l.*, o.o_orderdate FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey)
SELECT (SELECT count(*) FROM j WHERE l_shipdate < o_orderdate) AS shipped_before, (SELECT count(*) FROM j WHERE l_quantity <= 0) AS no_quantity,
  (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS unmatched, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS repeated""")
def consistency_checks(spark, sf):
    from ..operators import quality as Q

    left = read(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_quantity")
    rules = {"shipped_before": F.col("l_shipdate") < F.col("o_orderdate"), "no_quantity": F.col("l_quantity") <= 0}
    return Q.consistency(left, read(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey", rules)


@V.add("""WITH p AS (SELECT event_type, event_id, ts, user_id % 50 AS id, lag(ts) OVER w AS t0, lag(user_id % 50) OVER w AS i0 FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id))
SELECT event_type, event_id, CASE WHEN ts < t0 THEN 'backward' ELSE 'repeated' END AS problem FROM p WHERE ts < t0 OR id = i0""")
def file_order_issues(spark, sf):
    from ..operators import quality as Q

    e = read(spark, sf, "events").select("event_type", "event_id", "ts", (F.col("user_id") % 50).alias("id"))
    return Q.file_order(e, ["event_type"], "event_id", "ts", "id").select("event_type", "event_id", "problem")
