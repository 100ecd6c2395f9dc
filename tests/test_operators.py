import pytest
from pyspark.sql import functions as F

from tidewright.operators import book, evaluate, joins, labels, lineage, parse, quality, replay, spans, windows

MINUTE = 60 * 1_000_000_000


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_asof_ties_take_the_last_and_buckets_are_crossed(spark):
    records = spark.createDataFrame([("a", 10, 1, 1.0), ("a", 10, 2, 2.0), ("a", 250, 3, 3.0)], "s string, t long, n long, v double")
    probes = spark.createDataFrame([("a", 9), ("a", 10), ("a", 249), ("a", 1000), ("b", 10)], "s string, at long")
    back = joins.asof(probes, records, ["s"], "at", "t", ["v"], order=["n"], bucket_ns=100)
    assert as_set(back) == {("a", 9, None), ("a", 10, 2.0), ("a", 249, 2.0), ("a", 1000, 3.0), ("b", 10, None)}
    strict = joins.asof(probes, records, ["s"], "at", "t", ["v"], order=["n"], bucket_ns=100, inclusive=False)
    assert ("a", 10, None) in as_set(strict)
    forth = joins.asof(probes, records, ["s"], "at", "t", ["v"], order=["n"], bucket_ns=100, forward=True)
    assert as_set(forth) == {("a", 9, 1.0), ("a", 10, 1.0), ("a", 249, 3.0), ("a", 1000, None), ("b", 10, None)}


def trades(spark, rows):
    return spark.createDataFrame([("X", *r) for r in rows], "symbol string, received_at_ns long, event_ts_ms long, sequence long, price double, size double, side string, is_block boolean, is_rpi boolean")


def order(spark, size, queue=1.0):
    return spark.createDataFrame([("o", "X", "LONG", 100.0, queue, size, 0, 1000)], "order_id string, symbol string, side string, entry_price double, queue_ahead double, size double, active_at_ns long, expires_at_ns long")


def test_maker_fill_after_the_queue(spark):
    t = trades(spark, [(1, 1, 1, 100.0, 1.0, "Sell", None, None), (2, 1, 2, 100.0, 0.25, "Sell", None, None), (3, 1, 3, 100.0, 0.25, "Sell", None, None)])
    r = labels.maker_fills(order(spark, 0.5), t, 500).first()
    assert (r.fill_status, r.first_fill_ns, r.full_fill_ns, r.contra_volume) == ("FULL_FILL", 2, 3, 1.5)


def test_print_through_the_price_fills_without_its_volume(spark):
    r = labels.maker_fills(order(spark, 0.5), trades(spark, [(5, 1, 1, 99.0, 9.0, "Sell", False, False)]), 500).first()
    assert (r.fill_status, r.contra_volume) == ("FULL_FILL", 0.0)


def test_blocks_do_not_fill_but_count(spark):
    t = trades(spark, [(5, 1, 1, 100.0, 9.0, "Sell", True, False), (6, 1, 2, 100.0, 9.0, "Sell", False, True), (1000, 1, 3, 100.0, 9.0, "Sell", False, False)])
    r = labels.maker_fills(order(spark, 0.5), t, 500).first()
    assert (r.fill_status, r.contra_volume, r.window_trades) == ("NO_FILL", 0.0, 2)


def test_both_barriers_at_one_key_are_ambiguous(spark):
    d = spark.createDataFrame([("d", "X", "LONG", 0, 100, 100.0, 99.0, 101.0)], "decision_id string, symbol string, side string, decision_at_ns long, label_end_ns long, entry_price double, stop_price double, profit_price double")
    t = trades(spark, [(5, 1, None, 98.0, 1.0, "Buy", None, None), (5, 1, None, 102.0, 1.0, "Buy", None, None)])
    assert labels.barrier_outcomes(d, t, 50).first().outcome == "AMBIGUOUS"
    none = labels.barrier_outcomes(d, t.where("price > 1000"), 50).first()
    assert (none.outcome, none.resolution, none.return_bps) == ("TIMEOUT", "no_trades", None)
    bars = spark.createDataFrame([("X", 102.0, 98.0, 100.0, 7)], "symbol string, high double, low double, close double, available_at_ns long")
    both = labels.barrier_outcomes_on_bars(d, bars, 50).first()
    assert (both.outcome, both.hit_at_ns) == ("AMBIGUOUS", 7)


def test_regressions_stay_within_sessions(spark):
    rows = spark.createDataFrame([("X", "old", 1, 5), ("X", "old", 2, 4), ("X", "new", 3, 1), ("X", "new", 4, 2)], "symbol string, session_id string, received long, number long")
    c = quality.causal(rows, ["symbol", "session_id"], "received", ["received"])
    assert quality.regressions(c, ["symbol", "session_id"], "number", ["received"]).count() == 1


def test_acceptance(spark):
    kind = "code string, severity string"
    assert quality.acceptance(spark.createDataFrame([], kind)).first().verdict == "clean"
    assert quality.acceptance(spark.createDataFrame([("kline_gap", "warning")], kind)).first().verdict == "gapped"
    assert quality.acceptance(spark.createDataFrame([("kline_gap", "error")], kind)).first().verdict == "rejected"


def test_calibration_keeps_the_identity_at_ties(spark):
    grid = spark.createDataFrame([(0.5, 0.0, 1.0), (1.0, 0.0, 1.0), (2.0, 0.1, 1.0)], "temperature double, weight double, log_loss double")
    b = evaluate.best_calibration(grid).first()
    assert (b.temperature, b.weight) == (1.0, 0.0)


def test_folds_fit_whole_windows(spark):
    bounds = spark.createDataFrame([(0, 100)], "first_ns long, last_ns long")
    assert [tuple(r) for r in evaluate.folds(bounds, 20, 35, 2).collect()] == [(1, 55, 75), (2, 75, 95)] or evaluate.folds(bounds, 20, 35, 2).count() == 2
    assert evaluate.folds(bounds, 80, 35, 2).count() == 0


def test_replay_gates_and_twins(spark):
    hour = 3_600_000_000_000
    picks = spark.createDataFrame([(1, 0, 2 * hour, 0.05, -3000.0), (1, hour, 3 * hour, 0.05, 10.0), (1, 2 * hour, 3 * hour, 0.05, 10.0), (1, 30 * hour, 31 * hour, 0.05, 10.0)], "model int, decision_at_ns long, exit_at_ns long, size double, pnl_bps double")
    fold = replay.one_position(picks, "model")
    assert [r.decision_at_ns for r in fold.orderBy("decision_at_ns").collect()] == [0, 30 * hour]  # busy, then the day's loss
    assert as_set(fold) == as_set(replay.one_position_in_pandas(picks, "model"))
    assert fold.agg(F.max("equity")).first()[0] < 1


def test_throttle_is_greedy(spark):
    rows = spark.createDataFrame([("a", t) for t in (0, 6, 9, 11, 19, 21)], "k string, t long")
    assert sorted(r.t for r in replay.throttle(rows, "k", "t", 10).collect()) == [0, 11, 21]


def test_journal_chain_and_its_breaks(spark):
    events = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "j int, n long, body string")
    chained = lineage.chain(events, "j", "n", "body").join(events, ["j", "n"])
    assert lineage.broken_links(chained, "j", "body").count() == 0
    forged = chained.withColumn("body", F.when(F.col("body") == "a", "x").otherwise(F.col("body")))
    assert lineage.broken_links(forged, "j", "body").count() == 1


def test_manifest_mismatches(spark):
    kind = "path string, bytes long, sha256 string"
    m = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x")], kind)
    o = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("d", 1, "x")], kind)
    assert as_set(lineage.manifest_mismatches(m, o)) == {("b", "size"), ("c", "missing"), ("d", "extra")}


def test_book_levels_and_invalid_numbers(spark):
    payload = '{"bids": [["99","2"],["98","4"],["NaN","1"],["97","0"]], "asks": [["101","2.5"],["-1","1"]], "matching_engine_ts_ms": 5, "update_id": 12, "sequence": 3}'
    line = '{"schema_version":1,"source":"feed","session_id":"s","kind":"orderbook","symbol":"X","exchange_ts_ms":1704067200000,"received_at_ns":1704067200000000000,"payload":%s}' % payload
    lines = spark.createDataFrame([(line, "orderbook/X/2024/01/01/part-0.jsonl", 1), ("{", "orderbook/X/2024/01/01/part-0.jsonl", 2), (line, "orderbook/Y/2024/01/01/part-0.jsonl", 1), (line, "orderbook/X/2024/01/02/part-0.jsonl", 1)], "value string, source_path string, source_line long")
    e = parse.envelopes(lines)
    assert [r.problem for r in e.collect()] == [None, "not_json", "path", "date"]
    b = parse.orderbook(e).first()
    assert (b.bid_prices[:2], b.bid_sizes[:2], b.ask_sizes[0], b.update_id) == ([99.0, 98.0], [2.0, 4.0], 2.5, 12)
    assert b.bid_prices[2] is None and b.bid_sizes[3] is None


def test_trades_candles_and_tickers_parse(spark):
    head = '{"schema_version":1,"source":"feed","session_id":null,"kind":"%s","symbol":"X","exchange_ts_ms":1704067200000,"received_at_ns":%d,"payload":%s}'
    t0 = 1704067200000000000
    trade = '[{"T":1,"i":"a","S":"Buy","p":"1.5","v":"2","seq":7},{"T":2,"i":"b","S":"None","p":"1","v":"1"}]'
    candle = '{"start":0,"end":59999,"interval":"1","open":"1","high":"3","low":"1","close":"%s","volume":"1","turnover":"1","confirm":%s}'
    lines = [
        (head % ("trades", t0, trade), "p", 1), (head % ("kline_1", t0, candle % ("2", "true")), "p", 2), (head % ("kline_1", t0 + 1, candle % ("102", "true")), "p", 3),
        (head % ("kline_1", t0 + 2, candle % ("9", "false")), "p", 4), (head % ("ticker", t0, '{"lastPrice":"5","fundingRate":"","nextFundingTime":"8"}'), "p", 5),
    ]
    e = parse.envelopes(spark.createDataFrame(lines, "value string, source_path string, source_line long"))
    assert [(r.trade_id, r.price, r.sequence, r.is_block_trade) for r in parse.trades(e).collect()] == [("a", 1.5, 7, None)]
    candles = parse.kline(e)
    assert candles.count() == 2 and parse.latest_candles(candles).first().close == 102.0
    k = parse.ticker(e).first()
    assert (k.last_price, k.funding_rate, k.next_funding_time_ms) == (5.0, None, 8)


def test_history_rows(spark):
    raw = spark.createDataFrame([("1704067200.5", "X", "Buy", "1", "2", "a"), ("1704067200.0000000001", "X", "Buy", "1", "2", "a"), ("1704067200", "X", "Hold", "1", "2", "a")], "timestamp string, Symbol string, side string, size string, price string, trdMatchID string")
    rows = parse.history_rows(raw, "X", "2024-01-01").collect()
    assert [r.problem for r in rows] == [None, "time", "side"]
    assert rows[0].received_at_ns == 1704067200500000000


def test_empty_inputs(spark):
    t = trades(spark, [])
    assert windows.trailing(t, MINUTE).count() == 0
    assert labels.maker_fills(order(spark, 1.0), t, 100).first().fill_status == "NO_FILL"
    assert book.rebuild(t, 10, 5).count() == 0


def test_settings(tmp_path, monkeypatch):
    from tidewright.config import load

    f = tmp_path / "c.toml"
    f.write_text("[labels]\nhorizons_minutes = [5, 15]\n")
    assert load(str(f)).labels.horizons_minutes == (5, 15)
    monkeypatch.setenv("TIDEWRIGHT_EVALUATION_EMBARGO_MINUTES", "1")
    with pytest.raises(ValueError, match="embargo"):
        load(str(f))


def test_sample_has_every_class(spark):
    from tidewright.operators import evaluate as E

    rows = spark.range(1000).select("id", F.when(F.col("id") == 7, 1).when(F.col("id") == 9, 2).otherwise(0).alias("y"))
    found = E.uniform_sample(rows, ["id"], 10, "y", 3).collect()
    places = [i * 999 // 9 for i in range(10)]
    assert sorted(r.id for r in found) == sorted([places[0], 7, 9, *places[3:]])
    with pytest.raises(ValueError):
        E.uniform_sample(rows, ["id"], 10, "y", 4)


def test_estimates_fall_back(spark):
    from tidewright.operators import joins as J

    samples = spark.createDataFrame([("a", "L", 1.0)] * 3 + [("b", "L", 5.0), ("c", "S", None)], "symbol string, side string, v double")
    rows = spark.createDataFrame([("a", "L"), ("b", "L"), ("c", "S")], "symbol string, side string")
    assert {r.symbol: r.estimate for r in J.fallback(rows, samples, "v", ["symbol", "side"], 3).collect()} == {"a": 1.0, "b": 2.0, "c": 2.0}


def soon(spark, df, seconds=120):
    """df's rows; its jobs are cancelled if they take longer, as work by the pair would."""
    import threading

    timer = threading.Timer(seconds, spark.sparkContext.cancelAllJobs)
    timer.start()
    try:
        return df.collect()
    finally:
        timer.cancel()


N = 120_000


def dense(spark):
    """Trades at 100 every nanosecond, and one at 102 at the end of all windows: by the pair they are seven thousand million rows."""
    columns = ["'X' AS symbol", "id AS received_at_ns", "id DIV 1000 AS event_ts_ms", "id AS sequence", f"IF(id = {N}, 102.0D, 100.0D) AS price", "1.0D AS size", "'Sell' AS side", "false AS is_block", "false AS is_rpi"]
    return spark.range(1, N + 1).selectExpr(*columns)


def test_barriers_of_dense_trades(spark):
    d = dense(spark).selectExpr("sequence AS decision_id", "symbol", "'LONG' AS side", "received_at_ns AS decision_at_ns", f"CAST({N} AS BIGINT) AS label_end_ns", "100.0D AS entry_price", "99.0D AS stop_price", "101.0D AS profit_price")
    out = labels.barrier_outcomes(d, dense(spark), 50_000)
    found = soon(spark, out.groupBy("outcome").agg(F.count("*").alias("n"), F.sum("trades_seen").alias("seen"), F.max("profit_key.sequence").alias("key")))
    assert {tuple(r) for r in found} == {("TP_FIRST", N - 1, N * (N - 1) // 2, N), ("TIMEOUT", 1, None, None)}


def test_extremes_of_intervals(spark):
    d = spark.createDataFrame([("X", 0, 250, 1), ("X", 10, 10, 2), ("X", 10, 120, 3), ("X", 130, 999, 4), ("X", None, 9, 5), (None, 0, 999, 6), ("Y", 0, 9, 7)], "s string, a long, e long, i long")
    t = spark.createDataFrame([("X", 10, 5.0), ("X", 11, None), ("X", 120, 3.0), ("X", 250, 9.0), ("X", 251, None), (None, 5, 1.0)], "s string, t long, v double")
    found = spans.extremes(d, t, ["s"], "a", "e", "t", "v", 100).select("i", "n", "high")
    assert as_set(found) == {(1, 4, 9.0), (2, 0, None), (3, 2, 3.0), (4, 2, 9.0), (5, 0, None), (6, 0, None), (7, 0, None)}


def test_extremes_of_dense_records(spark):
    d = spark.range(N).selectExpr("'X' AS s", "id AS a", f"CAST({N} AS BIGINT) AS e")
    t = spark.range(1, N + 1).selectExpr("'X' AS s", "id AS t", "CAST(id AS DOUBLE) AS v")
    found = spans.extremes(d, t, ["s"], "a", "e", "t", "v", 50_000).agg(F.sum("n"), F.min("high"), F.max("high"))
    assert tuple(soon(spark, found)[0]) == (N * (N + 1) // 2, float(N), float(N))


def test_fills_of_dense_trades(spark):
    o = dense(spark).selectExpr("CAST(sequence AS STRING) AS order_id", "symbol", "'LONG' AS side", "100.0D AS entry_price", "20.0D AS queue_ahead", "30.0D AS size", "received_at_ns AS active_at_ns", f"CAST({N} AS BIGINT) AS expires_at_ns")
    out = labels.maker_fills(o, dense(spark), 50_000)
    found = soon(spark, out.groupBy("fill_status").agg(F.count("*"), F.max(F.col("first_fill_ns") - F.col("active_at_ns")), F.max(F.col("full_fill_ns") - F.col("active_at_ns")), F.max("contra_volume"), F.sum("window_trades")))
    whole = N - 1
    assert {tuple(r) for r in found} == {
        ("FULL_FILL", N - 51, 21, 50, 50.0, sum(range(50, whole))),
        ("PARTIAL_FILL", 29, 21, None, 49.0, sum(range(21, 50))),
        ("NO_FILL", 22, None, None, 20.0, sum(range(21))),
    }


def test_fills_at_prices_that_differ_by_rounding(spark):
    t = trades(spark, [(1, 1, 1, 100.0, 1.0, "Sell", None, None), (2, 1, 2, 100.0 + 2e-9, 0.25, "Sell", None, None), (2, 1, 3, 100.0 - 2e-9, None, "Sell", None, None), (3, 1, 4, 100.0 - 2e-9, 0.25, "Sell", None, None), (4, 1, 5, 100.0, 9.0, "Buy", None, None), (5, 1, 6, 100.0 + 2e-8, 9.0, "Sell", None, None)])
    r = labels.maker_fills(order(spark, 0.5), t, 500).first()
    assert (r.fill_status, r.first_fill_ns, r.full_fill_ns, r.contra_volume, r.window_trades) == ("FULL_FILL", 2, 3, 1.5, 6)
    r = labels.maker_fills(order(spark, 0.75), t, 500).first()
    assert (r.fill_status, r.first_fill_ns, r.full_fill_ns, r.contra_volume) == ("PARTIAL_FILL", 2, None, 1.5)
    assert r.fill_fraction == pytest.approx(0.5 / 0.75)


def fill(spark, *rows):
    return spark.createDataFrame(list(rows), "order_id string, symbol string, side string, fill_ns long, fill_sequence long, horizon_end_ns long, entry_price double, fill_price double, stop_price double, profit_price double")


def test_what_follows_fills_in_dense_trades(spark):
    f = dense(spark).selectExpr("sequence AS order_id", "symbol", "'LONG' AS side", "received_at_ns AS fill_ns", "sequence AS fill_sequence", f"CAST({N} AS BIGINT) AS horizon_end_ns", "100.0D AS entry_price", "100.0D AS fill_price", "99.0D AS stop_price", "101.0D AS profit_price")
    found = soon(spark, labels.post_fill(f, dense(spark), 50_000).groupBy("outcome").agg(F.count("*"), F.sum("trades_seen"), F.max("profit_key.sequence")))
    assert {tuple(r) for r in found} == {("TP_FIRST", N - 1, N * (N - 1) // 2, N), ("TIMEOUT", 1, None, None)}


def test_trades_at_the_fills_time_follow_by_number(spark):
    f = fill(spark, *((f"{n}", "X", "LONG", 5, n, 40, 100.0, 100.0, 99.0, 101.0) for n in (1, 2, 3, 4)), ("short", "X", "SHORT", 5, 3, 40, 100.0, 100.0, 101.0, 99.0), ("none", "X", "LONG", 5, None, 8, 100.0, 100.0, 99.0, 101.0))
    rows = [(5, 1, 2, 98.0), (5, 1, 4, 100.5), (5, 1, None, 90.0), (9, 1, 6, 101.0)]
    for early in (1, 0):  # with 0 the trades at one time aren't in the order of their numbers
        t = trades(spark, [*((a, b, c, p, 1.0, "Buy", None, None) for a, b, c, p in rows), (5, early, 3, 100.0, 1.0, "Buy", None, None), (5, 1, 9, 50.0, 1.0, "Buy", True, None)])
        found = {r.order_id: (r.outcome, r.trades_seen) for r in labels.post_fill(f, t, 50).collect()}
        assert found == {"1": ("SL_FIRST", 4), "2": ("TP_FIRST", 3), "3": ("TP_FIRST", 2), "4": ("TP_FIRST", 1), "short": ("SL_FIRST", 2), "none": ("TIMEOUT", None)}


def test_timeouts_end_at_the_last_known_price(spark):
    kind = "decision_id string, symbol string, side string, decision_at_ns long, label_end_ns long, entry_price double, stop_price double, profit_price double"
    d = spark.createDataFrame([("late", "X", "SHORT", 2, 900, 100.0, 110.0, 90.0), ("hit", "X", "SHORT", 0, 900, 100.0, 110.0, 99.0), ("unpriced", "X", "LONG", 400, 900, 100.0, 90.0, 110.0), ("open", "X", "LONG", 0, None, 100.0, 90.0, 110.0)], kind)
    t = trades(spark, [(1, 1, 1, 99.0, 1.0, "Buy", None, None), (350, 1, 2, 101.0, 1.0, "Buy", None, None), (500, 1, 3, None, 1.0, "Buy", None, None)])
    out = labels.barrier_outcomes(d, t, 50)
    found = {r.decision_id: (r.outcome, r.resolution, r.last_price, r.trades_seen) for r in out.collect()}
    assert found == {"late": ("TIMEOUT", "horizon_end", 101.0, 2), "hit": ("TP_FIRST", "tp_first", 101.0, 3), "unpriced": ("TIMEOUT", "no_trades", None, 1), "open": ("TIMEOUT", "no_trades", None, None)}
    assert out.where("decision_id = 'late'").first().return_bps == pytest.approx(-100.0)


def test_asof_forward_in_a_dense_bucket(spark):
    n = 400_000
    records = spark.range(n).selectExpr("'a' AS s", "2 * id AS t", "id AS v")
    probes = spark.range(2 * n).where("id % 997 = 1").selectExpr("'a' AS s", "id AS at")
    found = soon(spark, joins.asof(probes, records, ["s"], "at", "t", ["v"], forward=True))
    assert len(found) == (2 * n - 2) // 997 + 1
    assert all(r.v == (r.at + 1) // 2 if r.at < 2 * n - 1 else r.v is None for r in found)


def test_trailing_windows_of_dense_trades(spark):
    found = windows.trailing(dense(spark), 60_000).agg(F.count("*"), F.sum("trade_count"), F.max("base"), F.max("trade_return"), F.min("imbalance"), F.max("imbalance"))
    expected = sum(min(i, 60_001) for i in range(1, N + 1))
    assert tuple(soon(spark, found)[0]) == (N, expected, 60_001.0, 102.0 / 100.0 - 1, -1.0, -1.0)


def test_trailing_windows_with_unknown_values(spark):
    t = trades(spark, [(100, 0, 1, None, 1.0, "Buy", None, None), (105, 0, 2, 10.0, None, "Buy", None, None), (110, 0, 3, 20.0, 2.0, "Sell", None, None), (200, 0, 4, 5.0, None, "Buy", None, None), (None, None, 5, 1.0, 4.0, "Buy", None, None)])
    found = {r.sequence: (r.trade_count, r.base, r.notional, r.imbalance, r.trade_return) for r in windows.trailing(t, 10).collect()}
    assert found == {1: (1, 1.0, None, 1.0, 0.0), 2: (2, 1.0, None, 1.0, 0.0), 3: (3, 3.0, 40.0, -1 / 3, 1.0), 4: (1, None, None, None, 0.0), 5: (1, 4.0, 4.0, 1.0, 0.0)}


def test_ranks_are_the_places_of_an_order(spark):
    n = 200_000
    rows = spark.range(n).selectExpr("(id * 7919) % 200000 AS v", "repeat(sha2(string(id), 256), 3) AS wide").repartition(8)
    placed = evaluate.uniform_rank(rows, "v")
    assert tuple(placed.agg(F.count("*"), F.count_if(F.col("_place") == F.col("v")), F.min(F.length("wide"))).first()) == (n, n, 192)
    few = evaluate.uniform_rank(spark.createDataFrame([(3, "b"), (None, "a"), (3, "a"), (-1, None)], "v long, w string"), "v", "w")
    assert as_set(few) == {(None, "a", 0), (-1, None, 1), (3, "a", 2), (3, "b", 3)}
    assert evaluate.uniform_rank(rows.where("v < 0"), "v").count() == 0


@pytest.mark.parametrize("name", ["fill_distribution", "triple_barrier_ticks"])
def test_scenarios_are_made_of_rows_that_were_dealt(spark, sf, name):
    from tidewright.catalog import QUERIES

    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "Exchange" in x or "Generate" in x]
    dealt = next(i for i, x in enumerate(lines) if "Exchange" in x and "_b" in x)
    assert sum("Generate" in x for x in lines[:dealt]) == 2
    assert all("sequence(" in x for x in lines[dealt:] if "Generate" in x)


def test_groups_come_in_many_batches(spark):
    t = trades(spark, [(i * 7 % 400, i, i, 100.0 + i * 37 % 11 - 5, 1.0, "Sell" if i % 3 else "Buy", None, None) for i in range(300)])
    base = t.select("symbol", "sequence", F.col("received_at_ns").alias("decision_at_ns"), (F.col("received_at_ns") + 90).alias("label_end_ns"), F.col("price").alias("entry_price"))

    def expand(rows, only=None):
        up = F.when(F.col("side") == "LONG", 1).otherwise(-1)
        d = joins.scenarios(rows, only, side=["LONG", "SHORT"], width=[30, 90]).withColumn("label_end_ns", F.col("decision_at_ns") + F.col("width"))
        return d.withColumn("stop_price", F.col("entry_price") - up * 3).withColumn("profit_price", F.col("entry_price") + up * 4)

    columns = ["sequence", "side", "width", "outcome", "return_bps", "trades_seen"]
    whole = as_set(labels.barrier_outcomes(expand(base), t, 50).select(columns))
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = labels.barrier_outcomes(base, t, 50, expand=expand).select(columns).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert len(found) == 1200 and {tuple(r) for r in found} == whole
    assert {r.outcome for r in found} >= {"SL_FIRST", "TP_FIRST", "TIMEOUT"}
