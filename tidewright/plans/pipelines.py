"""Whole workflows over stored data: audit, canonical tables, history import, research and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import Settings
from ..functions.scalars import div, fixed
from ..operators import bars as B
from ..operators import evaluate as E
from ..operators import joins as J
from ..operators import labels as L
from ..operators import models, parse, quality, replay
from ..operators import windows as W
from ..sources import feed, tables

SECOND = 1_000_000_000
MINUTE = 60 * SECOND


def audit(spark: SparkSession, root: str, date: str | None = None) -> dict[str, DataFrame]:
    """statistics, issues, gaps and regressions of raw segments."""
    e = parse.envelopes(feed.segments(spark, root, date))
    good = e.where("problem is null")
    found = e.where("problem is not null").groupBy("kind", "symbol", F.col("problem").alias("code")).agg(F.count("*").alias("issues"), F.min_by(F.concat_ws(":", "source_path", F.col("source_line").cast("string")), F.struct("source_path", "source_line")).alias("first_place"))
    order = ["source_path", "source_line"]
    causal = quality.causal(good, ["kind", "symbol"], "received_at_ns", order)
    candles = parse.kline(e)
    gaps = quality.gaps(candles.withColumn("causal", F.lit(True)), ["symbol", "interval"], "start_ms", ["received_at_ns", *order], MINUTE // 1_000_000)
    books = parse.orderbook(e).withColumn("causal", F.lit(True))
    return {
        "statistics": quality.stream_statistics(causal, ["kind", "symbol"], "exchange_ts_ms", "received_at_ns", "source_path"),
        "issues": found,
        "duplicates": parse.trades(e).groupBy("symbol", "trade_id").agg(F.count("*").alias("n")).where("n > 1"),
        "revisions": quality.revisions(candles, ["symbol", "interval", "start_ms"], "payload_sha256", ["received_at_ns", *order]),
        "gaps": gaps.where("missing > 0 or regression or misaligned"),
        "regressions": quality.regressions(books, ["symbol", "session_id"], "sequence", ["received_at_ns", *order]),
    }


def build_canonical(spark: SparkSession, raw: str, out: str, date: str | None = None) -> dict[str, str]:
    """Publishes the typed tables of raw segments under ids made from the files' digests; returns their paths."""
    e = parse.envelopes(feed.segments(spark, raw, date))
    digests = feed.file_digests(spark, raw, "*.jsonl")
    if date:
        digests = digests.where(F.col("path").contains("/" + date.replace("-", "/") + "/"))
    from ..operators.lineage import fingerprint

    source = fingerprint(digests).first()
    kinds = {"orderbook": parse.orderbook(e), "trades": parse.trades(e), "ticker": parse.ticker(e), "kline": parse.latest_candles(parse.kline(e))}
    paths = {}
    for name, df in kinds.items():
        schema = schemas.TABLES[name]
        typed = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))
        id = tables.identify(table=name, version=schemas.VERSION, source=source["fingerprint"] if source else None)
        paths[name] = tables.publish(typed, out, id, schema, "exchange_ts_ms", ["received_at_ns", "source_path", "source_line"])
    return paths


def import_history_day(spark: SparkSession, path: str, out: str, symbol: str, date: str, latency_ms: int = 1000, most_missing: int = 5) -> str:
    """Publishes a day's bars of 1 s and 60 s from its trade file; raises on rows that break a rule or on long runs without trades."""
    rows = parse.history_rows(feed.trade_history(spark, path), symbol, date)
    bad = rows.where("problem is not null").groupBy("problem").count().collect()
    if bad:
        raise ValueError(f"{path}: {[tuple(b) for b in bad]}")
    trades = rows.withColumn("event_ts_ms", div(F.col("received_at_ns"), 1_000_000)).withColumn("sequence", F.monotonically_increasing_id())
    start = trades.agg(F.min("received_at_ns")).first()[0] // (1440 * MINUTE) * (1440 * MINUTE)
    minutes = B.ohlcv(trades, MINUTE)
    run = B.missing_runs(minutes, MINUTE, start, start + 1440 * MINUTE).first()["longest_run"]
    if run > most_missing:
        raise ValueError(f"{path}: no trade in {run} minutes on end")
    both = [B.availability(B.ohlcv(trades, s * SECOND), s * SECOND, latency_ms).withColumn("interval_seconds", F.lit(s)) for s in (1, 60)]
    df = both[0].unionByName(both[1]).withColumns({"schema_version": F.lit(schemas.VERSION), "source": F.lit("history"), "start_ms": div(F.col("start_ns"), 1_000_000)})
    typed = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TRADE_BAR))
    return tables.publish(typed, out, tables.identify(symbol=symbol, date=date, latency=latency_ms), schemas.TRADE_BAR, "start_ms", ["interval_seconds", "start_ms"])


def price_features(minute_bars: DataFrame, anchor: str, settings: Settings = Settings()) -> DataFrame:
    """Causal features per symbol and decision: those of the last whole minute, if its history has no gap, and the anchor's beside them."""
    history = settings.grid.history_minutes
    b = W.true_range(W.realized_volatility(W.returns(minute_bars, (1, 3, 5, 15, 60)), (5, 15, 60)), 14)
    b = W.range_and_volume(b, 5, 60)
    from pyspark.sql import Window

    whole = F.col("start_ns") - F.lag("start_ns", history).over(Window.partitionBy("symbol").orderBy("start_ns")) == history * MINUTE
    b = b.withColumn("_whole", whole).where("_whole").drop("_whole")
    decision = F.col("start_ns") + MINUTE + settings.grid.offset_seconds * SECOND
    rows = b.withColumn("decision_at_ns", decision).where("available_at_ns <= decision_at_ns")
    rows = W.calendar_features(rows.withColumn("_ms", div(F.col("decision_at_ns"), 1_000_000)), "_ms").drop("_ms")
    names = ["return_1", "return_5", "return_60", "vol_60"]
    rows = J.with_anchor(rows, anchor, "decision_at_ns", names)
    relative = {f"relative_{n}": F.when(F.col("symbol") == anchor, 0.0).otherwise(F.col(n) - F.col(f"anchor_{n}")) for n in names}
    from ..functions.scalars import identifier

    return rows.withColumns(relative).withColumn("decision_id", identifier(F.col("symbol"), F.col("decision_at_ns").cast("string")))


def price_labels(features: DataFrame, second_bars: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Both sides' barrier outcomes of each decision over each horizon, from bars of one second."""
    lab = settings.labels
    barriers = L.Barriers(lab.stop_multiple, lab.take_profit_multiple / lab.stop_multiple, lab.least_stop_bps, lab.most_stop_bps)
    d = J.scenarios(features.select("decision_id", "symbol", "decision_at_ns", F.col("close").alias("entry_price"), "vol_60"), side=["LONG", "SHORT"], horizon_minutes=list(lab.horizons_minutes))
    stop, profit = barriers.distances(F.col("vol_60"), 60, F.col("horizon_minutes"))
    d = d.withColumns({"stop_bps": stop, "profit_bps": profit, "label_end_ns": F.col("decision_at_ns") + F.col("horizon_minutes") * MINUTE, "label_id": F.concat_ws("|", "decision_id", "side", F.col("horizon_minutes").cast("string"))})
    low, high = L.barrier_prices(F.col("entry_price"), F.col("side"), F.col("stop_bps"), F.col("profit_bps"))
    return L.barrier_outcomes_on_bars(d.withColumns({"stop_price": low, "profit_price": high}), second_bars, 15 * MINUTE, id="label_id")


def evaluate_fold(features: DataFrame, labels: DataFrame, fold: int, windows: DataFrame, names: list[str], settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Fits on a fold's fit rows, calibrates on the rows before its window, and scores the window: predictions, metrics and ledger."""
    ev = settings.evaluation
    usable = labels.where(F.col("outcome").isin(*E.CLASSES) & F.col("return_bps").isNotNull())
    y = (F.array_position(F.array(*(F.lit(c) for c in E.CLASSES)), F.col("outcome")) - 1).cast("double")
    rows = usable.select("decision_id", "side", "horizon_minutes", "decision_at_ns", "label_end_ns", "stop_bps", "profit_bps", "return_bps", y.alias("y")).join(features.drop("decision_at_ns"), "decision_id")
    day = 1440 * MINUTE
    parts = E.membership(rows, windows.where(F.col("fold") == fold), "decision_at_ns", "label_end_ns", ev.embargo_minutes * MINUTE, ev.calibration_days * day)
    fit, calibration, test = (parts.where(F.col("part") == p) for p in ("fit", "calibration", "test"))
    model = models.fit_logistic(fit, names, "y")
    score = lambda df: models.predict_logistic(model, df, names).withColumn("y", F.col("y").cast("int"))
    prior_rows = {r["y"]: r["smoothed"] for r in E.class_prior(fit.withColumn("y", F.col("y").cast("int")), "y", 3).collect()}
    prior = F.array(*(F.lit(prior_rows[k]) for k in range(3)))
    best = E.best_calibration(E.calibration_grid(score(calibration), 3, prior)).first()
    predicted = score(test).withColumn("probabilities", E.calibrated(F.col("probabilities"), F.lit(best["temperature"]), F.lit(best["weight"]), prior))
    p = [F.element_at("probabilities", i) for i in (1, 2, 3)]
    net = E.expected_net_bps(*p, F.col("profit_bps"), F.col("stop_bps"), F.lit(0.0), F.lit(0.0))
    candidates = predicted.select(F.lit("logistic").alias("model"), "decision_at_ns", "symbol", "side", "label_end_ns", "return_bps", "stop_bps", fixed(net).alias("net"))
    picks = E.top_candidates(candidates, ["model", "decision_at_ns"], "net", 1.0, [F.col("symbol"), F.col("side")])
    ledger = replay.one_position(picks.select("model", "decision_at_ns", F.col("label_end_ns").alias("exit_at_ns"), E.position_fraction(F.col("stop_bps")).alias("size"), F.col("return_bps").alias("pnl_bps")), "model")
    return {"predictions": predicted, "metrics": E.metrics(predicted), "bins": E.confidence_bins(predicted), "ledger": replay.drawdown(ledger, "model")}
