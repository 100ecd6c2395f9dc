import gzip
import math

import pytest
from pyspark.sql import functions as F
from test_sources import T0, envelope

from tidewright import schemas
from tidewright.config import Evaluation, Labels, Settings
from tidewright.operators import evaluate
from tidewright.plans import pipelines
from tidewright.sources import tables


def segment(root, kind, lines):
    d = root / kind / "X" / "2024" / "01" / "01"
    d.mkdir(parents=True)
    (d / "part-0.jsonl").write_text("\n".join(lines) + "\n")


def candle(n, close, received):
    return envelope("kline_1", n, {"start": 60_000 * n, "end": 60_000 * n + 59_999, "interval": "1", "open": "1", "high": "103", "low": "1", "close": close, "volume": "1", "turnover": "1", "confirm": True}, T0 + received)


def test_audit_and_canonical_tables(spark, tmp_path):
    raw = tmp_path / "raw"
    trade = lambda n, i: envelope("trades", n, [{"T": n, "i": i, "S": "Buy", "p": "1", "v": "1", "seq": n}])
    segment(raw, "trades", [trade(1, "a"), trade(2, "b"), trade(3, "a"), "{"])
    segment(raw, "kline_1", [candle(0, "100", 1), candle(0, "102", 2), candle(3, "5", 3), candle(3, "5", 4)])
    found = pipelines.audit(spark, str(raw))
    assert [(r.trade_id, r.n) for r in found["duplicates"].collect()] == [("a", 2)]
    assert sorted((r.start_ms, r.redeliveries, r.revisions) for r in found["revisions"].collect()) == [(0, 0, 1), (180_000, 1, 0)]
    assert [(r.missing, r.delta) for r in found["gaps"].collect()] == [(2, 180_000)]
    assert [r.code for r in found["issues"].collect()] == ["not_json"]
    paths = pipelines.build_canonical(spark, str(raw), str(tmp_path / "out"))
    candles = tables.read(spark, f"{paths['kline']}/data", schemas.KLINE)
    assert sorted((r.start_ms, r.close) for r in candles.collect()) == [(0, 102.0), (180_000, 5.0)]
    assert tables.read(spark, f"{paths['trades']}/data", schemas.TRADES).count() == 3
    assert pipelines.build_canonical(spark, str(raw), str(tmp_path / "out")) == paths


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("history")
    f = root / "X.csv.gz"
    with gzip.open(f, "wt") as out:
        out.write("timestamp,symbol,side,size,price,trdMatchID\n")
        for m in range(1440):
            out.write(f"{1704067200 + 60 * m + 4},X,{'Buy' if m % 2 else 'Sell'},0.5,{100 * (1 + 0.01 * math.sin(m / 9))},{m}\n")
    return root, str(f)


def test_history_import(spark, history):
    root, f = history
    path = pipelines.import_history_day(spark, f, str(root / "out"), "X", "2024-01-01")
    bars = tables.read(spark, f"{path}/data", schemas.TRADE_BAR)
    assert {r.interval_seconds: r["count"] for r in bars.groupBy("interval_seconds").count().collect()} == {1: 1440, 60: 1440}
    first = bars.where("interval_seconds = 60").orderBy("start_ms").first()
    assert (first.available_at_ns, first.buy_volume, first.sell_volume) == ((first.start_ms + 61_000) * 1_000_000, 0.0, 0.5)
    with pytest.raises(ValueError, match="symbol"):
        pipelines.import_history_day(spark, f, str(root / "out"), "Y", "2024-01-01")


def test_features_labels_and_a_fold(spark, history):
    root, f = history
    path = pipelines.import_history_day(spark, f, str(root / "out"), "X", "2024-01-01")
    bars = tables.read(spark, f"{path}/data", schemas.TRADE_BAR).withColumn("start_ns", F.col("start_ms") * 1_000_000)
    settings = Settings(labels=Labels(horizons_minutes=(5,)), evaluation=Evaluation(embargo_minutes=5, calibration_days=0)).validate()
    features = pipelines.price_features(bars.where("interval_seconds = 60"), "X", settings).cache()
    assert features.count() == 1380 and features.where("relative_return_1 <> 0").count() == 0
    labels = pipelines.price_labels(features, bars.where("interval_seconds = 1"), settings).cache()
    assert labels.count() == 2760 and labels.where("outcome = 'TIMEOUT' and label_end_ns <= decision_at_ns").count() == 0
    bounds = features.agg(F.min("decision_at_ns").alias("first_ns"), F.max("decision_at_ns").alias("last_ns"))
    hour = 60 * pipelines.MINUTE
    windows = evaluate.folds(bounds, 4 * hour, 12 * hour, 2)
    assert windows.count() == 2
    # the calibration rows of a short fixture: the last two hours before the embargo
    import tidewright.operators.evaluate as E

    whole = E.membership
    E.membership = lambda rows, w, d, end, embargo, calibration: whole(rows, w, d, end, embargo, 2 * hour)
    try:
        out = pipelines.evaluate_fold(features, labels, 1, windows, ["return_1", "return_5", "vol_15", "hour_sin"], settings)
        m = out["metrics"].first()
        assert m.n > 400 and 0 < m.log_loss < 2
        assert out["ledger"].count() >= 0
    finally:
        E.membership = whole
