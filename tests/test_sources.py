import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidewright import schemas
from tidewright.operators import parse
from tidewright.sources import feed, tables
from tidewright.streaming import live

T0 = 1704067200000000000


def envelope(kind, n, payload, received=None):
    return json.dumps({"schema_version": 1, "source": "feed", "session_id": "s", "kind": kind, "symbol": "X", "exchange_ts_ms": 1704067200000 + n, "received_at_ns": received or T0 + n * 1_000_000, "payload": payload})


@pytest.fixture()
def root(tmp_path):
    d = tmp_path / "raw" / "trades" / "X" / "2024" / "01" / "01"
    d.mkdir(parents=True)
    lines = [envelope("trades", n, [{"T": n, "i": str(n), "S": "Buy", "p": str(100 + n), "v": "1", "seq": n}]) for n in range(6)]
    (d / "part-0.jsonl").write_text("\n".join(lines[:3]) + "\n")
    (d / "part-1.jsonl").write_text("\n".join(lines[3:]) + "\n")
    (d / "part-2.jsonl.partial").write_text("torn")
    return str(tmp_path / "raw")


def test_segments_number_lines_and_prune(spark, root):
    s = feed.segments(spark, root)
    assert sorted((r.source_path[-12:], r.source_line) for r in s.collect()) == [(f"part-{f}.jsonl", n) for f in (0, 1) for n in (1, 2, 3)]
    assert feed.segments(spark, root, "2024-01-02").count() == 0
    assert feed.file_digests(spark, root, "*.jsonl").count() == 2


def test_publish_validate_and_reuse(spark, root, tmp_path):
    t = parse.trades(parse.envelopes(feed.segments(spark, root)))
    t = t.select(*[F.col(f.name).cast(f.dataType) for f in schemas.TRADES])
    path = tables.publish(t, str(tmp_path / "data"), "id1", schemas.TRADES, "exchange_ts_ms", ["received_at_ns"])
    assert tables.publish(t, str(tmp_path / "data"), "id1", schemas.TRADES, "exchange_ts_ms", ["received_at_ns"]) == path
    assert tables.validate(spark, path)["files"] >= 1
    again = tables.read(spark, f"{path}/data", schemas.TRADES, ["symbol", "price", "date"], start="2024-01-01", symbols=["X"])
    assert again.count() == 6
    with pytest.raises(ValueError):
        schemas.check(t.drop("price"), schemas.TRADES)


def test_gzipped_history(spark, tmp_path):
    f = tmp_path / "X2024-01-01.csv.gz"
    with gzip.open(f, "wt") as out:
        out.write("timestamp,symbol,side,size,price,tickDirection,trdMatchID\n1704067200.25,X,Sell,1,100.5,PlusTick,a\n")
    rows = parse.history_rows(feed.trade_history(spark, str(f)), "X", "2024-01-01").collect()
    assert [(r.problem, r.received_at_ns, r.price) for r in rows] == [(None, 1704067200250000000, 100.5)]


def test_retention_removes_what_still_agrees(spark, tmp_path):
    a = tmp_path / "a"
    a.write_text("12")
    kind = "path string, size long, sha256 string, verdict string"
    digest = hashlib.sha256(a.read_bytes()).hexdigest()
    good = [(str(a), 2, digest, "candidate"), (str(tmp_path / "x"), 2, digest, "keep")]
    for k, bad in enumerate([(str(tmp_path / "b"), 1, "", "candidate"), (str(a), 2, hashlib.sha256(b"zz").hexdigest(), "candidate")]):
        with pytest.raises(ValueError):
            tables.apply_retention(spark, spark.createDataFrame([*good, bad], kind), str(tmp_path / f"refused{k}"))
        assert a.exists()
    assert tables.apply_retention(spark, spark.createDataFrame(good, kind), str(tmp_path / "receipt")) == 1
    assert not a.exists()


def stream(spark, query, name):
    q = query.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_streamed_trades_agree_with_batch(spark, root):
    batch = parse.trades(parse.envelopes(feed.segments(spark, root)))
    streamed = stream(spark, live.deduplicated(parse.trades(parse.envelopes(feed.segment_stream(spark, root, 1))), ["symbol", "trade_id"]), "streamed_trades")
    assert sorted(r.trade_id for r in streamed.collect()) == sorted(r.trade_id for r in batch.collect())


def test_books_follow_snapshots_deltas_and_sessions(spark, tmp_path):
    kind = "symbol string, session_id string, type string, received_at_ns long, update_id long, sequence long, bids array<array<double>>, asks array<array<double>>"
    m = [
        ("X", "a", "snapshot", 1, 10, 1, [[99.0, 1.0], [98.0, 4.0]], [[101.0, 2.5]]), ("X", "a", "delta", 2, 11, 2, [[99.0, 0.0]], []), ("X", "a", "delta", 1_000_000_002, 12, 3, [[97.0, 2.0]], []),
        ("X", "a", "delta", 1_000_000_003, 12, 4, [[96.0, 2.0]], []), ("X", "b", "delta", 1_000_000_004, 13, 5, [[1.0, 1.0]], []), ("X", "b", "snapshot", 1_000_000_005, 20, 6, [[50.0, 1.0]], []),
    ]
    spark.createDataFrame(m, kind).coalesce(1).write.json(str(tmp_path / "m"))
    out = stream(spark, live.normalise_books(spark.readStream.schema(kind).json(str(tmp_path / "m"))), "books_out").orderBy("received_at_ns").collect()
    assert [(r.update_id, r.bid_prices, r.ask_sizes) for r in out] == [(10, [99.0, 98.0], [2.5]), (12, [98.0, 97.0], [2.5]), (20, [50.0], [])]


def test_settlement_waits_and_sessions_leave_unresolved(spark, tmp_path):
    kind = "symbol string, session_id string, received_at_ns long, price double, decision_id string, settle_ns long, entry double, stop double, profit double, long boolean"
    none = (None,) * 6
    e = [
        ("X", "a", 1, 100.0, "d1", 10, 100.0, 99.0, 101.0, True), ("X", "a", 5, 101.5, *none), ("X", "a", 6, 98.0, *none), ("X", "a", 11, 100.0, *none),
        ("X", "a", 12, 100.0, "d2", 99, 100.0, 99.0, 101.0, True), ("X", "b", 13, 100.0, *none),
    ]
    spark.createDataFrame(e, kind).coalesce(1).write.json(str(tmp_path / "e"))
    out = stream(spark, live.settle(spark.readStream.schema(kind).json(str(tmp_path / "e"))), "settled").collect()
    assert {(r.decision_id, r.outcome) for r in out} == {("d1", "TP_FIRST"), ("d2", "UNRESOLVED")}


def test_models_learn(spark):
    from tidewright.operators import models

    rows = spark.range(600).select((F.col("id") % 3).cast("double").alias("y"), ((F.col("id") % 3) * 2 + F.rand(1)).alias("a"), F.when(F.col("id") % 7 > 0, F.rand(2)).alias("b"))
    fitted = models.fit_logistic(rows, ["a", "b"], "y")
    hit = models.predict_logistic(fitted, rows, ["a", "b"]).where(F.array_position("probabilities", F.array_max("probabilities")) - 1 == F.col("y")).count()
    assert hit > 550
    boosted = models.fit_boosted(rows, ["a", "b"], "y", 3, trees=3, depth=2)
    p = models.predict_boosted(boosted, rows, ["a", "b"]).select(F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert abs(p[0] - 1) < 1e-9 and abs(p[1] - 1) < 1e-9
