import json

import pytest
from pyspark.sql import functions as F

from tidewright.streaming import sinks


def envelope(n, kind="trades"):
    return json.dumps({"kind": kind, "symbol": "X", "received_at_ns": 1704067199_000_000_000 + n * 1_000_000_000, "payload": n})


def test_lines_land_once_by_kind_symbol_and_day(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [envelope(0), envelope(1), envelope(2, "tickers"), "torn {"]
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines) + "\n")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    health = sinks.Health(spark, str(tmp_path / "health.json"))
    for more in (0, 0, 1):
        if more:
            (tmp_path / "in" / "b.txt").write_text(envelope(3) + "\n")
        sinks.land(spark.readStream.text(str(tmp_path / "in")), out, state).awaitTermination(60)
    found = spark.read.option("basePath", out).text(out).select("value", "kind", "symbol", F.col("date").cast("string"))
    assert sorted((r.kind, r.date, r.value) for r in found.collect()) == sorted(
        [("trades", "2023-12-31", lines[0]), ("trades", "2024-01-01", lines[1]), ("tickers", "2024-01-01", lines[2]), ("invalid", "none", "torn {"), ("trades", "2024-01-01", envelope(3))]
    )
    health.queries["q"] = {"state": "running", "batch": 1, "rows": 2, "last_row_at": 100.0, "error": None}
    assert not health.snapshot(150.0)["q"]["stale"] and health.snapshot(170.0)["q"]["stale"]


def test_documents_and_locks(spark, tmp_path):
    path = str(tmp_path / "doc.json")
    assert sinks.read_text(spark, path) is None
    assert sinks.write_once(spark, path, {"b": 1, "a": "ü"}) and not sinks.write_once(spark, path, {"a": "ü", "b": 1})
    with pytest.raises(FileExistsError):
        sinks.write_once(spark, path, {"a": 2})
    sinks.replace(spark, path, {"a": 2})
    assert json.loads(sinks.read_text(spark, path)) == {"a": 2}
    held = str(tmp_path / "lock")
    with sinks.lock(spark, held):
        with pytest.raises(BlockingIOError):
            with sinks.lock(spark, held):
                pass
    with sinks.lock(spark, held):
        pass


def test_ledgers_by_model(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "model_name string, n long")
    root = str(tmp_path / "ledgers")
    sinks.write_ledgers(df, df, root)
    assert spark.read.parquet(f"{root}/trades").where("model_name = 'b'").first().n == 2
    with pytest.raises(Exception, match="exists"):
        sinks.write_ledgers(df, df, root)
