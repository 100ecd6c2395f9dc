"""What streams and evaluations write: raw segments, ledgers, documents that never change, health, and locks between writers."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sources.tables import _fs


def land(lines: DataFrame, out: str, checkpoint: str, every: str | None = None, records_per_file: int = 100_000) -> StreamingQuery:
    """Writes a stream of envelopes (value) as text under kind=, symbol= and date= (UTC, by receipt). Lines that aren't envelopes go under kind=invalid.

    The sink's log and the checkpoint keep a line from being written twice or torn, whichever task is lost. every: a trigger's interval;
    None takes what is there and stops.
    """
    fields = F.from_json("value", "kind string, symbol string, received_at_ns long")
    sound = F.col("e.kind").isNotNull() & F.col("e.symbol").isNotNull() & F.col("e.received_at_ns").isNotNull()
    date = F.to_utc_timestamp(F.timestamp_micros(F.expr("e.received_at_ns div 1000")), F.current_timezone()).cast("date").cast("string")
    named = {"kind": F.when(sound, F.col("e.kind")).otherwise("invalid"), "symbol": F.when(sound, F.col("e.symbol")).otherwise("none"), "date": F.when(sound, date).otherwise("none")}
    rows = lines.select("value", fields.alias("e")).withColumns(named).drop("e")
    writer = rows.writeStream.format("text").partitionBy("kind", "symbol", "date").option("path", out).option("checkpointLocation", checkpoint).option("maxRecordsPerFile", records_per_file)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def write_ledgers(trades: DataFrame, attempts: DataFrame, root: str) -> None:
    """An evaluation's ledgers, one folder per model; what is there already is never overwritten."""
    for name, df in (("trades", trades), ("attempts", attempts)):
        df.write.partitionBy("model_name").option("compression", "zstd").mode("errorifexists").parquet(f"{root}/{name}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small document by Hadoop's file system; None if there is none."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_aside(spark: SparkSession, path: str, text: str):
    fs, target = _fs(spark, path)
    _, aside = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return fs, target, aside


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def write_once(spark: SparkSession, path: str, value: object) -> bool:
    """Writes a JSON document that never changes: False if it is there with this content, an error if with another."""
    text = canonical(value)
    found = read_text(spark, path)
    if found is None:
        fs, target, aside = _write_aside(spark, path, text)
        if fs.rename(aside, target):
            return True
        fs.delete(aside, False)
        found = read_text(spark, path)  # another writer was first
    if found != text:
        raise FileExistsError(f"{path} has other content")
    return False


def replace(spark: SparkSession, path: str, value: object) -> None:
    """Writes a JSON document over the one before; a reader may find none for the moment between both, but never half of one."""
    fs, target, aside = _write_aside(spark, path, canonical(value))
    fs.delete(target, False)
    if not fs.rename(aside, target):
        raise OSError(f"could not write {path}")


@contextmanager
def lock(spark: SparkSession, path: str) -> Iterator[None]:
    """Holds a lock file, which only one writer can create; it names its owner and goes in the end."""
    fs, target = _fs(spark, path)
    try:
        stream = fs.create(target, False)
    except Exception as e:
        if fs.exists(target):
            raise BlockingIOError(f"{path} is held: {read_text(spark, path)}") from e
        raise
    try:
        stream.write(bytearray(spark.sparkContext.applicationId.encode()))
        stream.close()
        yield
    finally:
        fs.delete(target, False)


class Health(StreamingQueryListener):
    """Keeps each query's last progress and writes all of them as one JSON document.

    stale_after: seconds without a new row from which a query counts as stale.
    """

    def __init__(self, spark: SparkSession, path: str, stale_after: float = 60.0) -> None:
        self.spark, self.path, self.stale_after = spark, path, stale_after
        self.queries: dict[str, dict] = {}

    def snapshot(self, now: float | None = None) -> dict:
        now = time.time() if now is None else now
        return {k: {**q, "stale": q["state"] == "running" and now - q["last_row_at"] > self.stale_after} for k, q in self.queries.items()}

    def _write(self) -> None:
        replace(self.spark, self.path, self.snapshot())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.queries[str(event.id)] = {"state": "running", "batch": -1, "rows": 0, "last_row_at": time.time(), "error": None}
        self._write()

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        q = self.queries.setdefault(str(p.id), {"state": "running", "batch": -1, "rows": 0, "last_row_at": time.time(), "error": None})
        q.update(batch=p.batchId, rows=q["rows"] + p.numInputRows, last_row_at=time.time() if p.numInputRows else q["last_row_at"])
        self._write()

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self._write()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.queries.setdefault(str(event.id), {"batch": -1, "rows": 0, "last_row_at": time.time()}).update(state="failed" if event.exception else "stopped", error=event.exception)
        self._write()
