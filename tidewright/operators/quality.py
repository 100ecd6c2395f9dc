"""Audits of streams, revisions, coverage and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import div, fixed


def causal(rows: DataFrame, by: Sequence[str], received: str, order: Sequence[str]) -> DataFrame:
    """rows with causal: whether a row's time of receipt isn't below that of any row before it in the stream's order."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("causal", F.coalesce(F.col(received) >= F.max(received).over(w), F.lit(True)))


def gaps(rows: DataFrame, by: Sequence[str], time: str, order: Sequence[str], step: int) -> DataFrame:
    """Causal rows with delta since the row before, missing steps, regression and misaligned."""
    w = Window.partitionBy(*by).orderBy(*order)
    delta = F.col(time) - F.lag(time).over(w)
    out = rows.where("causal").withColumn("delta", delta)
    missing = F.when(F.col("delta") > step, F.greatest(F.lit(1), F.ceil(F.col("delta").cast("decimal(20,0)") / step) - 1)).otherwise(0).cast("long")
    return out.withColumns({"missing": missing, "regression": F.coalesce(F.col("delta") < 0, F.lit(False)), "misaligned": F.pmod(time, F.lit(step)) != 0})


def regressions(rows: DataFrame, by: Sequence[str], number: str, order: Sequence[str]) -> DataFrame:
    """Causal rows whose number isn't above that of the row before in their stream and session."""
    w = Window.partitionBy(*by).orderBy(*order)
    return rows.where("causal").withColumn("previous", F.lag(number).over(w)).where(F.col(number) <= F.col("previous"))


def stream_statistics(rows: DataFrame, by: Sequence[str], exchange_ms: str, received_ns: str, file: str | None = None) -> DataFrame:
    """Counts, times and latencies of each stream, in one aggregation."""
    latency = F.col(received_ns) / 1e6 - F.col(exchange_ms)
    files = [F.countDistinct(file).alias("files")] if file else []
    out = rows.groupBy(*by).agg(
        F.count("*").alias("records"), F.min(exchange_ms).alias("first_ms"), F.max(exchange_ms).alias("last_ms"),
        F.min(latency).alias("latency_min"), F.max(latency).alias("latency_max"), F.avg(latency).alias("latency_mean"), *files,
    )
    return out.withColumn("duration_ms", F.col("last_ms") - F.col("first_ms")).withColumns({c: fixed(F.col(c)) for c in ("latency_min", "latency_max", "latency_mean")})


def issues(rows: DataFrame, rules: dict[str, Column], stream: Sequence[str], order: Sequence[str], sample: str) -> DataFrame:
    """Per rule and stream: how many rows break it, and the first of them in order."""
    found = F.filter(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for code, c in rules.items())), lambda x: x.isNotNull())
    each = rows.select(*stream, *order, F.col(sample).alias("_sample"), F.explode(found).alias("code"))
    return each.groupBy("code", *stream).agg(F.count("*").alias("issues"), F.min_by("_sample", F.struct(*order)).alias("first_sample"))


def revisions(rows: DataFrame, keys: Sequence[str], payload: str, order: Sequence[str]) -> DataFrame:
    """Per key: rows, redeliveries (payload of the row before) and revisions (another payload), by one window."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(payload).over(w)
    out = rows.withColumn("_same", F.when(before == F.col(payload), 1).otherwise(0)).withColumn("_other", F.when(before != F.col(payload), 1).otherwise(0))
    return out.groupBy(*keys).agg(F.count("*").alias("deliveries"), F.sum("_same").alias("redeliveries"), F.sum("_other").alias("revisions"))


def ambiguous_revisions(rows: DataFrame, keys: Sequence[str], received: str, payload: str) -> DataFrame:
    """Keys that one time of receipt gives different payloads."""
    return rows.groupBy(*keys, received).agg(F.countDistinct(payload).alias("payloads")).where("payloads > 1")


def coverage(rows: DataFrame, by: str, expected: int, least: float, anchor: str) -> DataFrame:
    """Per symbol its share of the expected rows and whether it passes; the anchor is marked as required."""
    share = F.col("n_rows") / F.lit(float(expected))
    return rows.groupBy(by).agg(F.count("*").alias("n_rows")).select(by, "n_rows", fixed(share).alias("coverage"), (share >= least).alias("passes"), (F.col(by) == anchor).alias("required"))


def projected_volume(files: DataFrame, size: str, first_ms: str, last_ms: str) -> DataFrame:
    """Bytes, records and bytes a day at the observed rate; null if nothing lasted."""
    out = files.agg(F.sum(size).alias("total_bytes"), F.count("*").alias("total_records"), (F.max(last_ms) - F.min(first_ms)).alias("duration_ms"))
    return out.withColumn("bytes_per_day", F.when(F.col("duration_ms") > 0, div(F.col("total_bytes") * 86_400_000, 1) / F.col("duration_ms"))).withColumn("bytes_per_day", fixed(F.col("bytes_per_day"), 2))


def retention(raw: DataFrame, audited: DataFrame, path: str, size: str, digest: str, date: str, cutoff: str) -> DataFrame:
    """What may go: raw files before the cutoff whose audit agrees; the others with what blocks them."""
    a = audited.select(F.col(path), F.col(size).alias("_size"), F.col(digest).alias("_digest"))
    verdict = (
        F.when(F.col(date) >= cutoff, "kept")
        .when(F.col("_digest").isNull(), "not_audited")
        .when(F.col("_size") != F.col(size), "size_mismatch")
        .when(F.col("_digest") != F.col(digest), "digest_mismatch")
        .otherwise("candidate")
    )
    return raw.join(a, path, "left").withColumn("verdict", verdict).drop("_size", "_digest")


def acceptance(found: DataFrame) -> DataFrame:
    """clean without issues, gapped with gap warnings only, else rejected; from (code, severity, issues)."""
    errors = F.count_if((F.col("severity") == "error") | ~F.col("code").endswith("_gap"))
    return found.agg(F.when(F.count("*") == 0, "clean").when(errors == 0, "gapped").otherwise("rejected").alias("verdict"))


def file_order(rows: DataFrame, by: Sequence[str], order: str, time: str, id: str) -> DataFrame:
    """Rows of files that go back in time (backward) or repeat the id of the row before (repeated), in the files' order."""
    w = Window.partitionBy(*by).orderBy(order)
    problem = F.when(F.col(time) < F.lag(time).over(w), "backward").when(F.col(id) == F.lag(id).over(w), "repeated")
    return rows.withColumn("problem", problem).where("problem is not null")


def consistency(left: DataFrame, right: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """Violations by name: keys of left without a row of right (unmatched), repeated keys of right, and rules over the joined rows."""
    joined = left.join(right, key)
    broken = [F.count_if(F.coalesce(c, F.lit(True))).alias(n) for n, c in rules.items()]
    unmatched = left.join(right, key, "left_anti").agg(F.count("*").alias("unmatched"))
    repeated = right.groupBy(key).count().where("count > 1").agg(F.count("*").alias("repeated"))
    return joined.agg(*broken).crossJoin(unmatched).crossJoin(repeated)
