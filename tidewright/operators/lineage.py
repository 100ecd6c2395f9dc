"""Fingerprints, journals and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ZERO = "0" * 64


def fingerprint(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """SHA-256 over (path, bytes, sha256) of files in order of their paths."""
    line = F.concat_ws("\x1f", F.col("path").cast("string"), F.col("bytes").cast("string"), "sha256")
    return files.groupBy(*by).agg(F.count("*").alias("files"), F.array_sort(F.collect_list(F.struct("path", line.alias("line")))).alias("l")).select(
        *by, "files", F.sha2(F.array_join(F.transform("l", lambda x: x["line"]), "\n"), 256).alias("fingerprint")
    )


def chain(events: DataFrame, by: str, order: str, body: str) -> DataFrame:
    """A hash chain per journal: sequence, previous_hash and event_hash = SHA-256 of previous_hash | body. A fold over each journal."""
    listed = events.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(body).alias("b")))).alias("l"))
    folded = listed.selectExpr(
        by,
        f"""aggregate(l, named_struct('h', '{ZERO}', 'out', cast(array() as array<struct<sequence: bigint, o: bigint, p: string, h: string>>)),
          (s, x) -> named_struct('h', sha2(concat(s.h, '|', x.b), 256), 'out', concat(s.out, array(named_struct('sequence', cast(size(s.out) + 1 as bigint), 'o', x.o, 'p', s.h, 'h', sha2(concat(s.h, '|', x.b), 256))))),
          s -> s.out) AS out""",
    )
    each = folded.select(by, F.explode("out").alias("e"))
    return each.select(by, "e.sequence", F.col("e.o").alias(order), F.col("e.p").alias("previous_hash"), F.col("e.h").alias("event_hash"))


def broken_links(journal: DataFrame, by: str, body: str) -> DataFrame:
    """Rows of a journal (sequence, previous_hash, event_hash) that don't follow from the row before."""
    w = Window.partitionBy(by).orderBy("sequence")
    expected = F.coalesce(F.lag("event_hash").over(w), F.lit(ZERO))
    checked = journal.withColumn("_p", expected).withColumn("_n", F.row_number().over(w))
    good = (F.col("_p") == F.col("previous_hash")) & (F.col("_n") == F.col("sequence")) & (F.sha2(F.concat("previous_hash", F.lit("|"), body), 256) == F.col("event_hash"))
    return checked.where(~good).drop("_p", "_n")


def consecutive(days: DataFrame, day: str) -> DataFrame:
    """days with consecutive: whether the day before is the row before (the first has one before it at -1). Days are few: one row each."""
    w = Window.orderBy(day)
    return days.withColumn("consecutive", F.col(day) - F.coalesce(F.lag(day).over(w), F.lit(-1)) == 1)


def manifest_mismatches(manifest: DataFrame, observed: DataFrame) -> DataFrame:
    """Files (path, bytes, sha256) that a manifest and a folder don't agree on: missing, extra, size or digest."""
    m, o = manifest.select("path", F.struct("bytes", "sha256").alias("m")), observed.select("path", F.struct("bytes", "sha256").alias("o"))
    both = m.join(o, "path", "full")
    problem = F.when(F.col("o").isNull(), "missing").when(F.col("m").isNull(), "extra").when(F.col("m.bytes") != F.col("o.bytes"), "size").when(F.col("m.sha256") != F.col("o.sha256"), "digest")
    return both.select("path", problem.alias("problem")).where("problem is not null")
