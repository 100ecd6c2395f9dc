"""Stored tables: partitioned Parquet with fixed schemas, published whole, with a manifest."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.scalars import utc_date
from ..operators.lineage import fingerprint
from ..schemas import check


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def read(spark: SparkSession, root: str, schema: StructType, columns: Sequence[str] | None = None, start: str | None = None, end: str | None = None, symbols: Sequence[str] | None = None) -> DataFrame:
    """A stored table; dates and symbols prune partitions, columns prune the scan."""
    df = spark.read.schema(StructType([*schema, StructField("date", StringType())]) if "date" not in schema.names else schema).parquet(root)
    if start:
        df = df.where(F.col("date") >= start)
    if end:
        df = df.where(F.col("date") <= end)
    if symbols:
        df = df.where(F.col("symbol").isin(list(symbols)))
    return df.select(*columns) if columns else df


def write(df: DataFrame, root: str, schema: StructType, time_ms: str, order: Sequence[str], records_per_file: int = 5_000_000) -> None:
    """Writes df under symbol= and date=, in order within each file.

    Rows are dealt by symbol, date and a salt that AQE's rebalancing adds as sizes ask for it, so that a busy symbol's day is
    several files and several tasks.
    """
    check(df, schema)
    dated = df.withColumn("date", utc_date(F.col(time_ms)))
    dealt = dated.hint("rebalance", "symbol", "date").sortWithinPartitions("symbol", "date", *order)
    dealt.write.partitionBy("symbol", "date").option("compression", "zstd").option("maxRecordsPerFile", records_per_file).mode("errorifexists").parquet(root)


def identify(**parameters) -> str:
    """An id of parameters: SHA-256 of their canonical JSON."""
    return hashlib.sha256(json.dumps(parameters, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def publish(df: DataFrame, root: str, dataset_id: str, schema: StructType, time_ms: str, order: Sequence[str], manifest: dict | None = None) -> str:
    """Publishes a dataset under its id, at once: written aside, then moved. What is published already is kept.

    The manifest, with the files' fingerprint, is written before the move, so a folder with the id's name is whole.
    """
    spark = df.sparkSession
    final, aside = f"{root}/{dataset_id}", f"{root}/.aside-{uuid.uuid4().hex}"
    fs, target = _fs(spark, final)
    if fs.exists(target):
        return final
    write(df, f"{aside}/data", schema, time_ms, order)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{aside}/data")
    listed = files.select(F.regexp_extract("path", r".*/data/(.*)$", 1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    digest = fingerprint(listed).first()
    body = json.dumps({"dataset_id": dataset_id, "files": digest["files"], "fingerprint": digest["fingerprint"], **(manifest or {})}, sort_keys=True)
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(f"{aside}/manifest")
    if not fs.rename(_fs(spark, aside)[1], target):
        raise OSError(f"can't publish {final}")
    return final


def validate(spark: SparkSession, path: str) -> dict:
    """The manifest of a published dataset, after all files' digests have been compared; raises if they differ."""
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{path}/data")
    listed = files.select(F.regexp_extract("path", r".*/data/(.*)$", 1).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    found = fingerprint(listed).first()
    if found is None or found["fingerprint"] != manifest["fingerprint"]:
        raise ValueError(f"{path} doesn't agree with its manifest")
    return manifest


def digests(files: DataFrame) -> DataFrame:
    """files (path and other columns) with found_size and found_sha256, read in pieces by the tasks; null for a file that isn't there."""
    import pyarrow as pa

    schema = StructType([*files.schema, StructField("found_size", LongType()), StructField("found_sha256", StringType())])

    def run(batches):
        from pyarrow import fs

        for batch in batches:
            sizes, hashes = [], []
            for path in batch.column(batch.schema.get_field_index("path")).to_pylist():
                store, name = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"file:///{path.removeprefix('file:').lstrip('/')}")
                total, digest = 0, hashlib.sha256()
                if store.get_file_info(name).type != fs.FileType.File:
                    sizes.append(None)
                    hashes.append(None)
                    continue
                with store.open_input_stream(name, compression=None) as stream:
                    while piece := stream.read(1 << 20):
                        total += len(piece)
                        digest.update(piece)
                sizes.append(total)
                hashes.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64()), pa.array(hashes, pa.string())], names=[*batch.schema.names, "found_size", "found_sha256"])

    return files.mapInArrow(run, schema)


def apply_retention(spark: SparkSession, candidates: DataFrame, receipt: str) -> int:
    """Removes the files of a plan (path, size, sha256, verdict) whose verdict is candidate.

    All of them are read again first, by tasks: if one is missing or its size or digest differs, nothing is removed and ValueError is raised.
    The receipt, a table, is written before the first removal. Files are listed to the driver in pieces, as only it can delete.
    """
    chosen = candidates.where("verdict = 'candidate'").select("path", "size", "sha256")
    digests(chosen).write.parquet(receipt)
    checked = spark.read.parquet(receipt)
    wrong = checked.where(~(F.col("size").eqNullSafe(F.col("found_size")) & F.col("sha256").eqNullSafe(F.col("found_sha256"))))
    if (first := wrong.orderBy("path").first()) is not None:
        raise ValueError(f"{first['path']} isn't the file of the plan; nothing was removed")
    n = 0
    for row in checked.select("path").toLocalIterator():
        fs, target = _fs(spark, row["path"])
        n += bool(fs.delete(target, False))
    return n
