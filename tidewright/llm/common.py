"""Plumbing shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Output bytes that a Python task gathers before it hands a batch back to the JVM.
FLUSH_BYTES = 4 << 20
#: Output rows of a batch.
FLUSH_ROWS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by name; any Hadoop-readable folder works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The whole text; a null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a whole URI: spark.checkpoint.dir, or an own one where that is unset and all run on one machine (tests)."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if context.getCheckpointDir() is None:
            if not (context.master.startswith("local[") or context.master == "local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewright-"))
        found = context.getCheckpointDir()
    path = context._jvm.org.apache.hadoop.fs.Path(found)
    whole = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Codec of tables that are read again soon. zstd asks the C library for megabytes a page, which the arenas of an executor's many threads then hold.
SCRATCH = "snappy"


def materialize(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Writes df to the shared folder and reads it back, so that its lineage ends in files that outlive any executor."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of the shared store by Hadoop's file system, whichever it is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], list[tuple]]], schema: str) -> DataFrame:
    """Maps each row of df by Python in Arrow batches.

    make() runs once per task and returns the function of a row (a dict) that gives a list of output tuples. Output
    leaves in batches of bounded size, so that long texts never gather in memory.
    """
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            names = batch.schema.names
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for values in zip(*(part.column(i).to_pylist() for i in range(len(names))), strict=True):
                    for out in one(dict(zip(names, values, strict=True))):
                        rows.append(out)
                        held += sum(len(x) if isinstance(x, (str, bytes)) else 8 * len(x) if isinstance(x, list) else 8 for x in out if x is not None)
                        if held >= FLUSH_BYTES or len(rows) >= FLUSH_ROWS:
                            yield to_batch(rows, arrow)
                            rows, held = [], 0
        if rows:
            yield to_batch(rows, arrow)

    return df.mapInArrow(run, schema)


#: Bytes of an Arrow batch on its way to a Python worker; Spark's own bound is 64 MB, for which JVM and worker both have to have room.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches from now on, as what a caller gets may run later; a smaller bound of the session's stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    found = re.fullmatch(r"(\d+)b?", spark.conf.get(key, None) or "")
    if not found or not 0 < int(found[1]) <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def release() -> None:
    """Gives memory that a task has freed back to the system; the worker lives on for other tasks."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


class TwoGenerations:
    """A cache of bounded size: what is used within two generations stays, the rest falls out."""

    __slots__ = ("limit", "new", "old")

    def __init__(self, limit: int) -> None:
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
        self.new[key] = value


def held_out(column: str = "doc_id") -> Column:
    """Whether a row is held out of training: crc32 of its id as text, modulo 5, is 0. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


#: A key with this share of all rows is frequent; at most 1 / HOT_SHARE keys are.
HOT_SHARE = 1e-3
HOT_LEAST = 100


def lookup(rows: DataFrame, key: str, found: DataFrame, apart: Column, hint: str | None = None) -> DataFrame:
    """rows with the columns of found (one row per key, n: rows that have it) where the key is there, else null.

    Keys with at least HOT_SHARE of the rows that found stands for are at most 1 / HOT_SHARE; they are broadcast. The others are joined
    by a shuffle, which rows with a frequent key enter under apart, a key of each row's own (a string), so that no task gets them all.
    hint: of the shuffle join, where it shall be the same at every size.
    """
    total = found.agg(F.sum("n")).first()[0] or 0
    least = max(HOT_LEAST, int(HOT_SHARE * total) + 1)
    values = [c for c in found.columns if c not in (key, "n")]
    hot = F.broadcast(found.where(F.col("n") >= least).select(F.col(key).alias("_hot"), F.struct(*values).alias("_hot_row")))
    cold = found.where(F.col("n") < least).select(F.hex(key).alias("_key"), F.struct(*values).alias("_row"))
    cold = cold.hint(hint) if hint else cold
    names = rows.columns
    out = rows.join(hot, F.col(key) == F.col("_hot"), "left")
    out = out.withColumn("_cold", F.coalesce(F.when(F.col("_hot").isNull(), F.hex(key)), F.concat(F.lit("-"), apart)))
    out = out.join(cold, F.col("_cold") == F.col("_key"), "left")
    row = F.coalesce("_hot_row", "_row")
    return out.select(*names, *(row[v].alias(v) for v in values))


#: Numbers of a broadcast that tells which rows can't be wanted.
BUCKETS = 1 << 20


def likely(rows: DataFrame, keys: DataFrame, key: str, other: bool = False) -> DataFrame:
    """rows whose key may be among keys (other: those whose key is not), by a broadcast of the keys' hashes modulo BUCKETS: at most BUCKETS numbers."""
    number = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
    buckets = F.broadcast(keys.select(number.alias("_bucket")).distinct())
    return rows.join(buckets, number == F.col("_bucket"), "left_anti" if other else "left_semi")
