"""Raw segments of JSON lines: kind/symbol/YYYY/MM/DD/part-*.jsonl. Files that are still written end in .partial and aren't read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def segments(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    """Lines with the file's path below root and their number. Of a date (YYYY-MM-DD) only that day's folders are listed and read.

    Line numbers count within a file, by the order of Spark's splits of it.
    """
    reader = spark.read.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", "true")
    folders = f"{root}/*/*/{date.replace('-', '/')}" if date else root
    try:
        text = reader.text(folders)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or not date:
            raise
        text = reader.text(root).limit(0)  # a day without a folder
    lines = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    path = F.regexp_extract("file", r"([^/]+/[^/]+/\d{4}/\d{2}/\d{2}/[^/]+)$", 1)
    lines = lines.withColumn("source_path", path)
    number = F.row_number().over(Window.partitionBy("file").orderBy("block", "place")).cast("long")
    return lines.select("value", "source_path", number.alias("source_line"))


def segment_stream(spark: SparkSession, root: str, files_per_batch: int = 100) -> DataFrame:
    """The same as a stream, by file; what bounds a batch is the number of files."""
    reader = spark.readStream.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(root)
    return lines.select("value", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+/\d{4}/\d{2}/\d{2}/[^/]+)$", 1).alias("source_path"), F.lit(None).cast("long").alias("source_line"))


def file_digests(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, bytes and sha256 of the files below root."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def trade_history(spark: SparkSession, path: str) -> DataFrame:
    """A day's trades in (gzipped) CSV with a header; all columns as text, typed by operators.parse.history_rows."""
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path)


def topics(symbols: list[str], depth: int = 50, intervals: list[str] | None = None) -> list[str]:
    """The feed's subscription keys."""
    out = []
    for s in symbols:
        out += [f"orderbook.{depth}.{s}", f"publicTrade.{s}", f"tickers.{s}", *(f"kline.{i}.{s}" for i in intervals or ["1", "5", "15"])]
    return out
