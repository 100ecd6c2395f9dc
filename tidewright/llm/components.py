"""Connected components of an edge table by alternating large and small stars, without a graph on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SCRATCH, drop_folder, new_folder

MOST_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the least of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.least("m", "u").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it move to the least of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", "m")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the component's least node) of every node with an edge to another, from edges (a, b) of one type.

    Loops, repeated edges and both directions may occur; null ends don't. Each round ends in a written table. The number of rounds grows
    with the logarithm of the longest path.
    """
    ordered = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = new_folder(spark, "edges")
        df.write.option("compression", SCRATCH).parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    current, path = written(ordered)
    before = _state(current)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        past = path
        current, path = written(_small_star(_large_star(current)))
        drop_folder(spark, past)  # the next rounds read the new table only
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components didn't converge")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(current.select("b", "b").distinct())
