"""Joins in time. Each is dealt by key and bucket of time, so that one busy symbol is many tasks' work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import div


def asof(
    probes: DataFrame, records: DataFrame, by: Sequence[str], probe_time: str, record_time: str, values: Sequence[str],
    order: Sequence[str] = (), forward: bool = False, inclusive: bool = True, bucket_ns: int = 86_400_000_000_000, most_age: int | None = None, reason: str | None = None,
) -> DataFrame:
    """probes with the values of the last record at or before each (forward: the first at or after).

    Records at equal times go by order; the last of them counts backward, the first forward. Where no record is near, values
    are null. most_age: a record that is further away counts as none. reason: a column that says "missing" or "stale" where there is
    no value, else null. Within a bucket the nearest record comes from one window over probes and records; a probe without one in its bucket takes
    that of the nearest bucket with records, of which there is one row per bucket.
    """
    names = probes.columns
    kept = list(values)
    if most_age is not None or reason:
        values = [*values, record_time] if record_time not in kept else values
    stamp = F.struct(F.col(record_time).alias("t"), *(F.col(c) for c in order))
    packed = F.struct(*(F.col(v).alias(v) for v in values))
    r = records.where(F.col(record_time).isNotNull()).select(*by, F.col(record_time).alias("_t"), stamp.alias("_o"), packed.alias("_v"))
    r = r.withColumn("_b", div(F.col("_t"), bucket_ns))
    p = probes.select(*by, F.col(probe_time).alias("_t"), F.struct(*names).alias("_p")).withColumn("_b", div(F.col("_t"), bucket_ns))
    # at equal times records stand before probes, or after them, as the direction and inclusive ask
    record_tag, probe_tag = (0, 1) if inclusive != forward else (1, 0)
    both = r.select(*by, "_b", "_t", F.lit(record_tag).alias("_tag"), "_o", "_v", F.lit(None).cast(p.schema["_p"].dataType).alias("_p")).unionByName(
        p.select(*by, "_b", "_t", F.lit(probe_tag).alias("_tag"), F.lit(None).cast(r.schema["_o"].dataType).alias("_o"), F.lit(None).cast(r.schema["_v"].dataType).alias("_v"), "_p")
    )
    # forward is backward in the reverse order: a frame that grows costs one step a row, one that shrinks is summed anew for each
    turn = F.desc if forward else F.asc
    w = Window.partitionBy(*by, "_b").orderBy(turn("_t"), turn("_tag"), turn("_o")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nearest = F.last("_v", ignorenulls=True)
    found = both.withColumn("_near", nearest.over(w)).where("_p is not null")
    # the edge record of each bucket, and for each bucket the nearest one beyond it
    edge = F.min_by("_v", "_o") if forward else F.max_by("_v", "_o")
    buckets = r.groupBy(*by, "_b").agg(edge.alias("_edge"))
    wanted = p.select(*by, "_b").distinct().withColumn("_edge", F.lit(None).cast(r.schema["_v"].dataType))
    marks = buckets.withColumn("_k", F.lit(0)).unionByName(wanted.withColumn("_k", F.lit(1)))
    bw = Window.partitionBy(*by).orderBy(turn("_b")).rangeBetween(Window.unboundedPreceding, -1)
    beyond = marks.withColumn("_beyond", F.last("_edge", ignorenulls=True).over(bw)).where("_k = 1").select(*by, "_b", "_beyond")
    out = found.join(beyond, [*by, "_b"], "left")
    value = F.coalesce("_near", "_beyond")
    if most_age is None and not reason:
        return out.select("_p.*", *(value[v].alias(v) for v in kept))
    age = F.abs(F.col(f"_p.{probe_time}") - value[record_time])
    stale = age > most_age if most_age is not None else F.lit(False)
    told = F.when(value.isNull(), "missing").when(stale, "stale")
    return out.select("_p.*", *(F.when(told.isNull(), value[v]).alias(v) for v in kept), *([told.alias(reason)] if reason else []))


def range_pairs(left: DataFrame, right: DataFrame, by: Sequence[str], start: str, end: str, time: str, bucket_ns: int, open_start: bool = True) -> DataFrame:
    """Rows of left with each row of right whose time is in (start, end], or [start, end].

    An interval is dealt to the buckets that it touches and a point to its own, so the join is an equality on key and bucket. Columns of right
    other than by must not be columns of left.
    """
    spread = left.withColumn("_b", F.explode(F.sequence(div(F.col(start), bucket_ns), div(F.col(end), bucket_ns))))
    points = right.withColumn("_b", div(F.col(time), bucket_ns))
    inside = (F.col(time) > F.col(start)) if open_start else (F.col(time) >= F.col(start))
    return spread.join(points, [*by, "_b"]).where(inside & (F.col(time) <= F.col(end))).drop("_b")


def latest_by(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the last in an order that must be total. An aggregation with partial results before its shuffle."""
    names = rows.columns
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("_r")).select("_r.*")


def with_anchor(rows: DataFrame, anchor: str, time: str, values: Sequence[str], symbol: str = "symbol", prefix: str = "anchor_") -> DataFrame:
    """rows with the anchor symbol's values at the same time. The anchor has one row per time; Spark broadcasts it only if it is small."""
    side = rows.where(F.col(symbol) == anchor).select(time, *(F.col(v).alias(prefix + v) for v in values))
    return rows.join(side, time, "left")


def scenarios(rows: DataFrame, only: Column | None = None, **axes: Sequence) -> DataFrame:
    """Each row with each combination of the axes' values: arrays that are exploded, without a join. Rows for which only doesn't hold get the first values."""
    for name, values in axes.items():
        some = F.array(*(F.lit(v) for v in values))
        rows = rows.withColumn(name, F.explode(some if only is None else F.when(only, some).otherwise(F.slice(some, 1, 1))))
    return rows


def fallback(rows: DataFrame, samples: DataFrame, value: str, keys: Sequence[str], least: int) -> DataFrame:
    """rows with estimate: the mean of samples with the same keys if there are least, else of the same last key, else of all.

    One pass of grouping sets gives all means; the lookups are small and by key.
    """
    first, side = keys
    grouped = samples.groupingSets([[first, side], [side], []], first, side).agg(F.avg(value).alias("m"), F.count(value).alias("n"), F.grouping_id().alias("g"))
    full = grouped.where((F.col("g") == 0) & (F.col("n") >= least)).select(first, side, F.col("m").alias("_full"))
    sides = grouped.where((F.col("g") == 2) & (F.col("n") >= 1)).select(side, F.col("m").alias("_side"))
    total = grouped.where(F.col("g") == 3).select(F.col("m").alias("_all"))
    out = rows.join(full, [first, side], "left").join(sides, side, "left").crossJoin(F.broadcast(total))
    return out.withColumn("estimate", F.coalesce("_full", "_side", "_all")).drop("_full", "_side", "_all")
