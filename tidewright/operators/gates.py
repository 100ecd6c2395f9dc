"""Gates and counters between the steps of a build: what is usable, what is missing, what differs, and why rows were left out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import fixed
from .quality import causal

# Fixed values of the label and feature tables.
FILLS = ("NO_FILL", "PARTIAL_FILL", "FULL_FILL")
OUTCOMES = ("TP_FIRST", "SL_FIRST", "TIMEOUT")
CALENDAR = ("utc_hour_sin", "utc_hour_cos", "utc_weekday_sin", "utc_weekday_cos")
PROFILES = ("full", "no_calendar")
#: Edges of the expected net result in basis points, and the names of the bins; an edge belongs to the bin above it.
EXPECTED_EDGES = (2.0, 5.0, 10.0, 20.0)
EXPECTED_BINS = ("below_2", "2_to_5", "5_to_10", "10_to_20", "20_plus")


def execution_use(fill: str = "fill_status", outcome: str = "outcome", result: str = "outcome_return_bps") -> Column:
    """What an execution label is good for: usable, or why not.

    A fill that isn't full needs no outcome; a full one needs a known outcome and a price. Nulls are unknown.
    """
    full = F.col(fill) == "FULL_FILL"
    return (
        F.when(~F.coalesce(F.col(fill).isin(*FILLS), F.lit(False)), "unknown_fill")
        .when(full & ~F.coalesce(F.col(outcome).isin(*OUTCOMES), F.lit(False)), "ambiguous")
        .when(full & F.col(result).isNull(), "unpriced")
        .otherwise("usable")
    )


def feature_profile(features: Sequence[str], profile: str) -> list[str]:
    """The features of a profile, in their order. Leaving the calendar out takes all of its features to be there."""
    if profile not in PROFILES:
        raise ValueError(f"no such profile: {profile}")
    if profile == "full":
        return list(features)
    if missing := set(CALENDAR) - set(features):
        raise ValueError(f"features of the calendar are missing: {sorted(missing)}")
    return [f for f in features if f not in CALENDAR]


def reason_counts(rows: DataFrame, by: Sequence[str], reasons: dict[str, Column]) -> DataFrame:
    """How many rows of each group a reason holds for; a row may have several, and a reason without rows isn't listed.

    Counts are taken in one aggregation with partial results and set upright afterwards, so that rows aren't multiplied.
    """
    counts = [F.struct(F.lit(name).alias("reason"), F.count_if(F.coalesce(c, F.lit(False))).alias("n")) for name, c in reasons.items()]
    return rows.groupBy(*by).agg(F.array(*counts).alias("counts")).select(*by, F.inline("counts")).where("n > 0")


def series_gate(rows: DataFrame, by: Sequence[str], price: str = "price", size: str = "size", side: str = "side") -> DataFrame:
    """Per series how many prints have a price or size that isn't positive and finite or a side that is neither, and whether it passes."""
    sound = lambda c: F.coalesce((F.col(c) > 0) & ~F.isnan(c) & (F.col(c) < float("inf")), F.lit(False))
    out = rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_if(~sound(price)).alias("bad_price"),
        F.count_if(~sound(size)).alias("bad_size"),
        F.count_if(~F.coalesce(F.col(side).isin("Buy", "Sell"), F.lit(False))).alias("bad_side"),
    )
    return out.withColumn("valid", F.col("bad_price") + F.col("bad_size") + F.col("bad_side") == 0)


def symbol_gate(covered: DataFrame, by: str, least_symbols: int = 2) -> DataFrame:
    """One row: how many symbols pass, whether the required ones are there and pass, and the verdict of both; from quality.coverage."""
    passing, required = F.count_if("passes"), F.count_if("required")
    anchor = (required > 0) & (F.count_if(F.col("required") & ~F.col("passes")) == 0)
    return covered.agg(F.count(by).alias("symbols"), passing.alias("passing"), anchor.alias("anchor_passes"), ((passing >= least_symbols) & anchor).alias("accepted"))


def differences(approved: DataFrame, current: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Keys that are missing from current, unexpected in it, or changed in a value; keys are unique in each. Nulls equal each other."""
    a = approved.select(F.col(key), F.struct(*values).alias("_was"), F.lit(True).alias("_a"))
    c = current.select(F.col(key), F.struct(*values).alias("_is"), F.lit(True).alias("_c"))
    kind = F.when(F.col("_c").isNull(), "missing").when(F.col("_a").isNull(), "unexpected").when(~F.col("_was").eqNullSafe(F.col("_is")), "changed")
    return a.join(c, key, "full").select(key, kind.alias("kind")).where("kind is not null")


def same_universe(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys in left only, in right only, in both, and whether the sets are equal."""
    both = left.select(key, F.lit(1).alias("side")).union(right.select(key, F.lit(2))).groupBy(key).agg(F.bit_or("side").alias("sides"))
    only = [F.count_if(F.col("sides") == k).alias(name) for k, name in ((1, "left_only"), (2, "right_only"), (3, "common"))]
    return both.agg(*only).withColumn("equal", F.col("left_only") + F.col("right_only") == 0)


def disjoint_union(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """All rows of the parts; the plan fails where two parts hold the same keys. Rows that repeat within a part stay.

    Keys alone are aggregated for the check, and the rows meet them by an equi join, in which no row is lost or multiplied.
    """
    named = [p.withColumn("_part", F.lit(k)) for k, p in enumerate(parts)]
    rows = reduce(DataFrame.unionByName, named)
    shared = rows.groupBy(*keys).agg(F.min("_part").alias("_least"), F.max("_part").alias("_most"))
    checked = shared.select(*(F.col(k).alias(f"_k_{k}") for k in keys), (F.col("_least") != F.col("_most")).alias("_clash"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))
    fine = F.when(F.col("_clash"), F.raise_error(F.lit("parts share keys")).cast("boolean")).otherwise(True)
    return rows.join(checked, same).where(fine).drop("_part", "_clash", *(f"_k_{k}" for k in keys))


def select_days(catalog: DataFrame, first: str, last: str, parameters: Sequence[str], date: str = "date") -> DataFrame:
    """Each day of first to last, both included: whether the catalog has it, once, and with the parameters of the first day that it has.

    catalog: one row per day with date and complete. The days of a selection are few, whatever a day holds.
    """
    spark = catalog.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias(date))
    made = F.struct(*parameters)
    kept = catalog.where(F.col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    each = kept.groupBy(date).agg(F.count("*").alias("entries"), F.bool_and("complete").alias("complete"), F.min(made).alias("_low"), F.max(made).alias("_high"))
    wanted = kept.agg(F.min_by(made, date).alias("_wanted"))
    out = days.join(each, date, "left").crossJoin(F.broadcast(wanted))  # one row
    verdict = (
        F.when(F.col("entries").isNull(), "missing")
        .when(F.col("entries") > 1, "repeated")
        .when(~F.col("complete"), "incomplete")
        .when(~(F.col("_low").eqNullSafe(F.col("_wanted")) & F.col("_high").eqNullSafe(F.col("_wanted"))), "other_parameters")
        .otherwise("selected")
    )
    return out.select(date, verdict.alias("verdict"))


def stream_audit(rows: DataFrame, by: Sequence[str], exchange_ms: str, received_ns: str, order: Sequence[str], file: str, size: str, events: str | None = None) -> DataFrame:
    """Per stream its records, events, files, bytes, seconds and the longest gap between causal records (0 if none goes forward)."""
    from pyspark.sql import Window

    seen = causal(rows, by, received_ns, order)
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(F.col("causal"), F.col(exchange_ms)), ignorenulls=True).over(w)
    gap = F.when(F.col("causal"), F.col(exchange_ms) - before)
    out = seen.withColumn("_gap", gap).groupBy(*by).agg(
        F.count("*").alias("records"),
        (F.sum(events) if events else F.count("*")).alias("events"),
        F.countDistinct(file).alias("files"),
        F.sum(size).alias("bytes"),
        fixed((F.max(exchange_ms) - F.min(exchange_ms)) / 1000, 3).alias("duration_seconds"),
        F.greatest(F.coalesce(F.max("_gap"), F.lit(0)), F.lit(0)).alias("max_gap_ms"),
    )
    return out


def expected_bins(rows: DataFrame, expected: str, realized: str) -> DataFrame:
    """Count, mean and share of gains by bin of the expected result; bins without rows are listed, too."""
    place = sum(((F.col(expected) >= e).cast("int") for e in EXPECTED_EDGES), F.lit(0))
    found = rows.select(place.alias("place"), F.col(realized).alias("_r")).groupBy("place")
    found = found.agg(F.count("*").alias("n"), fixed(F.avg("_r")).alias("mean_bps"), fixed(F.count_if(F.col("_r") > 0) / F.count("*")).alias("win_rate"))
    names = rows.sparkSession.range(1).select(F.posexplode(F.array(*(F.lit(b) for b in EXPECTED_BINS))).alias("place", "bin"))
    return names.join(found, "place", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "mean_bps", "win_rate")
