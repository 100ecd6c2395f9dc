"""Splits in time, calibration, metrics, expectations and reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import div

# The outcomes and the calibration grid.
CLASSES = ("TP_FIRST", "SL_FIRST", "TIMEOUT")
TEMPERATURES = (0.5, 0.75, 1.0, 1.25, 1.5, 2.0, 3.0, 5.0)
PRIOR_WEIGHTS = (0.0, 0.1, 0.25, 0.5, 0.75)

#: Rows that a logistic fit takes at most.
FIT_ROWS = 500_000
#: Ranges of values in which ranks are counted, and values drawn for each.
_RANGES, _DRAWN = 64, 20


@dataclass(frozen=True)
class Costs:
    """Basis points."""

    maker_fee: float = 2.0
    taker_fee: float = 5.5
    adverse_selection: float = 1.0
    stop_slippage: float = 3.0
    timeout_slippage: float = 1.0


def folds(bounds: DataFrame, test_ns: int, least_train_ns: int, most: int, first: str = "first_ns", last: str = "last_ns") -> DataFrame:
    """Test windows (fold, test_start_ns, test_end_ns): those that fit wholly after the least training time, the last ones, numbered from 1."""
    n = div(F.col(last) - F.col(first) - least_train_ns, test_ns)
    each = bounds.where(n > 0).select(F.explode(F.sequence(F.greatest(n - most, F.lit(0)), n - 1)).alias("i"), F.greatest(n - most, F.lit(0)).alias("skipped"), first)
    start = F.col(first) + least_train_ns + F.col("i") * test_ns
    return each.select((F.col("i") - F.col("skipped") + 1).cast("int").alias("fold"), start.alias("test_start_ns"), (start + test_ns).alias("test_end_ns"))


def membership(rows: DataFrame, windows: DataFrame, decision: str, label_end: str, embargo_ns: int, calibration_ns: int | None = None) -> DataFrame:
    """rows in each fold as test, train (or fit and calibration); rows that reach into a window or its embargo are purged.

    The windows are a handful of rows made from bounds, so they are exploded onto rows from one broadcast array.
    """
    listed = windows.agg(F.collect_list(F.struct("fold", "test_start_ns", "test_end_ns")).alias("_folds"))
    each = rows.crossJoin(F.broadcast(listed)).withColumn("_f", F.explode("_folds")).drop("_folds")
    start, end = F.col("_f.test_start_ns"), F.col("_f.test_end_ns")
    part = F.when((F.col(decision) >= start) & (F.col(decision) < end), "test")
    limit = start - embargo_ns
    if calibration_ns is None:
        part = part.when(F.col(label_end) <= limit, "train")
    else:
        from_ns = limit - calibration_ns
        part = part.when((F.col(decision) >= from_ns) & (F.col(label_end) <= limit), "calibration").when(F.col(label_end) <= from_ns - embargo_ns, "fit")
    return each.withColumn("fold", F.col("_f.fold")).withColumn("part", part).where("part is not null").drop("_f")


def holdout(bounds: DataFrame, times: DataFrame, decision: str, share: float = 0.7) -> DataFrame:
    """One test window (fold 1) from the time at a share of the distinct decisions to the end: for data too short for folds."""
    distinct = times.select(decision).distinct()
    place = int(distinct.count() * share)
    ordered = uniform_rank(distinct, decision).where(F.col("_place") == place)
    return ordered.crossJoin(bounds).select(F.lit(1).alias("fold"), F.col(decision).alias("test_start_ns"), (F.col("last_ns") + 1).alias("test_end_ns"))


def uniform_rank(rows: DataFrame, *order: str) -> DataFrame:
    """rows with _place, from 0, in an order: ranks within ranges of values and counts of those, not one window over all rows.

    The ranges' bounds are drawn once, at random, and then fixed. What range a row is in hence depends on its values alone, and the counts and the ranks
    agree although each is evaluated by itself.
    """
    names = rows.select(*order)
    drawn = rows.sparkSession.createDataFrame(names.orderBy(F.rand(7)).limit(_DRAWN * _RANGES).collect(), names.schema)
    bounds = drawn.agg(F.filter(F.array_sort(F.collect_list(F.struct(*order))), lambda x, i: i % _DRAWN == _DRAWN - 1).alias("_bounds"))
    at = F.struct(*order)
    dealt = rows.crossJoin(F.broadcast(bounds)).withColumn("_p", F.size(F.filter("_bounds", lambda b: b <= at))).drop("_bounds")
    starts = dealt.groupBy("_p").agg(F.count("*").alias("_n"))
    starts = starts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = dealt.join(F.broadcast(starts.select("_p", "_before")), "_p")
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return placed.withColumn("_place", rank - 1 + F.col("_before")).drop("_p", "_before")


def uniform_sample(rows: DataFrame, order: Sequence[str], most: int, y: str | None = None, classes: int = 3) -> DataFrame:
    """Rows at equally spaced places of an order: floor(i * (n - 1) / (most - 1)).

    y: a column of classes, 0 to classes - 1. A class that the sample misses takes the sample's slot of its own number, with the middle one
    of its rows in that order; a class that rows don't have is an error.
    """
    n = rows.count()
    if n <= most:
        return rows
    placed = uniform_rank(rows, *order)
    # a place is wanted if the next slot's floor passes it
    slot = F.ceil(F.col("_place").cast("decimal(20,0)") * (most - 1) / (n - 1))
    wanted = F.floor(slot.cast("decimal(20,0)") * (n - 1) / (most - 1)) == F.col("_place")
    if y is None:
        return placed.where(wanted).select(*rows.columns)
    seen = {r[0]: (r["n"], r["picked"]) for r in placed.groupBy(y).agg(F.count("*").alias("n"), F.count_if(wanted).alias("picked")).where(F.col(y).between(0, classes - 1)).collect()}
    missed = [k for k in range(classes) if not seen.get(k, (0, 0))[1]]
    if any(k not in seen for k in missed):
        raise ValueError("a class has no row to learn from")
    for k in missed:
        middle = uniform_rank(placed.where(F.col(y) == k).select(F.col("_place").alias("_at")), "_at").where(F.col("_place") == seen[k][0] // 2).first()["_at"]
        wanted = (wanted & (F.col("_place") != k * (n - 1) // (most - 1))) | (F.col("_place") == middle)
    return placed.where(wanted).select(*rows.columns)


def calibrated(probabilities: Column, temperature: Column, weight: Column, prior: Column) -> Column:
    """Softmax of the log-probabilities over a temperature, mixed with a prior; clipped at 1e-12 and scaled to sum 1."""
    powers = F.transform(probabilities, lambda p: F.exp(F.log(F.greatest(p, F.lit(1e-12))) / temperature))
    whole = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(powers, prior, lambda p, q: (1 - weight) * p / whole + weight * q)


def calibration_grid(rows: DataFrame, classes: int, prior: Column, temperatures: Sequence[float] = TEMPERATURES, weights: Sequence[float] = PRIOR_WEIGHTS) -> DataFrame:
    """Mean log-loss of each temperature and prior weight, from rows (probabilities, y).

    Logarithms are taken once a row, rows are repeated per temperature only, and all weights are averaged in one pass.
    """
    logs = rows.select("y", *(F.log(F.greatest(F.element_at("probabilities", i + 1), F.lit(1e-12))).alias(f"l{i}") for i in range(classes)))
    each = logs.withColumn("temperature", F.explode(F.array(*(F.lit(t) for t in temperatures))))
    each = each.select("y", "temperature", *(F.exp(F.col(f"l{i}") / F.col("temperature")).alias(f"e{i}") for i in range(classes)))
    whole = sum((F.col(f"e{i}") for i in range(1, classes)), start=F.col("e0"))
    own = F.col("e0")
    for i in range(1, classes):
        own = F.when(F.col("y") == i, F.col(f"e{i}")).otherwise(own)
    each = each.select("temperature", (own / whole).alias("q"), F.element_at(prior, F.col("y") + 1).alias("p"))
    means = [F.avg(-F.log(F.greatest((1 - F.lit(w)) * F.col("q") + F.lit(w) * F.col("p"), F.lit(1e-12)))).alias(f"w{j}") for j, w in enumerate(weights)]
    listed = F.array(*(F.struct(F.lit(w).alias("weight"), F.col(f"w{j}").alias("log_loss")) for j, w in enumerate(weights)))
    return each.groupBy("temperature").agg(*means).select("temperature", F.inline(listed))


def best_calibration(grid: DataFrame) -> DataFrame:
    """The identity unless another is better by more than 1e-15; the first in the order of temperature and weight at ties."""
    identity = (F.col("temperature") == 1.0) & (F.col("weight") == 0.0)
    order = F.struct(F.col("log_loss") + F.when(identity, 0.0).otherwise(1e-15), (~identity).cast("int"), "temperature", "weight")
    return grid.agg(F.min_by(F.struct("temperature", "weight", "log_loss"), order).alias("b")).select("b.*")


def class_prior(rows: DataFrame, y: str, classes: int) -> DataFrame:
    """Per class its count, share and smoothed share (n + 1) / (N + K)."""
    counted = rows.groupBy(F.col(y).alias("y")).agg(F.count("*").alias("n"))
    listed = rows.sparkSession.range(classes).select(F.col("id").cast("int").alias("y")).join(counted, "y", "left").select("y", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return listed.select("y", "n", (F.col("n") / total).alias("share"), ((F.col("n") + 1) / (total + classes)).alias("smoothed"))


def metrics(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Log-loss, Brier score and accuracy of rows (probabilities, y)."""
    p = F.transform("probabilities", lambda x: F.greatest(x, F.lit(1e-12)))
    whole = F.aggregate(p, F.lit(0.0), lambda a, x: a + x)
    q = F.transform(p, lambda x: x / whole)
    rows = rows.withColumn("_q", q)
    loss = -F.log(F.element_at("_q", F.col("y") + 1))
    brier = F.aggregate(F.transform("_q", lambda x, i: F.pow(x - F.when(i == F.col("y"), 1.0).otherwise(0.0), 2)), F.lit(0.0), lambda a, x: a + x)
    hit = (F.array_position("_q", F.array_max("_q")) - 1 == F.col("y")).cast("double")
    return rows.groupBy(*by).agg(F.avg(loss).alias("log_loss"), F.avg(brier).alias("brier"), F.avg(hit).alias("accuracy"), F.count("*").alias("n"))


def confidence_bins(rows: DataFrame, bins: int = 10) -> DataFrame:
    """Per bin of the largest probability: rows, mean confidence and accuracy; bins hold their lower edge, the last both."""
    top = F.array_max("probabilities")
    hit = (F.array_position("probabilities", top) - 1 == F.col("y")).cast("double")
    place = F.least(F.floor(top * bins), F.lit(bins - 1)).cast("int")
    return rows.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.avg(top).alias("confidence"), F.avg(hit).alias("accuracy"))


def expected_net_bps(p_profit: Column, p_stop: Column, p_timeout: Column, profit: Column, stop: Column, timeout: Column, funding: Column, costs: Costs = Costs()) -> Column:
    """A taker's expectation: distances by probability less fees, slippage and what funding may cost, weighted by the time-out."""
    gross = p_profit * profit - p_stop * stop + p_timeout * timeout
    fees = costs.maker_fee + p_profit * costs.maker_fee + (p_stop + p_timeout) * costs.taker_fee
    slippage = costs.adverse_selection + p_stop * costs.stop_slippage + p_timeout * costs.timeout_slippage
    return gross - fees - slippage - p_timeout * F.greatest(funding, F.lit(0.0))


def expected_execution_bps(p_full: Column, p_partial: Column, net_full: Column, unwind: Column) -> Column:
    return p_full * net_full - p_partial * unwind


def position_fraction(stressed_bps: Column, most_notional: float = 0.05, most_risk: float = 0.007) -> Column:
    """The share of equity whose stressed loss stays within the risk and whose notional stays within its own bound."""
    return F.least(F.lit(most_notional), F.lit(most_risk) / (stressed_bps / 10_000))


def realized_costs(outcome: Column, funding_due: Column, funding_bps: Column, costs: Costs = Costs()) -> Column:
    """Fees and slippage by outcome, and signed funding if it fell due."""
    exit_fee = F.when(outcome == "TP_FIRST", costs.maker_fee).otherwise(costs.taker_fee)
    slip = F.when(outcome == "SL_FIRST", costs.stop_slippage).when(outcome == "TIMEOUT", costs.timeout_slippage).otherwise(0.0)
    return F.lit(costs.maker_fee + costs.adverse_selection) + exit_fee + slip + F.when(funding_due, funding_bps).otherwise(0.0)


def top_candidates(candidates: DataFrame, decision: Sequence[str], value: str, threshold: float, ties: Sequence[Column]) -> DataFrame:
    """Per decision its best candidate at or above the threshold, counts, and the margin to the second; decisions without one go.

    An aggregation: the two largest of each decision come from arrays of at most its own candidates.
    """
    names = [c for c in candidates.columns if c not in decision]
    ok = F.col(value) >= threshold
    key = F.struct((-F.col(value)).alias("v"), *(t.alias(f"t{i}") for i, t in enumerate(ties)), F.struct(*names).alias("row"))
    picked = candidates.groupBy(*decision).agg(
        F.count("*").alias("candidates"), F.count_if(ok).alias("eligible"), F.min(F.when(ok, key)).alias("_top"), F.slice(F.sort_array(F.collect_list(F.when(ok, F.col(value))), asc=False), 1, 2).alias("_two")
    )
    margin = F.when(F.size("_two") > 1, F.element_at("_two", 1) - F.element_at("_two", 2))
    return picked.where("eligible > 0").select(*decision, *(F.col("_top.row")[n].alias(n) for n in names), "candidates", "eligible", margin.alias("margin"))


def rank_correlation(rows: DataFrame, left: str, right: str) -> DataFrame:
    """Pearson's and Spearman's coefficients; ties get mean ranks.

    Ranks come from counts of distinct values: the window runs over those, not over rows.
    """

    def ranks(name: str) -> DataFrame:
        values = rows.groupBy(F.col(name).alias(f"v_{name}")).agg(F.count("*").alias("_n"))
        before = F.coalesce(F.sum("_n").over(Window.orderBy(f"v_{name}").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return values.select(f"v_{name}", (before + (F.col("_n") - 1) / 2.0).alias(f"r_{name}"))

    a, b = ranks(left), ranks(right)
    out = rows.join(a, F.col(left) == F.col(f"v_{left}")).join(b, F.col(right) == F.col(f"v_{right}"))
    return out.agg(F.count("*").alias("n"), F.corr(left, right).alias("pearson"), F.corr(f"r_{left}", f"r_{right}").alias("spearman"))


def binned(value: Column, edges: Sequence[float]) -> Column:
    """The number of edges at or below a value."""
    return sum((F.when(value >= e, 1).otherwise(0) for e in edges), start=F.lit(0))


def importance(rows: DataFrame, name: str, value: str, most: int = 25) -> DataFrame:
    """Mean over folds, scaled to sum 1; the largest ones."""
    means = rows.groupBy(name).agg(F.avg(value).alias("m"))
    share = F.col("m") / F.sum("m").over(Window.partitionBy(F.lit(1)))
    return means.select(name, share.alias("importance")).orderBy(F.desc("importance"), name).limit(most)


def summary(rows: DataFrame, by: Sequence[str], pnl: str, ret: str) -> list[Column]:
    """Aggregates of a ledger: trades, mean, win rate, profit factor and compounded return."""
    gain, loss = F.sum(F.greatest(F.col(pnl), F.lit(0.0))), F.sum(F.greatest(-F.col(pnl), F.lit(0.0)))
    return [
        F.count("*").alias("trades"), F.avg(pnl).alias("mean_bps"), F.avg((F.col(pnl) > 0).cast("double")).alias("win_rate"),
        F.when(loss > 0, gain / loss).alias("profit_factor"), (F.exp(F.sum(F.log1p(ret))) - 1).alias("equity_return"),
    ]
