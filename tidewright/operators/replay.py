"""Replays that depend on order: one position at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY_NS = 86_400_000_000_000


def one_position(picks: DataFrame, by: str, loss_limit: float = 0.01) -> DataFrame:
    """The picks that are traded when only one position may be open, per model.

    picks: by, decision_at_ns, exit_at_ns, size, pnl_bps: at most one per decision. A pick is passed over while a position is open (its
    end frees the slot) or while the losses of exits in the last 24 hours have reached the limit. A traded pick's result counts at once, with its
    later exit's time. The fold runs in the engine over each model's sorted picks; models are independent.
    Returns the traded picks with equity after each.
    """
    listed = picks.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("decision_at_ns", "exit_at_ns", "size", "pnl_bps"))).alias("p"))
    folded = listed.selectExpr(
        by,
        f"""aggregate(p,
          named_struct('until', cast(-1 as bigint), 'equity', 1D,
            'recent', cast(array() as array<struct<at: bigint, pnl: double>>),
            'out', cast(array() as array<struct<decision_at_ns: bigint, exit_at_ns: bigint, size: double, pnl_bps: double, equity: double>>)),
          (s, x) -> case
            when x.decision_at_ns < s.until then s
            when aggregate(filter(s.recent, r -> r.at >= x.decision_at_ns - {DAY_NS}), 0D, (a, r) -> a + r.pnl) <= {-loss_limit!r}D then s
            else named_struct(
              'until', x.exit_at_ns,
              'equity', s.equity * (1 + x.size * x.pnl_bps / 10000),
              'recent', concat(filter(s.recent, r -> r.at >= x.decision_at_ns - {DAY_NS}), array(named_struct('at', x.exit_at_ns, 'pnl', x.size * x.pnl_bps / 10000))),
              'out', concat(s.out, array(named_struct('decision_at_ns', x.decision_at_ns, 'exit_at_ns', x.exit_at_ns, 'size', x.size, 'pnl_bps', x.pnl_bps, 'equity', s.equity * (1 + x.size * x.pnl_bps / 10000)))))
          end,
          s -> s.out) AS out""",
    )
    return folded.select(by, F.inline("out"))


def one_position_in_pandas(picks: DataFrame, by: str, loss_limit: float = 0.01) -> DataFrame:
    """The same fold by applyInPandas, for ledgers whose output array would be long; it streams no more than one model per task."""
    import pandas as pd

    kind = dict(picks.dtypes)[by]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["decision_at_ns", "exit_at_ns", "size", "pnl_bps"])
        until, equity, recent, out = -1, 1.0, [], []
        for key, t, end, size, pnl in zip(pdf[by], pdf.decision_at_ns, pdf.exit_at_ns, pdf["size"], pdf.pnl_bps, strict=True):
            if t < until:
                continue
            recent = [r for r in recent if r[0] >= t - DAY_NS]
            if sum(r[1] for r in recent) <= -loss_limit:
                continue
            until, equity = end, equity * (1 + size * pnl / 10_000)
            recent.append((end, size * pnl / 10_000))
            out.append((key, t, end, size, pnl, equity))
        return pd.DataFrame(out, columns=[by, "decision_at_ns", "exit_at_ns", "size", "pnl_bps", "equity"])

    return picks.groupBy(by).applyInPandas(run, f"{by} {kind}, decision_at_ns long, exit_at_ns long, size double, pnl_bps double, equity double")


def execution_picks(picks: DataFrame, by: str) -> DataFrame:
    """Picks of resting orders as one_position takes them. picks also have fill_status, expires_at_ns, fill_fraction and unwind_bps.

    NO_FILL holds the slot until the order expires, without a result; PARTIAL_FILL is unwound then, at its share of the size; FULL_FILL runs to its exit.
    """
    status = F.col("fill_status")
    until = F.when(status == "FULL_FILL", F.col("exit_at_ns")).otherwise(F.col("expires_at_ns"))
    size = F.when(status == "PARTIAL_FILL", F.col("size") * F.col("fill_fraction")).otherwise(F.col("size"))
    pnl = F.when(status == "FULL_FILL", F.col("pnl_bps")).when(status == "PARTIAL_FILL", -F.col("unwind_bps")).otherwise(0.0)
    return picks.select(by, "decision_at_ns", until.alias("exit_at_ns"), size.alias("size"), pnl.alias("pnl_bps"))


def win_rate_of_positions(ledger: DataFrame, by: str) -> DataFrame:
    """Per model the attempts, positions (attempts with a result) and the share of positions that won."""
    return ledger.groupBy(by).agg(
        F.count("*").alias("attempts"), F.count_if(F.col("pnl_bps") != 0).alias("positions"),
        (F.count_if(F.col("pnl_bps") > 0) / F.nullif(F.count_if(F.col("pnl_bps") != 0), F.lit(0))).alias("win_rate"),
    )


def drawdown(ledger: DataFrame, by: str) -> DataFrame:
    """The ledger with peak and drawdown, 1 - equity over its running peak (of at least 1)."""
    w = Window.partitionBy(by).orderBy("decision_at_ns").rowsBetween(Window.unboundedPreceding, 0)
    return ledger.withColumn("peak", F.greatest(F.lit(1.0), F.max("equity").over(w))).withColumn("drawdown", 1 - F.col("equity") / F.col("peak"))


def throttle(rows: DataFrame, by: str, time: str, interval: int, force: str | None = None) -> DataFrame:
    """Rows that a greedy throttle emits: the first, then each that comes interval or more after the last emitted; forced rows always."""
    listed = rows.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), (F.col(force) if force else F.lit(False)).alias("f")))).alias("p"))
    folded = listed.selectExpr(
        by,
        f"""aggregate(p, named_struct('last', cast(null as bigint), 'out', cast(array() as array<bigint>)),
          (s, x) -> if(s.last is null or x.f or x.t - s.last >= {interval}, named_struct('last', x.t, 'out', concat(s.out, array(x.t))), s), s -> s.out) AS out""",
    )
    return folded.select(by, F.explode("out").alias(time))
