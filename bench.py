"""Times the headline queries and prints one line of JSON."""

import json
import os
import time

from tidewright.catalog import QUERIES
from tidewright.session import session

NAMES = (
    "ohlcv_bars", "anchor_relative_bars", "bar_realized_vol", "trailing_trade_aggregates", "prefix_sums", "asof_backward", "asof_forward", "range_join_counts",
    "triple_barrier_ticks", "triple_barrier_bars", "maker_fill_sizes", "continuity_windows", "latest_revision", "duplicate_vs_revision", "gap_audit",
    "book_depth", "purged_membership", "temperature_calibration_grid", "hierarchical_means", "top_candidate_per_decision", "one_position_replay", "breakdown_grouping_sets",
    "dataset_fingerprint", "retention_candidates",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["ohlcv_bars"](spark, sf).write.format("noop").mode("overwrite").save()  # starts the session's code
    took = {}
    for name in NAMES:
        start = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline queries, wall time", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()
