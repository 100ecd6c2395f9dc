import pytest
from pyspark.sql import functions as F

from tidewright.operators import gates


def test_execution_use(spark):
    rows = [("FULL_FILL", "TP_FIRST", 1.0), ("FULL_FILL", "AMBIGUOUS", 1.0), ("FULL_FILL", None, 1.0), ("FULL_FILL", "TIMEOUT", None), ("NO_FILL", None, None), ("LOST", "TIMEOUT", 1.0), (None, None, None)]
    df = spark.createDataFrame(rows, "fill_status string, outcome string, outcome_return_bps double")
    assert [r.use for r in df.select(gates.execution_use().alias("use")).collect()] == ["usable", "ambiguous", "ambiguous", "unpriced", "usable", "unknown_fill", "unknown_fill"]


def test_feature_profiles():
    names = ["a", *gates.CALENDAR, "b"]
    assert gates.feature_profile(names, "full") == names and gates.feature_profile(names, "no_calendar") == ["a", "b"]
    with pytest.raises(ValueError):
        gates.feature_profile(names[:3], "no_calendar")
    with pytest.raises(ValueError):
        gates.feature_profile(names, "some")


def test_parts_that_share_keys_fail(spark):
    a, b = (spark.createDataFrame(rows, "k long, v string") for rows in ([(1, "x"), (1, "y"), (None, "z")], [(2, "x")]))
    assert sorted(r.v for r in gates.disjoint_union([a, b], ["k"]).collect()) == ["x", "x", "y", "z"]
    for clash in ([(1, "w")], [(None, "w")]):
        with pytest.raises(Exception, match="parts share keys"):
            gates.disjoint_union([a, spark.createDataFrame(clash, "k long, v string")], ["k"]).collect()


def test_days_of_a_selection(spark):
    rows = [("2024-01-01", True, 1), ("2024-01-02", True, 1), ("2024-01-02", True, 1), ("2024-01-04", False, 1), ("2024-01-05", True, 2), ("2024-01-09", True, 1)]
    days = spark.createDataFrame(rows, "date string, complete boolean, version int").withColumn("date", F.col("date").cast("date"))
    found = gates.select_days(days, "2024-01-01", "2024-01-05", ["version"]).orderBy("date").collect()
    assert [r.verdict for r in found] == ["selected", "repeated", "missing", "incomplete", "other_parameters"]
    assert [r.verdict for r in gates.select_days(days.limit(0), "2024-01-01", "2024-01-02", ["version"]).collect()] == ["missing", "missing"]


def test_differences_of_nulls_and_universes(spark):
    a, b = (spark.createDataFrame(rows, "k long, v string") for rows in ([(1, None), (2, "x"), (3, "x")], [(1, None), (2, None), (4, "x")]))
    assert sorted(tuple(r) for r in gates.differences(a, b, "k", ["v"]).collect()) == [(2, "changed"), (3, "missing"), (4, "unexpected")]
    assert tuple(gates.same_universe(a, b, "k").first()) == (1, 1, 2, False)
    assert gates.same_universe(a, a.union(a), "k").first()["equal"]


def test_gates_of_odd_series(spark):
    rows = [("a", 1.0, 1.0, "Buy"), ("a", float("nan"), 1.0, "Sell"), ("a", None, float("inf"), None), ("b", 2.0, 1.0, "Sell")]
    found = gates.series_gate(spark.createDataFrame(rows, "symbol string, price double, size double, side string"), ["symbol"]).orderBy("symbol").collect()
    assert [tuple(r)[1:] for r in found] == [(3, 2, 1, 1, False), (1, 0, 0, 0, True)]
    assert gates.reason_counts(spark.createDataFrame(rows, "symbol string, price double, size double, side string"), ["symbol"], {"no_price": F.col("price").isNull()}).collect() == [("a", "no_price", 1)]
