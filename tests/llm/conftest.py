import pytest
from odd_rows import DOCS, prose


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    rows = [
        (1, None, "en", "a", 7, "w", 1, 1), (2, "", "en", "a", 7, None, 1, 1), (3, " \t\n ", None, None, None, "w", None, None), (None, prose(1, 80), "en", "a", 1, "w", 1, 1),
        (4, prose(2, 80), "en", "a", 1, "w", 1, 1), (4, prose(2, 80), "en", "a", 1, "w", 1, 1), (5, prose(2, 80), "en", "b", 1, "w", 1, 1), (6, prose(3, 30_000), "en", "b", 1, "w", 1, 1),
        (7, "你好 世界 🙂 é́\x00\x1c ß", "zh", "b", 1, "w", 1, 1), (8, "a", "en", "b", 1, "w", 1, 1), (9, "### $$$ 123", "en", "c", 1, "w", 1, 1), (10, "x" * 5000, "en", "c", 1, "w", 1, 1),
        (-11, prose(4, 60), "en", "c", 1, "w", 1, 1), (None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
