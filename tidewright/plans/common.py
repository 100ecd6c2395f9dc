"""How the queries are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import fixed


class Registry:
    """Queries by name with their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable:
        def register(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql is not None:
                self.sql[f.__name__] = sql
            return f

        return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: fixed(F.col(c), digits) for c in columns})


def r(x: str, digits: int = 6) -> str:
    """SQL that rounds x as fixed does."""
    return f"floor(({x}) * 1e{digits}::DOUBLE + 0.5) / 1e{digits}::DOUBLE"


def count(condition: Column) -> Column:
    return F.count_if(condition)
