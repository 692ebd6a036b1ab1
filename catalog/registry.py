"""Where the query modules register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Deals out every frequent key, as a log of billions of rows would have it.
SALTED = {"share": 1 / 5_000, "floor": 0, "salted": True}

# Averages of two-decimal values often fall exactly half-way between two
# roundings. A shift far below the last kept digit keeps the order in which
# doubles were added from deciding which way they go.
SHIFT = 3e-7
DIGITS = 5


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        ORACLE[name] = sql
        return function

    return register


def settled(column: Column | str) -> Column:
    return F.round(F.col(column) + SHIFT if isinstance(column, str) else column + SHIFT, DIGITS)


def settled_sql(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE) + {SHIFT:.7f}, {DIGITS})"


def settle(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: settled(n) for n in names})


def long_sql(wide: str, dkey: str, kinds: dict[str, str]) -> str:
    """SQL of the long form of `wide`, a query with dval and the features."""
    rows = [
        f"SELECT '{kind}' AS aggregator_type, '{dkey}' AS dkey, dval, "
        f"'{name}' AS fkey, {settled_sql(name)} AS fval FROM w"
        for name, kind in kinds.items()
    ]
    return f"SELECT * FROM (WITH w AS ({wide}) {' UNION ALL '.join(rows)})"
