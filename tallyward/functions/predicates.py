"""Predicates: feature conditions, trailing windows, optimisation targets."""

from __future__ import annotations

from functools import reduce
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Condition = Union[Column, str, bool]
Value = Union[Column, str, int, float]


def condition(where: Condition) -> Column:
    """A predicate given as a Column, as SQL text, or as True for "all rows"."""
    if isinstance(where, bool):
        return F.lit(where)
    if isinstance(where, str):
        return F.expr(where) if where.strip() else F.lit(True)
    return where


def value(expression: Value) -> Column:
    """A value given as a Column, as SQL text, or as a constant."""
    if isinstance(expression, str):
        return F.expr(expression)
    if isinstance(expression, (int, float)):
        return F.lit(expression)
    return expression


def all_of(*conditions: Condition) -> Column:
    """The conjunction; conditions that are plainly True are left out."""
    kept = [
        condition(c)
        for c in conditions
        if c is not True and not (isinstance(c, str) and not c.strip())
    ]
    return reduce(lambda a, b: a & b, kept) if kept else F.lit(True)


def trailing_window(
    date: str, hour: str, hours: int, date_col: str = "date", hour_col: str = "hour"
) -> Column:
    """Rows of the `hours` hours that end with (date, hour).

    The date comparison alone is enough to prune date partitions; the exact one
    compares instants, so one-digit hours are handled as well.
    """
    if hours < 1:
        raise ValueError("a trailing window has at least one hour")
    pattern = "yyyyMMdd HH"
    end = F.unix_timestamp(F.lit(f"{date} {str(hour).zfill(2)}"), pattern)
    start = end - F.lit(3600 * (hours - 1))
    day = F.col(date_col).cast("string")
    clock = F.lpad(F.col(hour_col).cast("string"), 2, "0")
    moment = F.unix_timestamp(F.concat_ws(" ", day, clock), pattern)
    return (
        (day >= F.from_unixtime(start, "yyyyMMdd"))
        & (day <= F.lit(date))
        & (moment >= start)
        & (moment <= end)
    )


def in_window(
    df: DataFrame,
    date: str,
    hour: str,
    hours: int,
    date_col: str = "date",
    hour_col: str = "hour",
) -> DataFrame:
    """Rows of a trailing window; a day column that cannot read yyyyMMdd is an error."""
    kind = df.schema[date_col].dataType
    if not isinstance(kind, (T.StringType, T.IntegralType)):
        raise ValueError(f"{date_col} is {kind.simpleString()}, not a text or number like yyyyMMdd")
    return df.where(trailing_window(date, hour, hours, date_col, hour_col))


def missing(column: Column) -> Column:
    """NULL or empty text."""
    return column.isNull() | (column == "")
