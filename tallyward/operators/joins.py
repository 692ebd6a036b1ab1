"""Lookup joins of a log with a list; see `skew` for how hot keys are handled.

Further keyword arguments (share, floor, salted) go to `skew_join`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import skew_join


def flag_join(
    rows: DataFrame, listed: DataFrame, key: str, flag: str, **skew: float | bool
) -> DataFrame:
    """Add a 0/1 column: is the row's key on the list?"""
    keys = listed.select(F.col(key)).distinct().withColumn("_listed", F.lit(1))
    return skew_join(rows, keys, [key], "left", **skew).select(
        *rows.columns, F.coalesce("_listed", F.lit(0)).alias(flag)
    )


def keep_listed(
    rows: DataFrame, listed: DataFrame, key: str, **skew: float | bool
) -> DataFrame:
    """Rows whose key is on the list, each once."""
    return skew_join(rows, listed.select(key), [key], "left_semi", **skew).select(*rows.columns)


def drop_listed(
    rows: DataFrame, listed: DataFrame, key: str, **skew: float | bool
) -> DataFrame:
    """Rows whose key is not on the list; a NULL key stays."""
    return skew_join(rows, listed.select(key), [key], "left_anti", **skew).select(*rows.columns)


def lowest_tag(tags: DataFrame, key: str, tag: str) -> DataFrame:
    """One row per key with its smallest tag."""
    return tags.groupBy(key).agg(F.min(tag).alias(tag))


def tag_lookup(
    rows: DataFrame, tags: DataFrame, key: str, tag: str, flag: str, **skew: float | bool
) -> DataFrame:
    """Add the lowest tag of the row's key, 0 if it has none."""
    return skew_join(rows, lowest_tag(tags, key, tag), [key], "left", **skew).select(
        *rows.columns, F.coalesce(F.col(tag), F.lit(0)).alias(flag)
    )


def cast_lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    dim_key: str,
    kind: str = "bigint",
    **skew: float | bool,
) -> DataFrame:
    """Inner join of a text key to a typed dimension key; bad texts match nothing."""
    typed = rows.withColumn("_typed", F.col(key).try_cast(kind))
    keyed = dimension.withColumn("_typed", F.col(dim_key))
    joined = skew_join(typed, keyed, ["_typed"], "inner", **skew)
    return joined.select(*rows.columns, *dimension.columns)
