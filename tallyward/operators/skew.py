"""Equi-joins of a log with a list that survive hot keys.

A list that Spark estimates to be small is broadcast, and no key is hot then.
Otherwise both sides are shuffled by key, and rows of keys that hold too large a
share of the log are dealt to several tasks, with a copy of the key's list rows in
each. Adaptive execution does not do this by itself here, because it splits only
partitions that reach the join straight from a shuffle, and lists are mostly the
result of an aggregation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .features import quoted

# Keys with more than this share of all rows are hot: at most 1 / HOT_SHARE keys.
HOT_SHARE = 1 / 1_000
# Keys below this many rows are never hot.
HOT_FLOOR = 1_000_000
# A hot key gets this many times the tasks that its share of all rows stands for.
SPREAD = 2
# The sketches that look for hot keys track this many, with errors below HOT_SHARE.
TRACKED = 8192
# Sketches of tasks are merged in this many groups, then added up.
SKETCH_GROUPS = 256


def estimated_small(df: DataFrame) -> bool:
    """Would Spark broadcast this side of a join on its own estimate?"""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(stats.sizeInBytes()) <= limit


def hot_keys(
    rows: DataFrame,
    keys: Sequence[str],
    share: float = HOT_SHARE,
    floor: int = HOT_FLOOR,
) -> dict[int, float]:
    """Hashes of the hot keys with their shares of all rows.

    Sketches find them, and count the rows, in one pass without a shuffle of rows.
    Counts of the sketches are lower bounds, so there are at most 1 / share keys,
    few enough for the driver. Both sides of a join take them from there, so they
    agree on what is hot however the plan is executed.
    """
    hashed = rows.select(
        F.xxhash64(*keys).alias("_hash"),
        (F.spark_partition_id() % SKETCH_GROUPS).alias("_part"),
    )
    top = F.call_function(
        "approx_top_k", F.col("_hash"), F.lit(int(1 / HOT_SHARE)), F.lit(TRACKED)
    )
    sketches = hashed.groupBy("_part").agg(
        top.alias("_top"), F.count(F.lit(1)).alias("_rows")
    )
    # SKETCH_GROUPS rows at most.
    total = F.sum("_rows").over(Window.partitionBy()).alias("_total")
    found = (
        sketches.select("_top", total)
        .select("_total", F.inline("_top"))
        .groupBy("item", "_total")
        .agg(F.sum("count").alias("_rows"))
        .where(F.col("_rows") > F.greatest(F.col("_total") * share, F.lit(float(floor))))
    )
    return {r["item"]: r["_rows"] / r["_total"] for r in found.collect()}


def _holds_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def aligned(rows: DataFrame, listed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with keys of one type: numbers of two types get the wider one.

    Equal values of two types hash differently, so this holds for every plan.
    """
    for key in keys:
        mine, theirs = rows.schema[key].dataType, listed.schema[key].dataType
        if mine == theirs:
            continue
        if not (isinstance(mine, T.NumericType) and isinstance(theirs, T.NumericType)):
            raise ValueError(f"join key {key} differs in type: {mine} and {theirs}")
        wide = F.coalesce(F.lit(None).cast(mine), F.lit(None).cast(theirs)).alias("k")
        kind = rows.sparkSession.range(0).select(wide).schema["k"].dataType
        rows = rows.withColumn(key, quoted(key).cast(kind))
        listed = listed.withColumn(key, quoted(key).cast(kind))
    return rows, listed


def skew_join(
    rows: DataFrame,
    listed: DataFrame,
    keys: Sequence[str],
    how: str,
    share: float = HOT_SHARE,
    floor: int = HOT_FLOOR,
    salted: bool | None = None,
) -> DataFrame:
    """Join on equally named keys; `how` is inner, left, left_semi or left_anti.

    `salted` overrides the choice that is otherwise made on the list's size. Only
    the plan depends on it. A salted join looks for hot keys right away.
    """
    keys = list(keys)
    rows, listed = aligned(rows, listed, keys)
    if salted is None:
        salted = not estimated_small(listed)
    if not salted:
        return rows.join(listed, keys, how)
    hot = hot_keys(rows, keys, share, floor)
    if not hot:
        return rows.join(listed, keys, how)
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = [(k, max(2, math.ceil(SPREAD * tasks * part))) for k, part in hot.items()]
    # At most 1 / share rows, see `hot_keys`.
    table = F.broadcast(spark.createDataFrame(salts, "_hash bigint, _salts int"))

    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("_hash", F.xxhash64(*keys)).join(table, "_hash", "left")

    # A row's salt depends on its content and on the task that reads it, not on
    # the order of rows: a task that runs again deals them out the same way, and
    # copies of one row still spread over the tasks that hold them.
    content = [quoted(f.name) for f in rows.schema if not _holds_map(f.dataType)]
    turn = F.pmod(F.xxhash64(*content) + F.spark_partition_id(), F.col("_salts")).cast("int")
    dealt = (
        marked(rows)
        .withColumn("_salt", F.coalesce(turn, F.lit(0)))
        .select(*rows.columns, "_salt")
    )
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = (
        marked(listed).withColumn("_salt", F.explode(every)).select(*listed.columns, "_salt")
    )
    return dealt.join(copies, [*keys, "_salt"], how).drop("_salt")
