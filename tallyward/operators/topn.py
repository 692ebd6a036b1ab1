"""Share of an entity's rows that fall on its most frequent keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import all_of
from ..functions.scalars import joined
from .features import TopNRatio, key_column

# Up to this n, Spark cuts the ranking in every task; it is the default of
# spark.sql.optimizer.windowGroupLimitThreshold. Beyond, keys are ranked in
# slices of the entity first: the n best are among the n best of each slice.
GROUP_LIMIT = 1000
SLICES = 256


def top_n_ratios(
    rows: DataFrame, dkey: Sequence[str], features: Sequence[TopNRatio]
) -> DataFrame:
    """(dval, fkey, fval): rows on the n most frequent keys over rows on all keys.

    Rows are counted per (entity, key) first. The rank filter is a literal bound
    right above the window, so Spark keeps only the best keys of each task before
    it brings an entity together.
    """
    by_columns: dict[tuple[str, ...], list[TopNRatio]] = {}
    for feature in features:
        by_columns.setdefault(tuple(feature.columns), []).append(feature)
    parts = [_for_key(rows, dkey, keys, fs) for keys, fs in by_columns.items()]
    return reduce(DataFrame.unionByName, parts)


def _leading(counted: DataFrame, most: int, *within: Column) -> DataFrame:
    """Keys that rank up to `most` in their entity, or in their slice of it."""
    order = Window.partitionBy("_by", "_feature", *within).orderBy(
        F.col("_hits").desc(), F.col("_key").desc()
    )
    ranked = counted.withColumn("_rank", F.dense_rank().over(order))
    return ranked.where(F.col("_rank") <= most)


def _for_key(
    rows: DataFrame,
    dkey: Sequence[str],
    keys: tuple[str, ...],
    features: list[TopNRatio],
) -> DataFrame:
    counted = (
        rows.select(
            key_column(rows, dkey).alias("_by"),
            key_column(rows, keys).alias("_key"),
            *[all_of(f.where).alias(f"_in{i}") for i, f in enumerate(features)],
        )
        .groupBy("_by", "_key")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count_if(f"_in{i}").alias(f"_hits{i}") for i in range(len(features))],
        )
        .select(
            "_by",
            joined(["_key"]).alias("_key"),
            "_rows",
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(i).alias("_feature"),
                            F.lit(f.n).alias("_n"),
                            F.col(f"_hits{i}").alias("_hits"),
                        )
                        for i, f in enumerate(features)
                    ]
                )
            ),
        )
    )
    most = max(f.n for f in features)
    best = counted.where(F.col("_hits") > 0)
    if most > GROUP_LIMIT:
        best = _leading(best, most, F.pmod(F.xxhash64("_key"), F.lit(SLICES)))
    top = (
        _leading(best, most)
        .where(F.col("_rank") <= F.col("_n"))
        .select(
            "_by",
            "_feature",
            F.col("_rows").alias("_top"),
            F.lit(0).cast("long").alias("_all"),
        )
    )
    total = counted.select(
        "_by",
        "_feature",
        F.lit(0).cast("long").alias("_top"),
        F.when(F.col("_hits") > 0, F.col("_rows")).otherwise(0).alias("_all"),
    )
    names = F.array(*[F.lit(f.name) for f in features])
    return (
        top.unionByName(total)
        .groupBy("_by", "_feature")
        .agg(F.sum("_top").alias("_top"), F.sum("_all").alias("_all"))
        .select(
            joined(["_by"]).alias("dval"),
            F.get(names, F.col("_feature")).alias("fkey"),
            F.try_divide("_top", "_all").alias("fval"),
        )
    )
