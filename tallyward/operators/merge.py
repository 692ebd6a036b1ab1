"""Long features to one wide row per entity, and population statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import MERGE_DECIMALS, MISSING_FEATURE
from ..functions.scalars import TRANSFORMS, clip_top, transform
from .features import check_names


@dataclass(frozen=True)
class MergedFeature:
    """A column of the wide table: fill value, upper clip, unary transform."""

    name: str
    fill: float = MISSING_FEATURE
    clip: float | None = None
    func: str | None = None

    def __post_init__(self) -> None:
        if self.func and self.func not in TRANSFORMS:
            raise ValueError(f"{self.name}: unknown transform {self.func!r}")


def _mine(feature: MergedFeature, number: Column) -> Column:
    return F.when(F.col("fkey") == feature.name, number)


def _best(feature: MergedFeature) -> Column:
    """The greatest transformed, rounded value; the transformed clip is not rounded."""
    number = F.round(transform(feature.func, F.col("fval")), MERGE_DECIMALS)
    if feature.clip is not None:
        top = transform(feature.func, F.lit(float(feature.clip)))
        number = F.when(F.col("fval") >= feature.clip, top).otherwise(number)
    return F.max(_mine(feature, number))


def _counted(feature: MergedFeature) -> Column:
    """A value as the population statistics take it."""
    return _mine(feature, transform(feature.func, clip_top(F.col("fval"), feature.clip)))


def _filled(best: Column, feature: MergedFeature) -> Column:
    return F.coalesce(best, F.lit(float(feature.fill))).alias(feature.name)


def merge_parts(long: DataFrame, features: Sequence[MergedFeature]) -> DataFrame:
    """Per `dval` and feature what both outputs need: greatest value, count, mean, variance."""
    check_names(features)
    columns = []
    for at, feature in enumerate(features):
        mine = _counted(feature)
        columns += [
            _best(feature).alias(f"_best{at}"),
            F.count(mine).alias(f"_n{at}"),
            F.coalesce(F.avg(mine), F.lit(0.0)).alias(f"_avg{at}"),
            F.coalesce(F.var_pop(mine), F.lit(0.0)).alias(f"_var{at}"),
        ]
    return long.groupBy("dval").agg(*columns)


def wide_of_parts(
    parts: DataFrame, features: Sequence[MergedFeature], dkey: str = "dval"
) -> DataFrame:
    columns = [_filled(F.col(f"_best{at}"), f) for at, f in enumerate(features)]
    return parts.select(F.col("dval").alias(dkey), *columns)


def population_of_parts(parts: DataFrame, features: Sequence[MergedFeature]) -> DataFrame:
    """(fkey, avg_value, std_value): the means first, then squared distances from them.

    The means of all features are one row, so they go by way of the driver.
    """
    many = range(len(features))
    sums = [F.try_divide(F.sum(F.expr(f"_n{i} * _avg{i}")), F.sum(f"_n{i}")).alias(f"m{i}") for i in many]
    means = parts.agg(*sums).first()
    spread = [
        F.sqrt(
            F.try_divide(
                F.sum(
                    F.col(f"_n{i}") * (F.col(f"_var{i}") + F.pow(F.col(f"_avg{i}") - F.lit(means[i]).cast("double"), 2))
                ),
                F.sum(f"_n{i}"),
            )
        ).alias(f"_std{i}")
        for i in many
    ]
    rows = [
        F.struct(
            F.lit(f.name).alias("fkey"),
            F.round(F.lit(means[i]).cast("double"), MERGE_DECIMALS).alias("avg_value"),
            F.round(f"_std{i}", MERGE_DECIMALS).alias("std_value"),
        )
        for i, f in enumerate(features)
    ]
    return parts.agg(*spread).select(F.inline(F.array(*rows)))


def merge_wide(
    long: DataFrame, features: Sequence[MergedFeature], dkey: str = "dval"
) -> DataFrame:
    """One row per `dval`, one column per feature.

    Values are transformed, then rounded; a value at or above the clip becomes
    the transformed clip and is not rounded.
    """
    check_names(features)
    columns = [_filled(_best(feature), feature) for feature in features]
    return long.groupBy(F.col("dval").alias(dkey)).agg(*columns)


def population_stats(long: DataFrame, features: Sequence[MergedFeature]) -> DataFrame:
    """(fkey, avg_value, std_value) over all entities, in one aggregation."""
    check_names(features)
    sums = []
    for at, feature in enumerate(features):
        mine = _counted(feature)
        sums += [F.avg(mine).alias(f"_avg{at}"), F.stddev_pop(mine).alias(f"_std{at}")]
    rows = [
        F.struct(
            F.lit(feature.name).alias("fkey"),
            F.round(f"_avg{at}", MERGE_DECIMALS).alias("avg_value"),
            F.round(f"_std{at}", MERGE_DECIMALS).alias("std_value"),
        )
        for at, feature in enumerate(features)
    ]
    return long.agg(*sums).select(F.inline(F.array(*rows)))
