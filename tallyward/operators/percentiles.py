"""Exact percentiles of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups with more distinct values are cut into so many slices of their values. Where
# the cuts lie is approximate and decides only how much of a group one task sorts.
FEW = 10_000
SLICES = 64
CUT_ACCURACY = 1000


def exact_percentiles(
    rows: DataFrame, by: Sequence[str], wanted: Sequence[tuple[str, str, float]]
) -> DataFrame:
    """(by, one column per entry of `wanted`: name, column, p).

    A percentile is the smallest value that at least the share p of a group's values
    does not exceed. Values are counted once per group and ranked by running counts.
    Where a group has very many, running counts over slices tell which slice holds a
    percentile, and only that slice is sorted. Whether one has, a sketch tells while
    the query is built.
    """
    by = list(by)
    columns = list(dict.fromkeys(column for _, column, _ in wanted))
    types: dict[str, list[str]] = {}
    for field in rows.select(*columns).schema:
        types.setdefault(field.dataType.simpleString(), []).append(field.name)
    held = rows.groupBy(*by).agg(F.greatest(F.lit(0), *[F.approx_count_distinct(c) for c in columns]).alias("_n"))
    ranked = _in_slices if (held.agg(F.max("_n")).first()[0] or 0) > FEW else _whole
    frames = [
        ranked(rows, by, alike, [w for w in wanted if w[1] in alike]) for alike in types.values()
    ]
    found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    names = [name for name, _, _ in wanted]
    # Every frame has each group once, NULL groups included; a join would need them compared.
    return found.groupBy(*by).agg(*[F.max(_exact(n)).alias(n) for n in names])


def _exact(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")



def _counted(rows: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Rows per value of a group; NULLs weigh nothing, and keep groups that have no value."""
    return (
        rows.select(*by, F.posexplode(F.array(*columns)).alias("_number", "_value"))
        .groupBy(*by, "_number", "_value")
        .agg(F.count("_value").alias("_n"))
    )


def _entries(columns: list[str], wanted: Sequence[tuple[str, str, float]]) -> Column:
    """Per column, the percentiles asked for, as decimals: a product of doubles may pass a whole rank."""
    return F.array(*[
        F.array(*[
            F.struct(
                F.lit(i).alias("_feature"),
                F.lit(str(Decimal(repr(float(p))))).cast("decimal(19,18)").alias("_p"),
            )
            for i, (_, column, p) in enumerate(wanted)
            if column == held
        ])
        for held in columns
    ])


def _rank() -> Column:
    return F.greatest(F.ceil(F.col("_all").cast("decimal(18,0)") * F.col("_p")).cast("long"), F.lit(1))


def _wide(answers: DataFrame, by: list[str], wanted: Sequence[tuple[str, str, float]]) -> DataFrame:
    return answers.groupBy(*by).agg(*[
        F.max(F.when(F.col("_feature") == i, F.col("_value"))).alias(name)
        for i, (name, _, _) in enumerate(wanted)
    ])


def _whole(
    rows: DataFrame,
    by: list[str],
    columns: list[str],
    wanted: Sequence[tuple[str, str, float]],
) -> DataFrame:
    whole = Window.partitionBy(*by, "_number")
    upto = whole.orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _counted(rows, by, columns).select(
        "*", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(whole).alias("_all")
    )
    asked = ranked.select("*", F.inline(F.get(_entries(columns, wanted), F.col("_number"))))
    found = (_rank() > F.col("_upto") - F.col("_n")) & (_rank() <= F.col("_upto"))
    return _wide(asked.withColumn("_value", F.when(found, F.col("_value"))), by, wanted)


def _in_slices(
    rows: DataFrame,
    by: list[str],
    columns: list[str],
    wanted: Sequence[tuple[str, str, float]],
) -> DataFrame:
    group = [*by, "_number"]
    counted = _counted(rows, by, columns)
    at = F.array(*[F.lit(i / SLICES) for i in range(1, SLICES)])
    # The condition always holds; it keeps this aggregation the one that is read below.
    cuts = (
        counted.where(F.col("_n") >= 0)
        .groupBy(*[F.col(c).alias(f"_of{i}") for i, c in enumerate(group)])
        .agg(
            F.percentile_approx("_value", at, F.lit(CUT_ACCURACY)).alias("_cuts"),
            F.count(F.lit(1)).alias("_distinct"),
        )
        .withColumn("_cuts", F.when(F.col("_distinct") > FEW, F.col("_cuts")))
    )
    match = [F.col(c).eqNullSafe(F.col(f"_of{i}")) for i, c in enumerate(group)]
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_value")))
    sliced = (
        counted.where(F.col("_n") >= 0)
        .join(cuts, reduce(lambda a, b: a & b, match))
        .select(*group, "_value", "_n", F.when(F.col("_cuts").isNull(), 0).otherwise(below).alias("_slice"))
    )
    whole = Window.partitionBy(*group)
    running = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    totals = sliced.groupBy(*group, "_slice").agg(F.sum("_n").alias("_n")).select(
        *[F.col(c).alias(f"_of{i}") for i, c in enumerate(group)],
        F.col("_slice").alias("_at"),
        (F.sum("_n").over(running) - F.col("_n")).alias("_before"),
        F.col("_n").alias("_held"),
        F.sum("_n").over(whole).alias("_all"),
    )
    entries = _entries(columns, wanted)
    number = F.col(f"_of{len(by)}")
    left = (
        totals.select("*", F.inline(F.get(entries, number)))
        .withColumn("_left", _rank() - F.col("_before"))
        .where((F.col("_left") > 0) & (F.col("_left") <= F.col("_held")))
        .drop("_before", "_held", "_all", "_p")
    )
    upto = Window.partitionBy(*group, "_feature").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    answers = (
        sliced.join(left, reduce(lambda a, b: a & b, match) & (F.col("_slice") == F.col("_at")))
        .withColumn("_upto", F.sum("_n").over(upto))
        .where((F.col("_left") > F.col("_upto") - F.col("_n")) & (F.col("_left") <= F.col("_upto")))
        .select(*by, "_feature", "_value")
    )
    value_type = rows.select(columns[0]).schema[0].dataType
    groups = cuts.select(
        *[F.col(f"_of{i}").alias(c) for i, c in enumerate(by)],
        F.lit(None).cast("int").alias("_feature"),
        F.lit(None).cast(value_type).alias("_value"),
    )
    return _wide(answers.unionByName(groups), by, wanted)
