"""Threshold rules over group features: grids, mining, matching.

A rule is a conjunction with one threshold per grid feature, and the threshold
BELOW_GRID means "below the lowest grid point". Which rules a group meets
depends only on its cell: per feature, how many grid points its value reaches.
Cells are bounded by the grid, however many groups there are. Mining sums
groups into cells and then spreads one feature after the other over the
thresholds it reaches, adding up after each, so a step handles at most
(points + 1) rows per remaining cell instead of all conjunctions at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import floor, prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import BELOW_GRID, GRID_DECIMALS, MINED_BUCKETS, MISSING_FEATURE
from ..functions.predicates import Condition, all_of, missing
from ..functions.scalars import json_number, json_texts
from .groups import GROUP_KEYS, check_schemas
from .skew import skew_join


# Cells are broadcast if the grid cannot have more of them than this.
BROADCAST_CELLS = 1_000_000


@dataclass(frozen=True)
class GridDim:
    """Thresholds of one feature: low, low + step, ..., high."""

    feature: str
    low: float
    high: float
    step: float

    def __post_init__(self) -> None:
        if self.step <= 0 or self.high < self.low:
            raise ValueError(f"{self.feature}: need low <= high and step > 0")
        if self.low <= BELOW_GRID:
            raise ValueError(f"{self.feature}: thresholds must lie above {BELOW_GRID}")

    @property
    def most_points(self) -> int:
        return floor((self.high - self.low) / self.step) + 2


@dataclass(frozen=True)
class Strategy:
    schema: str
    grid: tuple[GridDim, ...]

    def __post_init__(self) -> None:
        names = [d.feature for d in self.grid]
        if not names or len(set(names)) != len(names):
            raise ValueError(f"{self.schema}: grid features must be given, once each")


def grid_points(low: Column, high: Column, step: Column) -> Column:
    """low, low + step, ... rounded, with `high` added if it is not reached."""
    points = F.transform(
        F.sequence(F.lit(0), F.floor((high - low) / step).cast("int")),
        lambda i: F.round(low + i * step, GRID_DECIMALS),
    )
    extended = F.array_append(points, high)
    return F.when(F.array_max(points) < high, extended).otherwise(points)


def grid_table(spark: SparkSession, strategies: Sequence[Strategy]) -> DataFrame:
    """(group_schema, dims): one row per strategy.

    `dims` lists a schema's features in order, each with its thresholds.
    """
    check_schemas([s.schema for s in strategies])
    rows = []
    for strategy in strategies:
        dims = [
            F.struct(
                F.lit(at).alias("at"),
                F.lit(d.feature).alias("feature"),
                grid_points(
                    *[F.lit(float(x)) for x in (d.low, d.high, d.step)]
                ).alias("thresholds"),
            )
            for at, d in enumerate(strategy.grid)
        ]
        rows.append(
            F.struct(
                F.lit(strategy.schema).alias("group_schema"),
                F.array(*dims).alias("dims"),
            )
        )
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def points_reached(number: Column, thresholds: Column) -> Column:
    """How many of the ascending thresholds a value reaches; a feature not there is -1."""
    held = F.array(F.coalesce(number, F.lit(MISSING_FEATURE)))
    # The outer lambda binds the value, which would else be made per threshold.
    return F.transform(held, lambda v: F.size(F.filter(thresholds, lambda t: t <= v)))[0]


def _cells(
    groups: DataFrame, grids: DataFrame, strategies: Sequence[Strategy], width: int
) -> DataFrame:
    """Groups of the gridded schemas with `_c0`..: points reached per feature.

    Schemas with fewer features than `width` have 0 in the columns left over.
    The features come from one parse of the JSON per group.
    """
    names = sorted({d.feature for s in strategies for d in s.grid})
    texts = [f"_v{k}" for k in range(len(names))]
    # A generator makes them, so nothing above parses the JSON again.
    placed = (
        groups.join(F.broadcast(grids), "group_schema")
        .select("*", F.json_tuple("feature_json", *names).alias(*texts))
    )
    cells = {}
    for i in range(width):
        value = F.lit(None).cast("double")
        for strategy in strategies:
            if i < len(strategy.grid):
                text = F.col(texts[names.index(strategy.grid[i].feature)])
                here = F.col("group_schema") == strategy.schema
                value = F.when(here, text.try_cast("double")).otherwise(value)
        points = F.get("dims", F.lit(i)).getField("thresholds")
        cells[f"_c{i}"] = F.coalesce(points_reached(value, points), F.lit(0))
    # The grid has one row per strategy of the spec.
    return placed.select(*groups.columns, *[c.alias(n) for n, c in cells.items()])


def _rule_columns(frame: DataFrame, grids: DataFrame, width: int) -> DataFrame:
    """Replace `_c0`.. by the rule: an array of (feature, threshold) and its text."""
    reached = F.array(*[F.col(f"_c{i}") for i in range(width)])
    rule = F.transform(
        F.col("dims"),
        lambda d, i: F.struct(
            d["feature"].alias("feature"),
            F.coalesce(
                F.get(d["thresholds"], F.get(reached, i) - 1), F.lit(BELOW_GRID)
            ).alias("threshold"),
        ),
    )
    text = F.array_join(
        F.transform(
            F.col("rule"),
            lambda t: F.concat(t["feature"], F.lit(" >= "), t["threshold"].cast("string")),
        ),
        " and ",
    )
    rest = [c for c in frame.columns if c != "group_schema" and not c.startswith("_c")]
    return (
        frame.join(F.broadcast(grids), "group_schema")
        .withColumn("rule", rule)
        .withColumn("rule_condition", text)
        .select("group_schema", "rule_condition", "rule", *rest)
    )


def _width(strategies: Sequence[Strategy]) -> int:
    return max(len(s.grid) for s in strategies)


def expand_rules(
    groups: DataFrame, strategies: Sequence[Strategy], measures: Mapping[str, Column]
) -> DataFrame:
    """Every rule some group meets, with additive measures over those groups.

    `measures` are sums, counts or other aggregates that `sum` merges.
    """
    grids = grid_table(groups.sparkSession, strategies)
    width = _width(strategies)
    axes = [f"_c{i}" for i in range(width)]
    again = [F.sum(n).alias(n) for n in measures]
    cells = (
        _cells(groups, grids, strategies, width)
        .groupBy("group_schema", *axes)
        .agg(*[c.alias(n) for n, c in measures.items()])
    )
    for axis in axes:
        points = F.when(
            F.col(axis) > 0, F.sequence(F.lit(1), F.col(axis))
        ).otherwise(F.array(F.lit(0)))
        cells = (
            cells.withColumn(axis, F.explode(points))
            .groupBy("group_schema", *axes)
            .agg(*again)
        )
    return _rule_columns(cells, grids, width)


ORDER_SUMS = (
    ("ord_cnt", "ord_cnt"),
    ("unpay_cnt", "unpay_cnt"),
    ("fail_cnt", "fail_cnt"),
    ("reliable_cnt", "re_cnt"),
    ("sum_order_amount", "sum_order_amount"),
    ("trust_ord_cnt", "trust_ord_cnt"),
    ("trust_sum_order_amount", "trust_sum_order_amount"),
    ("trust_unpay_cnt", "trust_unpay_cnt"),
    ("trust_fail_cnt", "trust_fail_cnt"),
)


def performance_join(
    groups: DataFrame, game: DataFrame, ug: DataFrame, ecom: DataFrame
) -> DataFrame:
    """Group features with the three label kinds as JSON, NULL where absent."""
    joined = groups
    for frame, name in ((game, "game_json"), (ug, "ug_json"), (ecom, "ecom_json")):
        labels = frame.select(*GROUP_KEYS, F.col("feature_json").alias(name))
        joined = joined.join(labels, list(GROUP_KEYS), "left")
    return joined


def with_labels(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """`performance_join` for labels that come as one frame, see `all_labels`."""
    return groups.join(labels, list(GROUP_KEYS), "left")


def _retention_measures(prefix: str) -> tuple[dict[str, Column], list[Column]]:
    parsed = F.col(f"_{prefix}")
    count = json_number(parsed, f"{prefix}_activation_cnt")
    measures = {f"{prefix}_activation_cnt": F.sum(count)}
    metrics = [F.col(f"{prefix}_activation_cnt")]
    for bucket in MINED_BUCKETS:
        scale = json_number(parsed, f"{prefix}_{bucket}_scale")
        known, scaled = f"{prefix}_{bucket}_activation_cnt", f"{prefix}_{bucket}_weight"
        measures[known] = F.sum(F.when(scale.isNotNull(), count))
        measures[scaled] = F.sum(scale * count)
        metrics.append(F.col(known))
        metrics.append(F.try_divide(scaled, known).alias(f"{prefix}_{bucket}_scale"))
    return measures, metrics


def _order_measures() -> tuple[dict[str, Column], list[Column]]:
    parsed = F.col("_ecom")
    measures = {out: F.sum(json_number(parsed, field)) for out, field in ORDER_SUMS}

    def over(name: str, top: str, bottom: str) -> Column:
        return F.try_divide(top, bottom).alias(name)

    metrics = [
        *[F.col(n) for n in ("ord_cnt", "unpay_cnt", "fail_cnt", "reliable_cnt")],
        over("unpay_ratio", "unpay_cnt", "ord_cnt"),
        over("fail_ratio", "fail_cnt", "ord_cnt"),
        F.col("sum_order_amount"),
        over("order_amount_avg", "sum_order_amount", "ord_cnt"),
        F.col("trust_ord_cnt"),
        F.col("trust_sum_order_amount"),
        F.col("trust_unpay_cnt"),
        F.col("trust_fail_cnt"),
        over("trust_unpay_ratio", "trust_unpay_cnt", "trust_ord_cnt"),
        over("trust_fail_ratio", "trust_fail_cnt", "trust_ord_cnt"),
        over("trust_order_amount_avg", "trust_sum_order_amount", "trust_ord_cnt"),
    ]
    return measures, metrics


def _kind_fields() -> dict[str, list[str]]:
    fields = {"ecom": [field for _, field in ORDER_SUMS]}
    for prefix in ("ug", "game"):
        fields[prefix] = [f"{prefix}_activation_cnt"]
        fields[prefix] += [f"{prefix}_{b}_scale" for b in MINED_BUCKETS]
    return fields


def mine_strategies(
    performance: DataFrame, strategies: Sequence[Strategy]
) -> DataFrame:
    """(group_schema, rule_condition, rule, one column per metric).

    `performance` is the output of `performance_join`. A rule appears if a group
    that meets it has a label of any kind; metrics of absent kinds are NULL.
    All three kinds come from one expansion.
    """
    labelled = [~missing(F.col(f"{k}_json")) for k in ("ecom", "ug", "game")]
    any_label = reduce(
        lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in labelled]
    )
    rows = performance.where(any_label)
    for kind, fields in _kind_fields().items():
        rows = rows.withColumn(f"_{kind}", json_texts(F.col(f"{kind}_json"), fields))
    measures, metrics = _order_measures()
    for prefix in ("ug", "game"):
        more, shown = _retention_measures(prefix)
        measures |= more
        metrics += shown
    rules = expand_rules(rows, strategies, measures)
    return rules.select("group_schema", "rule_condition", "rule", *metrics)


def metric_names() -> list[str]:
    """Metrics of a mined rule, in table order."""
    orders = [
        "ord_cnt",
        "unpay_cnt",
        "fail_cnt",
        "reliable_cnt",
        "unpay_ratio",
        "fail_ratio",
        "sum_order_amount",
        "order_amount_avg",
        "trust_ord_cnt",
        "trust_sum_order_amount",
        "trust_unpay_cnt",
        "trust_fail_cnt",
        "trust_unpay_ratio",
        "trust_fail_ratio",
        "trust_order_amount_avg",
    ]
    kinds = []
    for prefix in ("ug", "game"):
        kinds.append(f"{prefix}_activation_cnt")
        for bucket in MINED_BUCKETS:
            kinds += [f"{prefix}_{bucket}_activation_cnt", f"{prefix}_{bucket}_scale"]
    return orders + kinds


def strategies_json(mined: DataFrame) -> DataFrame:
    """(group_schema, rule_condition, ad_performance_json), the table form."""
    metrics = F.struct(*[F.col(n) for n in metric_names()])
    return mined.select(
        "group_schema", "rule_condition", F.to_json(metrics).alias("ad_performance_json")
    )


def good_rules(strategies: DataFrame, targets: Sequence[Condition]) -> DataFrame:
    """Rules whose metrics meet every target; a NULL metric drops the rule.

    Targets are conditions on metric names, which are read as doubles.
    """
    if not targets:
        raise ValueError("no optimisation targets given")
    names = metric_names()
    parsed = strategies.select(
        "group_schema",
        "rule_condition",
        json_texts(F.col("ad_performance_json"), names).alias("_metrics"),
    )
    metrics = [json_number(F.col("_metrics"), n).alias(n) for n in names]
    return (
        parsed.select("group_schema", "rule_condition", *metrics)
        .where(all_of(*targets))
        .select("group_schema", "rule_condition")
    )


def _rule_cells(rules: DataFrame, grids: DataFrame, width: int) -> DataFrame:
    """Rules of the current grid as cells; any other rule text can match nothing."""
    parts = F.array(F.split("rule_condition", " and "))
    # The outer lambda binds the parts of the text, so it is split once per rule.
    steps = F.transform(
        parts,
        lambda texts: F.transform(
            F.col("dims"),
            lambda d, i: F.array_position(
                d["thresholds"],
                F.element_at(F.split(F.get(texts, i), " >= "), -1).try_cast("double"),
            ).cast("int"),
        ),
    )[0]
    cells = rules.join(F.broadcast(grids), "group_schema").withColumn("_steps", steps)
    axes = [
        F.coalesce(F.get("_steps", F.lit(i)), F.lit(0)).alias(f"_c{i}")
        for i in range(width)
    ]
    known = cells.select("group_schema", F.col("rule_condition").alias("given"), *axes)
    names = [f"_c{i}" for i in range(width)]
    kept = known.select("*", *[F.col(n).alias(f"kept{n}") for n in names])
    written = _rule_columns(kept, grids, width)
    return written.where(F.col("given") == F.col("rule_condition")).select(
        "group_schema", *[F.col(f"kept{n}").alias(n) for n in names]
    )


def match_patterns(
    groups: DataFrame,
    rules: DataFrame,
    strategies: Sequence[Strategy],
    broadcast_cells: int = BROADCAST_CELLS,
    **skew: float,
) -> DataFrame:
    """Distinct groups that meet at least one of the rules.

    The rules' cells are widened to every cell that meets a rule, feature by
    feature; for the last feature the lowest threshold says it all. What is
    joined to the groups is bounded by the grid, whatever the number of rules;
    beyond `broadcast_cells` it is joined by shuffling, with the groups of cells
    that many share spread out.
    """
    grids = grid_table(groups.sparkSession, strategies)
    width = _width(strategies)
    axes = [f"_c{i}" for i in range(width)]
    inner, last = axes[:-1], axes[-1]
    points = grids.select(
        "group_schema", F.transform("dims", lambda d: F.size(d["thresholds"])).alias("_points")
    )
    hit = (
        _rule_cells(rules, grids, width)
        .groupBy("group_schema", *inner)
        .agg(
            F.min(F.when(F.col(last) > 0, F.col(last))).alias("_from"),
            F.coalesce(F.bool_or(F.col(last) == 0), F.lit(False)).alias("_below"),
        )
    )
    for i, axis in enumerate(inner):
        above = F.sequence(F.col(axis), F.get("_points", F.lit(i)))
        spread = F.when(F.col(axis) > 0, above).otherwise(F.array(F.lit(0)))
        hit = (
            hit.join(F.broadcast(points), "group_schema")
            .withColumn(axis, F.explode(spread))
            .groupBy("group_schema", *inner)
            .agg(F.min("_from").alias("_from"), F.bool_or("_below").alias("_below"))
        )
    bound = sum(
        prod(d.most_points + 1 for d in s.grid[: width - 1]) for s in strategies
    )
    matched = (F.col(last) >= F.col("_from")) | ((F.col(last) == 0) & F.col("_below"))
    placed = _cells(groups, grids, strategies, width)
    keys = ["group_schema", *inner]
    if bound <= broadcast_cells:
        found = placed.join(F.broadcast(hit), keys)
    else:
        found = skew_join(placed, hit, keys, "inner", salted=True, **skew)
    return found.where(matched).select(*groups.columns).distinct()
