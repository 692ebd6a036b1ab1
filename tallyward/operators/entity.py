"""Per-entity features as one long table: (aggregator_type, dkey, dval, fkey, fval)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import Condition, all_of
from ..functions.scalars import joined
from .features import (
    DistinctRatio,
    Feature,
    Percentile,
    TopNRatio,
    aggregate_inputs,
    branch_inputs,
    check_names,
    plan_branches,
    quoted,
)
from .iat import InterArrival, inter_arrival
from .topn import top_n_ratios

KINDS = ("count", "distinct_count", "ratio", "stats", "top_n_ratio", "iat")


@dataclass(frozen=True, eq=False)
class Entity:
    """What to compute per value of `dkey`."""

    dkey: tuple[str, ...]
    features: tuple[Feature, ...] = ()
    arrivals: tuple[InterArrival, ...] = ()

    def __post_init__(self) -> None:
        if isinstance(self.dkey, str) or not self.dkey:
            raise ValueError("give dkey as a tuple of column names")
        if any(isinstance(f, DistinctRatio) for f in self.features):
            raise ValueError("distinct_ratio is a group feature, not an entity feature")
        check_names([*self.features, *(f for a in self.arrivals for f in a.named())])

    @property
    def label(self) -> str:
        return "_".join(self.dkey)


@dataclass(frozen=True, eq=False)
class FeatureGroup:
    """Entities whose features come from one log, under one row condition."""

    name: str
    entities: tuple[Entity, ...]
    where: Condition = True

    def __post_init__(self) -> None:
        if not self.entities:
            raise ValueError(f"{self.name}: no entities given")
        check_names(
            [
                f
                for e in self.entities
                for f in (*e.features, *(n for a in e.arrivals for n in a.named()))
            ]
        )

    @property
    def kinds(self) -> tuple[str, ...]:
        used = {f.kind for e in self.entities for f in e.features}
        used |= {"iat" for e in self.entities if e.arrivals}
        return tuple(k for k in KINDS if k in used)


def wide_to_long(
    wide: DataFrame, dkey: str, kinds: Sequence[tuple[str, str]]
) -> DataFrame:
    """Columns to rows; `kinds` lists (feature, aggregator type)."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(kind).alias("aggregator_type"),
                F.lit(name).alias("fkey"),
                quoted(name).cast("double").alias("fval"),
            )
            for name, kind in kinds
        ]
    )
    return wide.select("dval", F.inline(pairs)).select(
        "aggregator_type", F.lit(dkey).alias("dkey"), "dval", "fkey", "fval"
    )


def _ranks(feature: Feature) -> bool:
    return isinstance(feature, TopNRatio) and feature.n > 1


def _aggregates(rows: DataFrame, entity: Entity) -> list[DataFrame]:
    features = [f for f in entity.features if not _ranks(f)]
    by = [f"_by{i}" for i in range(len(entity.dkey))]
    long = []
    for branch in plan_branches(features):
        inputs = branch_inputs(rows, branch)
        read = rows.select(
            *[quoted(c).alias(b) for c, b in zip(entity.dkey, by)],
            *[c.alias(n) for n, c in inputs.columns.items()],
            *([inputs.key.alias("_key")] if inputs.key is not None else []),
        )
        wide = aggregate_inputs(read, by, inputs).select(
            joined(by).alias("dval"), *[quoted(f.name) for f in branch.features]
        )
        kinds = [(f.name, f.kind) for f in branch.features]
        long.append(wide_to_long(wide, entity.label, kinds))
    return long


def passes(group: FeatureGroup) -> int:
    """How many times the features of a group read its log."""
    number = 0
    for entity in group.entities:
        ranked = [f for f in entity.features if _ranks(f)]
        number += len(plan_branches([f for f in entity.features if not _ranks(f)]))
        # Percentiles look for large entities first, an event order for hot ones.
        number += any(isinstance(f, Percentile) for f in entity.features)
        number += bool(ranked) + 2 * len(entity.arrivals)
    return number


def entity_features(log: DataFrame, group: FeatureGroup) -> DataFrame:
    """All features of all entities of a group.

    Kinds share passes over the log: plain features, distinct features and top
    keys of an entity take one; a further distinct key, top-n with n > 1 and each
    event order add theirs.
    """
    rows = log.where(all_of(group.where))
    long: list[DataFrame] = []
    for entity in group.entities:
        long.extend(_aggregates(rows, entity))
        tops = [f for f in entity.features if _ranks(f)]
        if tops:
            wide = top_n_ratios(rows, entity.dkey, tops)
            long.append(
                wide.select(
                    F.lit("top_n_ratio").alias("aggregator_type"),
                    F.lit(entity.label).alias("dkey"),
                    "dval",
                    "fkey",
                    "fval",
                )
            )
        for arrival in entity.arrivals:
            wide = inter_arrival(rows, entity.dkey, arrival)
            kinds = [(f.name, "iat") for f in arrival.named()]
            long.append(wide_to_long(wide, entity.label, kinds))
    return reduce(DataFrame.unionByName, long)
