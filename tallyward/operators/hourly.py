"""Trailing windows from stored hourly parts.

A window of a day that ends with every hour reads each event 24 times. Here an hour's
events are read once: the parts of all features of an entity are folded by (entity,
distinct key) and kept per hour, and a window adds up the hours' rows.

What is kept of an hour is one row per entity value and key, with the types the log
has, so NULLs and numbers stay what they are. Event orders and aggregates that cannot
be merged (deviations, exact percentiles, top-n with n > 1) are an error; sketches take
the place of the last two.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import all_of
from ..functions.scalars import joined
from .entity import Entity, FeatureGroup, wide_to_long
from .features import Branch, Inputs, TopNRatio, branch_inputs, plan_branches, quoted


@dataclass(frozen=True, eq=False)
class Kept:
    """One table of hourly parts: an entity's features that share a distinct key."""

    entity: Entity
    branch: Branch
    name: str

    @property
    def by(self) -> list[str]:
        return [f"_by{i}" for i in range(len(self.entity.dkey))]

    def inputs(self, rows: DataFrame) -> Inputs:
        found = branch_inputs(rows, self.branch)
        if found.again is None:
            names = [f.name for f in self.branch.features if any(p.merge is None for p in f.parts())]
            raise ValueError(f"cannot be merged over hours: {names}")
        return found


def kept_tables(group: FeatureGroup) -> list[Kept]:
    """The tables a group needs, named by entity and place."""
    tables = []
    for entity in group.entities:
        ranked = [f.name for f in entity.features if isinstance(f, TopNRatio) and f.n > 1]
        if entity.arrivals or ranked:
            raise ValueError(f"{entity.label}: event orders and top-n beyond one have no hourly parts: {ranked}")
        for number, branch in enumerate(plan_branches(entity.features)):
            tables.append(Kept(entity, branch, f"{entity.label}-{number}"))
    return tables


def hour_parts(log: DataFrame, group: FeatureGroup, kept: Kept, at: Sequence[str] = ()) -> DataFrame:
    """Parts of the rows of a log, per entity value and key, and per column of `at`."""
    rows = log.where(all_of(group.where))
    inputs = kept.inputs(rows)
    keys = [] if inputs.key is None else ["_key"]
    ready = rows.select(
        *at,
        *[quoted(c).alias(b) for c, b in zip(kept.entity.dkey, kept.by)],
        *[c.alias(n) for n, c in inputs.columns.items()],
        *([inputs.key.alias("_key")] if keys else []),
    )
    return ready.groupBy(*at, *kept.by, *keys).agg(*inputs.first)


def window_features(parts: Sequence[tuple[Kept, DataFrame]], empty_log: DataFrame) -> DataFrame:
    """Long features of a window from its hours' parts, one frame per kept table.

    `empty_log` has the log's columns; no row of it is read.
    """
    long = []
    for kept, rows in parts:
        inputs = kept.inputs(empty_log)
        if inputs.key is not None:
            rows = rows.groupBy(*kept.by, "_key").agg(*inputs.again)
        wide = rows.groupBy(*kept.by).agg(*inputs.merge).select(*kept.by, *inputs.finish)
        named = wide.select(joined(kept.by).alias("dval"), *[quoted(f.name) for f in kept.branch.features])
        long.append(wide_to_long(named, kept.entity.label, [(f.name, f.kind) for f in kept.branch.features]))
    return reduce(DataFrame.unionByName, long)
