"""The same features over many column combinations ("schemas") at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import Condition, all_of
from ..functions.scalars import joined
from .features import (
    Feature,
    Inputs,
    TopNRatio,
    aggregate_inputs,
    branch_inputs,
    check_names,
    join_on,
    plan_branches,
    quoted,
)

GROUP_KEYS = ("group_schema", "group_pattern")


def schema_columns(schema: str) -> list[str]:
    return [c.strip() for c in schema.split(",")]


def check_schemas(schemas: Sequence[str]) -> None:
    sets = [frozenset(schema_columns(s)) for s in schemas]
    if not sets:
        raise ValueError("no schemas given")
    if len(set(sets)) != len(sets):
        raise ValueError("schemas must differ as sets of columns")


@dataclass(frozen=True, eq=False)
class GroupSpec:
    """Schemas, each a comma list of columns, and the features of their patterns."""

    name: str
    schemas: tuple[str, ...]
    features: tuple[Feature, ...]
    where: Condition = True

    def __post_init__(self) -> None:
        check_schemas(self.schemas)
        check_names(self.features)
        if any(isinstance(f, TopNRatio) for f in self.features):
            raise ValueError("top_n_ratio is an entity feature, not a group feature")


def explode_schemas(
    rows: DataFrame, schemas: Sequence[str], columns: dict[str, Column]
) -> DataFrame:
    """`columns` of every row, once per schema with (_schema, group_pattern).

    The columns are computed before rows multiply, and rows carry the schema's
    position rather than its text.
    """
    patterns = F.array(
        *[joined([quoted(c) for c in schema_columns(s)]) for s in schemas]
    )
    ready = rows.select(
        patterns.alias("_patterns"), *[c.alias(n) for n, c in columns.items()]
    )
    return ready.select(
        F.posexplode("_patterns").alias("_schema", "group_pattern"), *columns
    )


def name_schemas(frame: DataFrame, schemas: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(s) for s in schemas])
    rest = [quoted(c) for c in frame.columns if c not in ("_schema", "group_pattern")]
    return frame.select(
        F.get(names, F.col("_schema")).alias("group_schema"), "group_pattern", *rest
    )


def group_features(log: DataFrame, spec: GroupSpec) -> DataFrame:
    """Wide (group_schema, group_pattern, one column per feature)."""
    rows = log.where(all_of(spec.where))
    by = ("_schema", "group_pattern")
    frames = []
    for branch in plan_branches(spec.features):
        inputs = branch_inputs(rows, branch)
        carried = dict(inputs.columns)
        if inputs.key is not None:
            carried["_key"] = inputs.key
        exploded = explode_schemas(rows, spec.schemas, carried)
        frames.append(aggregate_inputs(exploded, by, inputs))
    wide = join_on(frames, by).select(*by, *[quoted(f.name) for f in spec.features])
    return name_schemas(wide, spec.schemas)


def roll_up_plan(
    schemas: Sequence[str], finer: Sequence[str] = ()
) -> list[tuple[list[str], list[int]]]:
    """Column sets to aggregate from the log, each with the schemas derived from it.

    A schema is derived from the smallest set that holds its columns: another schema
    or one of `finer`, sets that are no schemas themselves. Sets nothing needs are left
    out.
    """
    sets = [schema_columns(s) for s in [*schemas, *finer]]
    roots = [c for c in sets if not any(set(c) < set(o) for o in sets)]
    plan: list[tuple[list[str], list[int]]] = [(r, []) for r in roots]
    for number, columns in enumerate(sets[: len(schemas)]):
        fitting = [p for p in plan if set(columns) <= set(p[0])]
        min(fitting, key=lambda p: len(p[0]))[1].append(number)
    return [p for p in plan if p[1]]


def root_partials(
    rows: DataFrame, roots: Sequence[Sequence[str]], inputs: Inputs
) -> DataFrame:
    """Rows folded by each root's columns (and key): what the first shuffle carries.

    Columns stay apart, so that coarser schemas can be read off them, and a column a
    root lacks is NULL, which `_root` tells from a NULL in the log.
    """
    names = list(dict.fromkeys(c for root in roots for c in root))
    types = {c: rows.select(quoted(c)).schema[0].dataType for c in names}
    versions = F.array(
        *[
            F.struct(
                F.lit(number).alias("_root"),
                *[
                    (quoted(c) if c in root else F.lit(None).cast(types[c])).alias(f"_c{i}")
                    for i, c in enumerate(names)
                ],
            )
            for number, root in enumerate(roots)
        ]
    )
    carried = dict(inputs.columns)
    if inputs.key is not None:
        carried["_key"] = inputs.key
    ready = rows.select(versions.alias("_versions"), *[c.alias(n) for n, c in carried.items()])
    spread = ready.select(F.inline("_versions"), *carried)
    by = ["_root", *[f"_c{i}" for i in range(len(names))]]
    keys = ["_key"] if inputs.key is not None else []
    return spread.groupBy(*by, *keys).agg(*inputs.first)


def _derived(partials: DataFrame, plan: Sequence[tuple[list[str], list[int]]], schemas: Sequence[str]) -> DataFrame:
    """Partial rows once per schema of their root, with (_schema, group_pattern)."""
    names = list(dict.fromkeys(c for root, _ in plan for c in root))
    at = {c: F.col(f"_c{i}") for i, c in enumerate(names)}

    def pattern(number: int) -> Column:
        columns = schema_columns(schemas[number])
        return F.struct(
            F.lit(number).alias("_schema"), joined([at[c] for c in columns]).alias("group_pattern")
        )

    patterns = F.coalesce(
        *[
            F.when(F.col("_root") == number, F.array(*[pattern(n) for n in held]))
            for number, (_, held) in enumerate(plan)
        ]
    )
    rest = [c for c in partials.columns if c not in ("_root", *[f"_c{i}" for i in range(len(names))])]
    return partials.select(F.inline(patterns), *rest)


def group_features_rolled_up(
    log: DataFrame, spec: GroupSpec, finer: Sequence[str] = ()
) -> DataFrame:
    """The same as `group_features`, coarser schemas derived from finer ones.

    A log row multiplies by the number of roots of `roll_up_plan` instead of schemas,
    and what they fold to multiplies by the schemas. That pays where the finest schemas
    have far fewer patterns (and keys) than the log has rows. All features must have
    parts that can be merged.
    """
    rows = log.where(all_of(spec.where))
    plan = roll_up_plan(spec.schemas, finer)
    by = ("_schema", "group_pattern")
    frames = []
    for branch in plan_branches(spec.features):
        inputs = branch_inputs(rows, branch)
        if inputs.again is None:
            raise ValueError(f"{spec.name}: not all features can be merged")
        keyed = inputs.key is not None
        partials = root_partials(rows, [root for root, _ in plan], inputs)
        dealt = _derived(partials, plan, spec.schemas)
        folded = dealt.groupBy(*by, *(["_key"] if keyed else [])).agg(*inputs.again)
        if keyed:
            folded = folded.groupBy(*by).agg(*inputs.merge)
        frames.append(folded.select(*by, *inputs.finish))
    wide = join_on(frames, by).select(*by, *[quoted(f.name) for f in spec.features])
    return name_schemas(wide, spec.schemas)


def to_feature_json(wide: DataFrame, keys: Sequence[str] = GROUP_KEYS) -> DataFrame:
    """(keys, feature_json); NULL features are left out of the JSON."""
    features = [quoted(c) for c in wide.columns if c not in keys]
    return wide.select(*keys, F.to_json(F.struct(*features)).alias("feature_json"))
