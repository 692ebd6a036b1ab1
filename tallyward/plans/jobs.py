"""User-level jobs: read, compute with the operators, optionally write.

Every job returns DataFrames; pass a path to also replace its partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import Condition, all_of
from ..operators.entity import FeatureGroup, entity_features, passes
from ..operators.groups import (
    GROUP_KEYS,
    GroupSpec,
    group_features,
    group_features_rolled_up,
    to_feature_json,
)
from ..operators.hourly import hour_parts, kept_tables, window_features
from ..operators.labels import all_labels
from ..operators.merge import (
    MergedFeature,
    merge_parts,
    merge_wide,
    population_of_parts,
    population_stats,
    wide_of_parts,
)
from ..operators.rules import (
    Strategy,
    good_rules,
    match_patterns,
    mine_strategies,
    performance_join,
    strategies_json,
)
from ..sources.tables import (
    Table,
    hours_before,
    merge_output_path,
    overwrite_hours,
    overwrite_kinds,
    overwrite_partition,
    read_features,
    read_group_features,
    read_performance,
    read_strategies,
    read_table,
    staged,
    write_delimited,
)

# A log of a trailing window: (date, hour, hours) -> rows.
Source = Callable[[str, str, int], DataFrame]


def run_entity_features(
    source: Source,
    group: FeatureGroup,
    date: str,
    hour: str,
    hours: int,
    version: str,
    path: str | None = None,
    stage: bool | None = None,
) -> DataFrame | None:
    """All feature kinds of a group as one long table.

    The job reads the log once per pass. With `stage`, the log is written to the
    shared folder first and read from there; the result is then only written, not
    returned. Jobs with a path and several passes are staged unless told not to.
    """
    log = source(date, hour, hours)
    values = {"date": date, "hour": hour, "group": group.name, "version": version}
    if stage is None:
        stage = path is not None and passes(group) > 1
    if stage:
        if path is None:
            raise ValueError("a staged job needs a path to write to")
        with staged(log.where(all_of(group.where))) as kept:
            long = entity_features(kept, group)
            overwrite_kinds(long, path, values, "aggregator_type", group.kinds)
        return None
    long = entity_features(log, group)
    if path is not None:
        overwrite_kinds(long, path, values, "aggregator_type", group.kinds)
    return long


def _parts_path(path: str, group: FeatureGroup, name: str, version: str) -> str:
    return f"{path.rstrip('/')}/{group.name}/{version}/{name}"


def run_hour_parts(
    source: Source, group: FeatureGroup, date: str, hour: str, version: str, path: str
) -> None:
    """Keep the parts of one hour, read once; an hour without rows is kept as empty."""
    log = source(date, hour, 1)
    for kept in kept_tables(group):
        parts = hour_parts(log, group, kept)
        overwrite_partition(
            parts, _parts_path(path, group, kept.name, version), {"date": date, "hour": hour}
        )


def backfill_hour_parts(log: DataFrame, group: FeatureGroup, version: str, path: str) -> None:
    """Keep the parts of every hour of a log with `date` and `hour`, in one pass a table."""
    for kept in kept_tables(group):
        parts = hour_parts(log, group, kept, ("date", "hour"))
        overwrite_hours(parts, _parts_path(path, group, kept.name, version))


def run_window_features(
    empty_log: DataFrame,
    group: FeatureGroup,
    parts_path: str,
    date: str,
    hour: str,
    hours: int,
    version: str,
    path: str | None = None,
    missing_is_empty: bool = False,
) -> DataFrame:
    """All features of the `hours` hours that end with (date, hour), from hourly parts.

    The log is not read; `empty_log` only has its columns. An hour that was never kept
    is an error unless `missing_is_empty`, as after a backfill, which keeps no empty ones.
    """
    spark = empty_log.sparkSession
    wanted = hours_before(date, hour, hours)
    found = []
    for kept in kept_tables(group):
        schema = hour_parts(empty_log, group, kept).schema
        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        table = Table(names, ("date", "hour"))
        rows = read_table(
            spark,
            _parts_path(parts_path, group, kept.name, version),
            table,
            [{"date": d, "hour": h} for d, h in wanted],
            all_there=not missing_is_empty,
        )
        found.append((kept, rows))
    long = window_features(found, empty_log)
    if path is not None:
        values = {"date": date, "hour": hour, "group": group.name, "version": version}
        overwrite_kinds(long, path, values, "aggregator_type", group.kinds)
    return long


@dataclass(frozen=True)
class MergeSpec:
    """Which long features become columns, and where they come from."""

    group: str
    dkey: str
    kinds: tuple[str, ...]
    version: str
    features: tuple[MergedFeature, ...]
    # The long table is not narrowed to `group` unless this is set.
    only_group: bool = False
    population: bool = False


def run_merge(
    spark: SparkSession,
    features_path: str,
    spec: MergeSpec,
    date: str,
    hour: str,
    table_path: str | None = None,
    text_root: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """The wide table and, if asked for, the population statistics.

    Where both are written, the long table is read and pivoted once, and both are taken
    from the parts per entity that this gives.
    """
    long = read_features(
        spark,
        features_path,
        date,
        hour,
        spec.dkey,
        spec.kinds,
        spec.version,
        spec.group if spec.only_group else None,
    )
    wide = merge_wide(long, spec.features, spec.dkey)
    stats = population_stats(long, spec.features) if spec.population else None
    at = (spec.group, spec.version, date, hour)

    def write(wide: DataFrame, stats: DataFrame | None) -> None:
        if text_root is not None and stats is not None:
            write_delimited(stats, merge_output_path(text_root, "population_stats", *at))
        if table_path is not None:
            overwrite_partition(wide, table_path, {"date": date, "hour": hour})
        if text_root is not None:
            write_delimited(wide, merge_output_path(text_root, "feature", *at))

    outputs = (table_path is not None) + (text_root is not None) * (1 + spec.population)
    if outputs > 1:
        with staged(merge_parts(long, spec.features)) as parts:
            write(
                wide_of_parts(parts, spec.features, spec.dkey),
                population_of_parts(parts, spec.features) if spec.population else None,
            )
    else:
        write(wide, stats)
    return wide, stats


def run_group_features(
    source: Source,
    spec: GroupSpec,
    date: str,
    hour: str,
    hours: int,
    path: str | None = None,
    roll_up: bool = False,
    finer: Sequence[str] = (),
) -> DataFrame:
    """Feature JSON of every pattern of every schema; the version is the group name.

    With `roll_up`, coarser schemas are derived from finer ones, see
    `group_features_rolled_up`.
    """
    log = source(date, hour, hours)
    wide = group_features_rolled_up(log, spec, finer) if roll_up else group_features(log, spec)
    table = to_feature_json(wide)
    if path is not None:
        overwrite_partition(
            table, path, {"date": date, "hour": hour, "version": spec.name}
        )
    return table


@dataclass(frozen=True)
class Performance:
    """One table (or path) per label kind."""

    game: object
    ug: object
    ecom: object


def run_performance_labels(
    rows: Performance,
    day_requests: DataFrame,
    schemas: Sequence[str],
    date: str,
    version: str,
    paths: Performance | None = None,
) -> Performance:
    """Labels of the three kinds per pattern, as feature JSON.

    `rows` holds the sources' game_rows, user_growth_rows and order_rows.
    """
    together = all_labels(rows.game, rows.ug, rows.ecom, day_requests, schemas)
    kinds = {"game": "game_json", "ug": "ug_json", "ecom": "ecom_json"}

    def split(labels: DataFrame) -> Performance:
        return Performance(
            **{
                kind: labels.where(F.col(name).isNotNull()).select(
                    *GROUP_KEYS, F.col(name).alias("feature_json")
                )
                for kind, name in kinds.items()
            }
        )

    if paths is not None:
        at = {"date": date, "version": version}
        # Written once, so that the log is not joined again for each kind.
        with staged(together) as kept:
            labels = split(kept)
            overwrite_partition(labels.game, paths.game, at)
            overwrite_partition(labels.ug, paths.ug, at)
            overwrite_partition(labels.ecom, paths.ecom, at)
    return split(together)


def run_mining(
    spark: SparkSession,
    groups_path: str,
    performance: Performance,
    strategies: Sequence[Strategy],
    date: str,
    version: str,
    path: str | None = None,
) -> DataFrame:
    """Rules with their performance; `performance` holds the label tables' paths."""
    schemas = [s.schema for s in strategies]
    groups = read_group_features(spark, groups_path, date, version, schemas)
    kinds = [
        read_performance(spark, p, date, version, schemas)
        for p in (performance.game, performance.ug, performance.ecom)
    ]
    mined = mine_strategies(performance_join(groups, *kinds), strategies)
    table = strategies_json(mined)
    if path is not None:
        overwrite_partition(table, path, {"date": date, "version": version})
    return table


def run_match(
    spark: SparkSession,
    groups_path: str,
    strategies_path: str,
    strategies: Sequence[Strategy],
    targets: Sequence[Condition],
    date: str,
    strategy_date: str,
    version: str,
    path: str | None = None,
) -> DataFrame:
    """Groups of `date` that meet a rule of `strategy_date` which meets all targets."""
    schemas = [s.schema for s in strategies]
    groups = read_group_features(spark, groups_path, date, version, schemas)
    rules = good_rules(
        read_strategies(spark, strategies_path, strategy_date, version), targets
    )
    matched = match_patterns(groups, rules, strategies)
    if path is not None:
        overwrite_partition(matched, path, {"date": date, "version": version})
    return matched
