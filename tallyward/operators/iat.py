"""Inter-arrival features: how values move between an entity's successive events."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import Condition, all_of
from ..functions.scalars import clip_top, joined, steps_between
from .features import bounded_function, check_names, key_column, quoted
from .skew import hot_keys

# An entity with more than this share of all rows is cut into chunks, so at most
# 1 / HOT_SHARE entities are.
HOT_SHARE = 1 / 1_000
# Entities below this many rows are never cut.
HOT_FLOOR = 1_000_000
# Hot entities are cut at this many quantiles of the first sort key, squared.
SIDE = 32
# Quantiles of tasks are merged in this many groups first.
MERGED = 256


@dataclass(frozen=True, eq=False)
class IatStat:
    """A named aggregate of `iat` over the pairs that meet `where`."""

    name: str
    func: str = "avg"
    where: Condition = True


@dataclass(frozen=True, eq=False)
class IatRatio:
    """Share of `top` pairs among `bottom` pairs."""

    name: str
    top: Condition = True
    bottom: Condition = True
    where: Condition = True


@dataclass(frozen=True, eq=False)
class IatRankRatio:
    """Position of the first `top` pair over that of the last `bottom` pair."""

    name: str
    top: Condition = True
    bottom: Condition = True
    where: Condition = True


@dataclass(frozen=True, eq=False)
class IatStep:
    """A function of two successive values; its features see it as `iat`.

    `where` must hold for both events, otherwise the value is NULL.
    """

    func: str
    features: tuple
    where: Condition = True
    clip: float | None = None


@dataclass(frozen=True, eq=False)
class IatKey:
    """The column that is compared between events, masked and clipped first."""

    column: str
    steps: tuple[IatStep, ...]
    where: Condition = True
    clip: float | None = None


@dataclass(frozen=True, eq=False)
class InterArrival:
    """Event order of an entity and what to compute along it.

    Events with equal sort keys are ordered by `tie_break`.
    """

    order_by: tuple[str, ...]
    keys: tuple[IatKey, ...]
    tie_break: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if isinstance(self.order_by, str) or not self.order_by:
            raise ValueError("give order_by as a tuple of column names")
        columns = [k.column for k in self.keys]
        if len(set(columns)) != len(columns):
            raise ValueError("a column may be compared once per event order")
        check_names(self.named())

    def named(self) -> list:
        return [f for k in self.keys for s in k.steps for f in s.features]

    def steps(self) -> list[tuple[IatKey, IatStep]]:
        return [(k, s) for k in self.keys for s in k.steps]

    @property
    def ranked(self) -> bool:
        return any(isinstance(f, IatRankRatio) for f in self.named())


def inter_arrival(
    rows: DataFrame,
    dkey: Sequence[str],
    spec: InterArrival,
    hot_share: float = HOT_SHARE,
    hot_floor: int = HOT_FLOOR,
) -> DataFrame:
    """One wide row (dval, feature columns) per entity with at least two events."""
    pairs = event_pairs(rows, dkey, spec, hot_share, hot_floor)
    aggregates = []
    for at, (_, step) in enumerate(spec.steps()):
        pairs = pairs.withColumn("iat", F.col(f"_iat{at}"))
        for feature in step.features:
            values, fold = _fold(feature, f"_v{len(aggregates)}")
            pairs = pairs.withColumns(values)
            aggregates.append(fold.alias(feature.name))
    return (
        pairs.groupBy("_by")
        .agg(*aggregates)
        .withColumn("dval", joined(["_by"]))
        .drop("_by")
    )


def _fold(feature, slot: str) -> tuple[dict[str, Column], Column]:
    """Row-level inputs of a feature, read while `iat` is its step, and its fold."""
    if isinstance(feature, IatStat):
        picked = F.when(all_of(feature.where), F.col("iat"))
        return {slot: picked}, F.call_function(bounded_function(feature.func), F.col(slot))
    bottom = all_of(feature.where, feature.bottom)
    top = all_of(feature.where, feature.bottom, feature.top)
    inputs = {f"{slot}_top": top, f"{slot}_bottom": bottom}
    over, under = F.col(f"{slot}_top"), F.col(f"{slot}_bottom")
    if isinstance(feature, IatRatio):
        return inputs, F.try_divide(F.count_if(over), F.count_if(under))
    if isinstance(feature, IatRankRatio):
        rank = F.col("rank_num")
        first, last = F.min(F.when(over, rank)), F.max(F.when(under, rank))
        return inputs, F.try_divide(first, last)
    raise ValueError(f"not an inter-arrival feature: {feature!r}")


def event_pairs(
    rows: DataFrame,
    dkey: Sequence[str],
    spec: InterArrival,
    hot_share: float = HOT_SHARE,
    hot_floor: int = HOT_FLOOR,
) -> DataFrame:
    """(_by, rank_num, one column per step) for every event with a successor.

    The successor comes from a window per entity. Entities that hold too large
    a share of the log are cut at quantiles of their first sort key into chunks
    that sort in separate tasks, and chunks that are still too large, as all their
    events share that key, at quantiles of the next key, up to the last tie break.
    The pairs across chunk edges are added from a small table of the chunks' first
    and last events. Hot entities are looked for, and cuts made, right away: this
    runs Spark jobs while the query is being built.
    """
    events = _events(rows, dkey, spec)
    by = [f"_e{i}" for i in range(len(dkey))]
    order = [F.col(f"_o{i}") for i in range(len(spec.order_by))]
    order += [F.col(f"_t{i}") for i in range(len(spec.tie_break))]
    carried = F.struct(*_carried(spec))

    if not _splittable(events.schema["_o0"].dataType):
        ordered = Window.partitionBy(*by).orderBy(*order)
        linked = events.select(
            "_by",
            carried.alias("_cur"),
            F.lead(carried).over(ordered).alias("_next"),
            F.row_number().over(ordered).alias("rank_num"),
        )
        return _steps(linked, spec)

    hot = hot_keys(events, by, hot_share, hot_floor)
    if not hot:
        chunked, parts = events, by
    else:
        names = [f"_o{i}" for i in range(len(spec.order_by))]
        names += [f"_t{i}" for i in range(len(spec.tie_break))]
        chunked = _chunks(events, by, list(hot), names, hot_share, hot_floor)
        parts = [*by, "_chunk"]
    local = Window.partitionBy(*parts).orderBy(*order)
    inside = chunked.select(
        "_by",
        *parts,
        carried.alias("_cur"),
        F.lead(carried).over(local).alias("_next"),
        F.row_number().over(local).alias("rank_num"),
    )
    if not hot:
        return _steps(inside.select("_by", "_cur", "_next", "rank_num"), spec)

    cut = chunked.where(F.col("_chunk")[0] > -2)
    edges = _chunk_edges(cut, by, carried, F.struct(*order))
    if spec.ranked:
        # `edges` has one row per chunk, about SIDE ** 2 / hot_share at most.
        offsets = edges.select(
            *[F.col(b).alias(f"{b}_at") for b in by],
            F.col("_chunk").alias("_chunk_at"),
            "_before",
        )
        same = F.col("_chunk") == F.col("_chunk_at")
        for b in by:
            same &= F.col(b).eqNullSafe(F.col(f"{b}_at"))
        inside = inside.join(F.broadcast(offsets), same, "left").withColumn(
            "rank_num", F.col("rank_num") + F.coalesce("_before", F.lit(0))
        )
    across = edges.select(
        "_by",
        F.col("_last").alias("_cur"),
        F.col("_first_after").alias("_next"),
        (F.col("_before") + F.col("_events")).alias("rank_num"),
    )
    linked = inside.select("_by", "_cur", "_next", "rank_num").unionByName(across)
    return _steps(linked, spec)


def _events(rows: DataFrame, dkey: Sequence[str], spec: InterArrival) -> DataFrame:
    """Entity, order and tie columns as they are; compared columns masked."""
    kept = {f"_e{i}": quoted(c) for i, c in enumerate(dkey)}
    kept |= {f"_o{i}": quoted(c) for i, c in enumerate(spec.order_by)}
    kept |= {f"_t{i}": quoted(c) for i, c in enumerate(spec.tie_break)}
    kept["_by"] = key_column(rows, dkey)
    masked = {
        k.column: F.when(all_of(k.where), clip_top(quoted(k.column), k.clip))
        for k in spec.keys
    }
    ready = rows.withColumns(kept).withColumns(masked)
    return ready.select(
        *kept,
        *[quoted(k.column).alias(f"_k{i}") for i, k in enumerate(spec.keys)],
        *[all_of(s.where).alias(f"_ok{i}") for i, (_, s) in enumerate(spec.steps())],
    )


def _carried(spec: InterArrival) -> list[str]:
    keys = [f"_k{i}" for i in range(len(spec.keys))]
    return keys + [f"_ok{i}" for i in range(len(spec.steps()))]


def _splittable(kind: T.DataType) -> bool:
    ordered = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    return isinstance(kind, (*ordered, T.StringType, T.BinaryType))


def _place(kind: T.DataType, key: Column, skip: Column) -> Column:
    """A double that never falls as the sort key grows.

    Texts are placed by six bytes after the `skip` hex digits all keys share.
    """
    if isinstance(kind, (T.StringType, T.BinaryType)):
        digits = F.rpad(F.substr(F.hex(key), skip + 1, F.lit(12)), 12, "0")
        return F.conv(digits, 16, 10).cast("double")
    if isinstance(kind, T.BooleanType):
        return key.cast("int").cast("double")
    if isinstance(kind, T.NumericType):
        return key.cast("double")
    return F.unix_micros(key.cast("timestamp")).cast("double")


def _shared_digits(low: Column, high: Column) -> Column:
    """Hex digits that two texts, and so all texts between them, begin with."""
    one, other = F.hex(low), F.hex(high)
    lengths = F.sequence(F.lit(0), F.least(F.length(one), F.length(other)))
    return F.array_max(
        F.filter(lengths, lambda n: F.substr(one, F.lit(1), n) == F.substr(other, F.lit(1), n))
    )


def _chunks(
    events: DataFrame, by: list[str], hot: list[int], names: list[str], share: float, floor: int
) -> DataFrame:
    """Add `_chunk`, an array of one number per sort key that never falls in sort order.

    A key cuts what the keys before it left in one piece: chunks above the share whose
    events are all equal in those keys. Its number is -2 where it cuts nothing.
    """
    levels, chunked = [], events
    for level, name in enumerate(names):
        if not _splittable(events.schema[name].dataType):
            break
        within = [*by, *levels]
        if level:
            hot = _uniform(chunked, within, names[level - 1], list(hot_keys(chunked, within, share, floor)))
            if not hot:
                break
        levels.append(f"_c{level}")
        chunked = _chunk(chunked, within, hot, name, levels[-1])
    return chunked.withColumn("_chunk", F.array(*levels)).drop(*levels)


def _uniform(events: DataFrame, by: list[str], key: str, hot: list[int]) -> list[int]:
    """Those of the hot groups, 1 / share of them at most, in which one key never changes."""
    if not hot:
        return []
    group = F.xxhash64(*by)
    least, most, held = F.min(key), F.max(key), F.count(key)
    found = (
        events.where(group.isin(hot))
        .groupBy(group.alias("_hash"))
        .agg(((least == most) & (held == F.count(F.lit(1))) | (held == 0)).alias("_same"))
    )
    return [r["_hash"] for r in found.where("_same").collect()]


def _chunk(events: DataFrame, by: list[str], hot: list[int], key: str, name: str) -> DataFrame:
    """Add column `name`, never falling with the sort key `key`; -2 where it is not cut.

    The quantiles only balance the chunks, so they are quantiles of the quantiles of
    MERGED parts, and no task merges what all tasks have gathered. They go by way
    of the driver, at most 1 / HOT_SHARE rows of SIDE ** 2 numbers, so every use
    of the chunks cuts alike.
    """
    spark = events.sparkSession
    kind = events.schema[key].dataType
    picked = events.where(F.xxhash64(*by).isin(hot))
    skip = F.lit(0)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        skip = _shared_digits(F.min(key), F.max(key))
    skips = picked.groupBy(*by).agg(skip.alias("_skip"))
    skips = spark.createDataFrame(skips.collect(), skips.schema)

    def same(df: DataFrame) -> Column:
        return reduce(lambda x, y: x & y, [events[b].eqNullSafe(df[b]) for b in by])

    at = _place(kind, F.col(key), F.col("_skip"))
    count = SIDE * SIDE

    def quantiles(value: Column) -> Column:
        shares = F.expr(f"array({', '.join(f'{i / count}D' for i in range(1, count))})")
        return F.percentile_approx(value, shares, F.lit(20 * count))

    parted = picked.join(F.broadcast(skips), same(skips)).select(
        *[skips[b] for b in by], "_skip", at.alias("_at"), (F.spark_partition_id() % MERGED).alias("_p")
    )
    some = parted.groupBy(*by, "_skip", "_p").agg(quantiles(F.col("_at")).alias("_some"))
    cuts = (
        some.select(*by, "_skip", F.explode_outer("_some").alias("_at"))
        .groupBy(*by, "_skip")
        .agg(F.array_sort(quantiles(F.col("_at"))).alias("_all"))
        .select(
            *by,
            "_skip",
            F.transform(
                F.sequence(F.lit(1), F.lit(SIDE - 1)), lambda i: F.get("_all", i * SIDE - 1)
            ).alias("_coarse"),
            F.transform(
                F.sequence(F.lit(0), F.lit(SIDE - 1)),
                lambda i: F.slice("_all", i * SIDE + 1, SIDE - 1),
            ).alias("_fine"),
        )
    )
    cuts = spark.createDataFrame(cuts.collect(), cuts.schema)

    def below(quantiles: Column) -> Column:
        return F.size(F.filter(quantiles, lambda q: q <= at))

    coarse = below(F.col("_coarse"))
    chunk = (
        F.when(F.col("_skip").isNull(), -2)
        .when(F.col(key).isNull() | F.col("_coarse").isNull(), -1)
        .otherwise(coarse * SIDE + below(F.get("_fine", coarse)))
    )
    return events.join(F.broadcast(cuts), same(cuts), "left").select(
        *[events[c] for c in events.columns], chunk.alias(name)
    )


def _chunk_edges(
    hot: DataFrame, by: list[str], carried: Column, order: Column
) -> DataFrame:
    """One row per chunk: its last event, the next chunk's first, rows before it.

    First and last come from an aggregation that combines before the shuffle;
    nothing is sorted for them.
    """
    edges = hot.groupBy("_by", *by, "_chunk").agg(
        F.min_by(carried, order).alias("_first"),
        F.max_by(carried, order).alias("_last"),
        F.count(F.lit(1)).alias("_events"),
    )
    chunks = Window.partitionBy(*by).orderBy("_chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(
        "_by",
        *by,
        "_chunk",
        "_last",
        "_events",
        F.lead("_first").over(chunks).alias("_first_after"),
        F.coalesce(F.sum("_events").over(before), F.lit(0)).alias("_before"),
    )


def _steps(linked: DataFrame, spec: InterArrival) -> DataFrame:
    """Values of all steps for the events that have a successor."""
    at = {k.column: i for i, k in enumerate(spec.keys)}
    values = []
    for i, (key, step) in enumerate(spec.steps()):
        current, following = (
            F.col(side).getField(f"_k{at[key.column]}") for side in ("_cur", "_next")
        )
        both = F.col("_cur").getField(f"_ok{i}") & F.col("_next").getField(f"_ok{i}")
        moved = clip_top(steps_between(step.func, current, following), step.clip)
        values.append(F.when(both, moved).alias(f"_iat{i}"))
    present = linked.where(F.col("_next").isNotNull())
    return present.select("_by", "rank_num", *values)
