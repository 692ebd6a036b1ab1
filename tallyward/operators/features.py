"""Aggregate features and how to compute many of them in few passes.

Every feature is cut into parts: a row-level input, an aggregate of it, and, if
the aggregate can be merged, the function that merges it. Features with
mergeable parts can be computed on top of a pre-aggregation by distinct key, so
they need no pass of their own when distinct features are asked for as well.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import Condition, Value, all_of, value
from ..functions.scalars import clip_top, joined
from .percentiles import exact_percentiles

Fold = Callable[[Column], Column]


@dataclass(frozen=True, eq=False)
class Part:
    """A row-level input and how it is folded.

    `first` folds rows, `merge` folds what `first` gave, over distinct keys where the
    feature has some. `again` folds results of `first` for one and the same key, such
    as those of several hours, into another of their kind; it is `merge` if not given.
    """

    input: Column
    first: Fold
    merge: Fold | None
    again: Fold | None = None

    @property
    def joins(self) -> Fold | None:
        return self.again or self.merge


@dataclass(frozen=True, eq=False)
class Feature:
    name: str
    where: Condition = True

    kind = ""

    def parts(self) -> list[Part]:
        raise NotImplementedError

    def finish(self, *merged: Column) -> Column:
        return merged[0]


def _count(where: Column) -> Part:
    return Part(where, F.count_if, F.sum)


@dataclass(frozen=True, eq=False)
class Count(Feature):
    """Rows that meet `where`."""

    kind = "count"

    def parts(self) -> list[Part]:
        return [_count(all_of(self.where))]


@dataclass(frozen=True, eq=False)
class Ratio(Feature):
    """Share of `top` rows among `bottom` rows, NULL if there are none."""

    top: Condition = True
    bottom: Condition = True

    kind = "ratio"

    def parts(self) -> list[Part]:
        return [
            _count(all_of(self.where, self.bottom, self.top)),
            _count(all_of(self.where, self.bottom)),
        ]

    def finish(self, *merged: Column) -> Column:
        return F.try_divide(merged[0], merged[1])


# Aggregates with a state of fixed size. Others, such as lists or exact medians,
# would hold a whole group in memory.
BOUNDED = (
    "avg mean count sum min max std stddev stddev_pop stddev_samp"
    " var_pop var_samp variance skewness kurtosis"
).split()


def bounded_function(name: str) -> str:
    """The aggregate's name in lower case, if its state has a fixed size."""
    if name.lower() not in BOUNDED:
        raise ValueError(f"unknown aggregate {name!r}; known: {BOUNDED}")
    return name.lower()


@dataclass(frozen=True, eq=False)
class Stat(Feature):
    """A named aggregate of a value, clipped at `clip` if one is given."""

    func: str = "avg"
    column: Value = ""
    clip: float | None = None

    kind = "stats"

    def parts(self) -> list[Part]:
        picked = F.when(all_of(self.where), clip_top(value(self.column), self.clip))
        func = bounded_function(self.func)
        if func in ("avg", "mean"):
            number = picked.cast("double")
            return [Part(number, F.sum, F.sum), Part(number, F.count, F.sum)]
        if func == "count":
            return [Part(picked, F.count, F.sum)]
        merge = {"sum": F.sum, "min": F.min, "max": F.max}.get(func)
        if merge is not None:
            return [Part(picked, merge, merge)]
        return [Part(picked, lambda c: F.call_function(func, c), None)]

    def finish(self, *merged: Column) -> Column:
        if len(merged) == 2:
            return F.try_divide(merged[0], merged[1])
        return merged[0]


@dataclass(frozen=True, eq=False)
class Percentile(Feature):
    """Exact percentile `p` of a value, clipped at `clip` if given.

    The smallest value that at least the share `p` of all values does not exceed;
    NULL if no row meets `where`. See `percentiles`.
    """

    p: float = 0.5
    column: Value = ""
    clip: float | None = None

    kind = "stats"

    def __post_init__(self) -> None:
        if not 0 <= self.p <= 1:
            raise ValueError(f"{self.name}: percentile must lie in [0, 1]")

    def parts(self) -> list[Part]:
        """The input only; a fold of it holds all distinct values of a group."""
        picked = F.when(all_of(self.where), clip_top(value(self.column), self.clip))
        return [Part(picked, F.count, None)]


@dataclass(frozen=True, eq=False)
class SketchPercentile(Feature):
    """Percentile `p` of a value by a mergeable quantile sketch, clipped at `clip` if given.

    Rides along with other features instead of a pass of its own, and sketches of parts
    of a log can be kept and merged. The rank of the answer is off by 1.65 / `size` of
    all values at most, with 99% confidence, and exact up to `size` values. NULL if no
    row meets `where`.
    """

    p: float = 0.5
    column: Value = ""
    clip: float | None = None
    size: int = 400

    kind = "stats"

    def __post_init__(self) -> None:
        if not 0 <= self.p <= 1:
            raise ValueError(f"{self.name}: percentile must lie in [0, 1]")
        if not 8 <= self.size <= 65535:
            raise ValueError(f"{self.name}: a quantile sketch has a size from 8 to 65535")

    def parts(self) -> list[Part]:
        picked = F.when(all_of(self.where), clip_top(value(self.column), self.clip))

        def sketch(c: Column) -> Column:
            return F.call_function("kll_sketch_agg_double", c, F.lit(self.size))

        def merged(c: Column) -> Column:
            return F.call_function("kll_merge_agg_double", c, F.lit(self.size))

        return [Part(picked.cast("double"), sketch, merged)]

    def finish(self, *merged: Column) -> Column:
        held = F.call_function("kll_sketch_get_n_double", merged[0])
        answer = F.call_function("kll_sketch_get_quantile_double", merged[0], F.lit(float(self.p)))
        return F.when(held > 0, answer)


@dataclass(frozen=True, eq=False)
class ApproxDistinct(Feature):
    """Estimate of the distinct values of some columns by a mergeable sketch.

    Needs no pre-aggregation by key, so entities with very many keys cost no more than
    others, and sketches of parts of a log can be kept and merged: the estimate is the
    same however they are merged. The relative standard error is 1.04 / 2**(lg_size/2),
    0.8% for the default. NULL columns are left out of the joined text, as elsewhere.
    """

    columns: tuple[str, ...] = ()
    lg_size: int = 14

    kind = "distinct_count"

    def __post_init__(self) -> None:
        if isinstance(self.columns, str) or not self.columns:
            raise ValueError(f"{self.name}: give the key columns as a tuple")
        if not 4 <= self.lg_size <= 21:
            raise ValueError(f"{self.name}: lg_size lies between 4 and 21")

    def parts(self) -> list[Part]:
        key = F.when(all_of(self.where), joined([quoted(c) for c in self.columns]))
        return [
            Part(key, lambda c: F.hll_sketch_agg(c, self.lg_size), lambda c: F.hll_union_agg(c))
        ]

    def finish(self, *merged: Column) -> Column:
        # A sketch that saw its keys one by one is estimated from their order as well.
        # The union of a sketch with itself holds the same and is not.
        return F.hll_sketch_estimate(F.hll_union(merged[0], merged[0]))


@dataclass(frozen=True, eq=False)
class Keyed(Feature):
    """A feature that looks at the distinct values of some columns."""

    columns: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if isinstance(self.columns, str) or not self.columns:
            raise ValueError(f"{self.name}: give the key columns as a tuple")


def _seen(where: Column) -> Part:
    return Part(where, F.bool_or, F.count_if, F.bool_or)


@dataclass(frozen=True, eq=False)
class DistinctCount(Keyed):
    """Distinct keys among the rows that meet `where`."""

    kind = "distinct_count"

    def parts(self) -> list[Part]:
        return [_seen(all_of(self.where))]


@dataclass(frozen=True, eq=False)
class DistinctRatio(Keyed):
    """Distinct keys with a `top` row over distinct keys with a `bottom` row."""

    top: Condition = True
    bottom: Condition = True

    kind = "distinct_ratio"

    def parts(self) -> list[Part]:
        return [
            _seen(all_of(self.where, self.bottom, self.top)),
            _seen(all_of(self.where, self.bottom)),
        ]

    def finish(self, *merged: Column) -> Column:
        return F.try_divide(merged[0], merged[1])


def _hits_and_rows(where: Column) -> Column:
    return F.struct(F.count_if(where).alias("hits"), F.count(F.lit(1)).alias("rows"))


def _add_hits(per_key: Column) -> Column:
    return F.struct(
        F.sum(per_key["hits"]).alias("hits"), F.sum(per_key["rows"]).alias("rows")
    )


def _top_and_all(per_key: Column) -> Column:
    """The most frequent key with its rows, and the rows of all keys that count."""
    hits, rows = per_key["hits"], per_key["rows"]
    ranked = F.struct(hits.alias("hits"), joined(["_key"]).alias("key"), rows.alias("rows"))
    return F.struct(
        F.max(F.when(hits > 0, ranked)).alias("top"),
        F.sum(F.when(hits > 0, rows)).alias("all"),
    )


@dataclass(frozen=True, eq=False)
class TopNRatio(Keyed):
    """Share of rows that belong to the entity's `n` most frequent keys.

    Keys rank by the number of rows that meet `where`, ties by the larger key; a
    key with such rows weighs with all its rows. The top key alone is a maximum
    and comes from the pre-aggregation by key; for more, see `topn`.
    """

    n: int = 1

    kind = "top_n_ratio"

    def __post_init__(self) -> None:
        super().__post_init__()
        if self.n < 1:
            raise ValueError(f"{self.name}: n must be at least 1")

    def parts(self) -> list[Part]:
        if self.n > 1:
            raise ValueError(f"{self.name}: only the top key is an aggregate")
        return [Part(all_of(self.where), _hits_and_rows, _top_and_all, _add_hits)]

    def finish(self, *merged: Column) -> Column:
        return F.try_divide(merged[0]["top"]["rows"], merged[0]["all"])


def check_names(features: Sequence) -> None:
    names = [f.name for f in features]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"feature names used twice: {twice}")
    if not names:
        raise ValueError("no features given")


def quoted(name: str) -> Column:
    """A column by its exact name, dots and leading digits included."""
    return F.col("`" + name.replace("`", "``") + "`")


def key_column(frame: DataFrame, columns: Sequence[str]) -> Column:
    """The key to group by, equal exactly where the joined text is equal.

    One numeric or text column needs no concatenation: NULL is a group of its
    own for numbers, and is the empty text for texts.
    """
    if len(columns) == 1:
        field = frame.select(quoted(columns[0])).schema[0].dataType
        if isinstance(field, T.StringType):
            return F.coalesce(quoted(columns[0]), F.lit(""))
        if isinstance(field, T.IntegralType):
            return quoted(columns[0])
    return joined([quoted(c) for c in columns])


@dataclass(frozen=True, eq=False)
class Branch:
    """Features computed together; `keys` pre-aggregates by those columns."""

    features: tuple[Feature, ...]
    keys: tuple[str, ...] | None


def plan_branches(features: Sequence[Feature]) -> list[Branch]:
    """The fewest passes: one per distinct key, one for percentiles, one for what cannot merge."""
    distinct: dict[tuple[str, ...], list[Feature]] = {}
    plain: list[Feature] = []
    ranked = tuple(f for f in features if isinstance(f, Percentile))
    for feature in features:
        if feature in ranked:
            continue
        if isinstance(feature, Keyed):
            distinct.setdefault(tuple(feature.columns), []).append(feature)
        else:
            plain.append(feature)
    merges = all(p.merge is not None for f in plain for p in f.parts())
    if plain and distinct and merges:
        distinct[next(iter(distinct))].extend(plain)
        plain = []
    branches = [Branch(tuple(fs), keys) for keys, fs in distinct.items()]
    if plain:
        branches.append(Branch(tuple(plain), None))
    if ranked:
        branches.append(Branch(ranked, None))
    return branches


@dataclass(frozen=True, eq=False)
class Inputs:
    """Row-level inputs of a branch, computed once each, and their aggregates.

    `again` is None if some part cannot be merged. `ranked` is given for a branch of
    percentiles, which are no aggregates: (feature, input column, p).
    """

    columns: dict[str, Column]
    key: Column | None
    first: list[Column]
    merge: list[Column]
    finish: list[Column]
    again: list[Column] | None
    ranked: list[tuple[str, str, float]]


def branch_inputs(frame: DataFrame, branch: Branch) -> Inputs:
    columns: dict[str, Column] = {}
    slots: dict[str, str] = {}
    folds: dict[tuple, str] = {}
    first: list[Column] = []
    merge: list[Column] = []
    again: list[Column] = []
    finish: list[Column] = []
    ranked: list[tuple[str, str, float]] = []
    for feature in branch.features:
        if isinstance(feature, Percentile):
            (part,) = feature.parts()
            slot = slots.setdefault(str(part.input), f"_in{len(slots)}")
            columns[slot] = part.input
            ranked.append((feature.name, slot, feature.p))
            continue
        merged = []
        for part in feature.parts():
            slot = slots.setdefault(str(part.input), f"_in{len(slots)}")
            columns[slot] = part.input
            aggregate = part.first(F.col(slot))
            fold = (str(aggregate), str(part.merge(F.col("_")) if part.merge else None))
            if fold not in folds:
                folds[fold] = out = f"_agg{len(folds)}"
                first.append(aggregate.alias(out))
                if part.merge is not None:
                    merge.append(part.merge(F.col(out)).alias(out))
                    again.append(part.joins(F.col(out)).alias(out))
            merged.append(F.col(folds[fold]))
        finish.append(feature.finish(*merged).alias(feature.name))
    key = key_column(frame, branch.keys) if branch.keys else None
    mergeable = again if len(again) == len(first) and not ranked else None
    return Inputs(columns, key, first, merge, finish, mergeable, ranked)


def aggregate_inputs(rows: DataFrame, by: Sequence[str], inputs: Inputs) -> DataFrame:
    """Aggregate rows that carry the input columns (and `_key`) by `by`."""
    by = list(by)
    if inputs.ranked:
        return exact_percentiles(rows, by, inputs.ranked)
    if inputs.key is None:
        folded = rows.groupBy(*by).agg(*inputs.first)
    else:
        folded = (
            rows.groupBy(*by, "_key")
            .agg(*inputs.first)
            .groupBy(*by)
            .agg(*inputs.merge)
        )
    return folded.select(*by, *inputs.finish)


def join_on(frames: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """Join frames that hold the same keys; all are already hashed by them."""
    return reduce(lambda a, b: a.join(b, list(by), "inner"), frames)
