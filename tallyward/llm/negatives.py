"""Hard negatives by exact integer inner products with the Four-Russians method.

Components become integers, and a row's integers are cut into bit planes (two's
complement, so the top plane counts negatively). Eight dimensions of a plane are one
byte. For an anchor and eight of its dimensions a table holds the sum of every subset
of the eight components; a plane's product with the anchor is the sum of the looked-up
entries, and planes are added up from the top by doubling. Scores are whole and exact.

Anchors and rows meet in cells: anchors are dealt to groups, rows to lanes, and a cell
is scored by one task that holds the group's tables and streams the lane past them. A
group and a lane are bounded, so a hot label only has more cells. Positives are looked
for among rows of the anchor's label, then negatives among all rows, which the range of
each positive's score bounds.

Rows with a NULL label, NULL vector, or a NULL or non-finite component take no part,
nor do rows without a vec_id, which no result could name. Exact repeats of a row count
once. Rows that share a vec_id otherwise are rows of their own, but none is its
namesake's positive or negative. A shorter vector counts as ending in zeros. Components
beyond 2**31 after scaling are an error, as scores might leave 64 bits. An anchor
without a positive, or a positive without a negative, gives no row; an empty table gives
none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.operators.skew import skew_join

from .common import staged

GROUP = 8
# Bytes of subset tables a task holds: anchors of a cell follow from it.
TABLE_BYTES = 48_000_000
# Rows of a lane, at most; there are at least as many lanes as LANES asks for a core.
LANE_ROWS = 500_000
LANES = 2
# Anchors and rows scored at once, so that a block of scores stays in the cache.
ANCHOR_STEP, ROW_STEP = 128, 1024
TOP = np.iinfo(np.int64).max


def packed_planes(values: np.ndarray, bits: int) -> np.ndarray:
    """Integers (rows, dims) as bytes (rows, bits, groups); plane 0 is the lowest."""
    rows, dims = values.shape
    groups = -(-dims // GROUP)
    out = np.empty((rows, bits, groups), dtype=np.uint8)
    for b in range(bits):
        out[:, b] = np.packbits((values >> b) & 1 == 1, axis=1, bitorder="little")
    return out


def subset_tables(anchors: np.ndarray) -> np.ndarray:
    """Sums of all subsets of eight components each: (groups, 256, anchors)."""
    n, dims = anchors.shape
    groups = -(-dims // GROUP)
    filled = np.zeros((n, groups * GROUP), dtype=anchors.dtype)
    filled[:, :dims] = anchors
    parts = filled.T.reshape(groups, GROUP, n)
    tables = np.zeros((groups, 1, n), dtype=anchors.dtype)
    for d in range(GROUP):
        tables = np.concatenate([tables, tables + parts[:, d : d + 1]], axis=1)
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Exact inner products (rows, anchors) from subset tables and packed planes."""
    rows, bits, groups = planes.shape
    total = np.zeros((rows, tables.shape[2]), dtype=tables.dtype)
    entry = np.empty_like(total)
    for b in reversed(range(bits)):
        # Two's complement: the top plane weighs negatively.
        add = np.subtract if b == bits - 1 else np.add
        total += total
        for g in range(groups):
            np.take(tables[g], planes[:, b, g], axis=0, out=entry, mode="clip")
            add(total, entry, out=total)
    return total


def width_of(low: int, high: int) -> int:
    """Bits of two's complement that hold low … high."""
    return max(int(-low - 1).bit_length() if low < 0 else 0, int(high).bit_length()) + 1


def _best(held: list[np.ndarray], keys: np.ndarray, ids: np.ndarray, n: int) -> list[np.ndarray]:
    """The n best of those held and new ones: highest key, then smallest id."""
    keys, ids = np.concatenate([held[0], keys]), np.concatenate([held[1], ids])
    order = np.lexsort((ids, -keys))[:n]
    return [keys[order], ids[order]]


class Picker:
    """The best rows per (anchor, range of scores), as rows stream by.

    `ranges` are pairs of the least and greatest score wanted, some per anchor.
    """

    def __init__(self, ids, labels, vectors, ranges, same: bool, n: int, shape: Shape):
        self.ids, self.labels, self.ranges, self.same, self.n = ids, labels, ranges, same, n
        values = np.zeros((len(ids), shape.dims), dtype=np.int64)
        for k, v in enumerate(vectors):
            values[k, : len(v)] = v
        bound = int(np.abs(values).sum(axis=1).max(initial=0)) << shape.bits
        # Room for a percentage of a score.
        if bound > TOP >> 7:
            raise ValueError("scores may leave 64 bits")
        values = values.astype(np.int32 if bound < 2**31 else np.int64)
        steps = range(0, len(ids), ANCHOR_STEP)
        self.tables = [subset_tables(values[at : at + ANCHOR_STEP]) for at in steps]
        none = np.empty(0, dtype=np.int64)
        self.best = [[[none, none] for _ in r] for r in ranges]

    def see(self, ids: np.ndarray, labels: np.ndarray, planes: np.ndarray) -> None:
        for at in range(0, len(ids), ROW_STEP):
            some = slice(at, at + ROW_STEP)
            for step, tables in enumerate(self.tables):
                found = np.ascontiguousarray(scores(tables, planes[some]).T)
                for k, row in enumerate(found, step * ANCHOR_STEP):
                    self._pick(k, row, ids[some], labels[some])

    def _pick(self, k: int, row: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        fits = labels == self.labels[k] if self.same else labels != self.labels[k]
        fits &= ids != self.ids[k]
        for slot, (low, high) in enumerate(self.ranges[k]):
            held = self.best[k][slot]
            if len(held[0]) == self.n:
                low = max(low, int(held[0][-1]))
            near = np.flatnonzero(fits & (row >= low) & (row <= high))
            if len(near) > 4 * self.n:
                # Ties at the n-th best stay; ids decide among them.
                least = np.partition(row[near], len(near) - self.n)[len(near) - self.n]
                near = near[row[near] >= least]
            if len(near):
                self.best[k][slot] = _best(held, row[near].astype(np.int64), ids[near], self.n)

    def rows(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for k, slots in enumerate(self.best):
            for slot, (keys, ids) in enumerate(slots):
                yield k, slot, keys, ids


def _dealt(side: DataFrame, plan: DataFrame, lane: Callable, group: Callable) -> DataFrame:
    joined = skew_join(side, plan, ["key"], "inner")
    return joined.withColumn("lane", lane("lanes")).withColumn("group", group("groups"))


def _cells(anchors: DataFrame, rows: DataFrame, per_lane: int, per_group: int) -> DataFrame:
    """Both sides with their cell (key, group, lane).

    A key has as many groups as its anchors and as many lanes as its rows ask for.
    Anchors of a key are dealt to its groups and go to all its lanes, rows to one lane
    and all groups.
    """
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    plan = anchors.groupBy("key").agg(F.count(F.lit(1)).alias("m")).join(sizes, "key")
    plan = plan.select(
        "key",
        F.ceil(F.col("n") / per_lane).cast("int").alias("lanes"),
        F.ceil(F.col("m") / per_group).cast("int").alias("groups"),
    )
    plan = staged(plan, "negatives-plan")

    def one(n: str) -> Column:
        return F.pmod(F.xxhash64("row_id"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = _dealt(anchors.withColumn("side", F.lit(0)), plan, every, one)
    right = _dealt(rows.withColumn("side", F.lit(1)), plan, one, every)
    return left.unionByName(right, allowMissingColumns=True)


@dataclass(frozen=True)
class Shape:
    """What all rows have in common."""

    rows: int
    dims: int
    bits: int
    cores: int

    @property
    def groups(self) -> int:
        return -(-self.dims // GROUP)


def _scored(anchors: DataFrame, rows: DataFrame, shape: Shape, same: bool, n: int) -> DataFrame:
    """The n best rows per anchor and wanted range: row_id, slot, rank, id, score.

    Anchors are (key, row_id, vec_id, label, vector, ranges), rows (key, row_id, vec_id,
    label, planes); an anchor meets the rows of its key. Every task hands on at most n
    rows per anchor and range, and a key has as many lanes as cores ask for, so what
    meets again grows with the anchors.
    """
    per_lane = max(1, min(LANE_ROWS, -(-shape.rows // (LANES * shape.cores))))
    per_group = max(1, TABLE_BYTES // (shape.groups * 256 * 4))
    cells = _cells(anchors, rows, per_lane, per_group).select(
        "key", "group", "lane", "side", "row_id", "vec_id", "label", "planes", "vector", "ranges"
    )

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, picker = None, [], None

        def close() -> Iterator[pa.RecordBatch]:
            if picker is None:
                return
            for k, slot, keys, ids in picker.rows():
                m = len(keys)
                if m:
                    yield pa.record_batch(
                        {
                            "row_id": pa.array([held[k][0]] * m, pa.int64()),
                            "slot": pa.array([slot] * m, pa.int32()),
                            "score": pa.array(keys, pa.int64()),
                            "id": pa.array(ids, pa.int64()),
                        }
                    )

        for batch in batches:
            marks = list(zip(*(batch.column(k).to_pylist() for k in range(4))))
            at = 0
            for mark, run in groupby(marks):
                part = batch.slice(at, len(list(run)))
                at += part.num_rows
                if mark[:3] != now:
                    yield from close()
                    now, held, picker = mark[:3], [], None
                if mark[3] == 0:
                    held += zip(*(part.column(k).to_pylist() for k in (4, 5, 6, 8, 9)))
                elif held:
                    if picker is None:
                        _, ids, labels, values, ranges = zip(*held)
                        ranges = [[(r["low"], r["high"]) for r in some] for some in ranges]
                        picker = Picker(ids, labels, values, ranges, same, n, shape)
                    octets = b"".join(part.column(7).to_pylist())
                    planes = np.frombuffer(octets, dtype=np.uint8)
                    picker.see(
                        part.column(5).to_numpy(),
                        part.column(6).to_numpy(),
                        planes.reshape(part.num_rows, shape.bits, shape.groups),
                    )
        yield from close()

    dealt = cells.repartition(LANES * shape.cores, "key", "group", "lane")
    ordered = dealt.sortWithinPartitions("key", "group", "lane", "side", "vec_id")
    found = ordered.mapInArrow(pick, "row_id bigint, slot int, score bigint, id bigint")
    order = Window.partitionBy("row_id", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _sound(vectors: DataFrame, vector: str, label: Column, scale: int) -> DataFrame:
    """Distinct rows that take part: vec_id, label, vector of integers."""
    x = F.col(f"`{vector}`")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint"))
    return (
        vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
        .select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            label.cast("bigint").alias("label"),
            whole.alias("vector"),
        )
        .where("label is not null")
        .distinct()
    )


def _shape(rows: DataFrame) -> Shape:
    found = rows.agg(
        F.count(F.lit(1)),
        F.max(F.size("vector")),
        F.min(F.array_min("vector")),
        F.max(F.array_max("vector")),
    ).first()
    n, dims, low, high = (x or 0 for x in found)
    if max(-low, high) > 2**31:
        raise ValueError("components are too large for exact scores in 64 bits")
    return Shape(n, max(dims, 1), width_of(low, high), rows.sparkSession.sparkContext.defaultParallelism)


def pack_rows(rows: DataFrame, shape: Shape) -> DataFrame:
    """Rows with their bit planes in place of the vector."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = np.zeros((batch.num_rows, shape.dims), dtype=np.int64)
            filled = np.arange(shape.dims) < sizes[:, None]
            values[filled] = lists.flatten().to_numpy(zero_copy_only=False)
            planes = [p.tobytes() for p in packed_planes(values, shape.bits)]
            names = ["row_id", "vec_id", "label", "planes"]
            columns = [*batch.columns[:3], pa.array(planes, pa.binary())]
            yield pa.record_batch(columns, names)

    ready = rows.select("row_id", "vec_id", "label", "vector")
    return ready.mapInArrow(pack, "row_id bigint, vec_id bigint, label bigint, planes binary")


def hard_negatives(
    vectors: DataFrame,
    vector: str = "embedding",
    label: Column | None = None,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id is divisible by `every`. A negative has another
    label and low * p <= 100 * score <= high * p for the score p of its positive; the
    best ones come first, ties by smaller vec_id.
    """
    rows = _sound(vectors, vector, F.col("label") if label is None else label, scale)
    rows = staged(rows.withColumn("row_id", F.monotonically_increasing_id()), "negatives-rows")
    shape = _shape(rows)
    planes = staged(pack_rows(rows, shape), "negatives-planes")
    anchors = rows.where(F.col("vec_id") % every == 0)

    def between(least: Column, most: Column) -> Column:
        return F.struct(least.cast("bigint").alias("low"), most.cast("bigint").alias("high"))

    near = _scored(
        anchors.select("*", F.array(between(F.lit(-TOP), F.lit(TOP))).alias("ranges"), F.col("label").alias("key")),
        planes.withColumn("key", F.col("label")),
        shape,
        same=True,
        n=positives,
    )
    near = staged(near.select("row_id", F.col("rank").alias("place"), "id", "score"), "negatives-near")
    # Whole quotients, rounded up and down; p * high stays within 64 bits.
    least = F.expr(f"-((-score * {low} - pmod(-score * {low}, 100)) div 100)")
    most = F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100")
    ranges = near.groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("place", between(least, most).alias("range")))).alias("_r")
    )
    ranges = ranges.select("row_id", F.transform("_r", lambda r: r["range"]).alias("ranges"))
    far = _scored(
        anchors.join(ranges, "row_id").withColumn("key", F.lit(0).cast("bigint")),
        planes.withColumn("key", F.lit(0).cast("bigint")),
        shape,
        same=False,
        n=negatives,
    )
    named = near.select(
        "row_id", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        far.join(named, ["row_id", "slot"])
        .join(anchors.select("row_id", F.col("vec_id").alias("anchor_id")), "row_id")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
