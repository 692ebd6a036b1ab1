"""Near duplicates among embeddings: every pair with a cosine of at least a threshold.

On unit vectors a cosine of c or more is a squared distance of 2 - 2 c or less.
Vectors are rotated by a fixed random rotation and split into blocks of dimensions;
each block gets a share of the squared distance in proportion to its dimensions.
By the pigeonhole principle a linked pair keeps within the budget in one block at
least, so range joins of all blocks find every pair, and the cosine of what they
find is computed exactly, in double precision.

The range join of a block cuts its space into cells at quantiles of its
coordinates. A vector is resident in its own cell and visits each later cell whose
box lies within the budget. Cells with too many residents are dealt out in chunks.
A task holds the residents of one chunk and lets the visitors pass by in batches,
so its memory has a bound. A pair counts in the first block whose budget it keeps,
hence once. Tasks write sums of links per vector and spanning forests, not pairs.

Equal vectors are one class from the start. Vectors that are NULL, empty, zero or
hold a NULL or a number that is not finite are linked with nothing, and vectors of
different dimensions are not compared. Repeated rows are equal vectors. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.operators.skew import skew_join

from .common import components, cut, staged

BLOCKS = 4
CELL_ROWS = 8_192
VISITORS = 2_048
PAIRS = 100_000
SEED = 7
# Room for rounding: of distances in double precision, and in single precision.
FINE = 1e-9
ROUGH = 1e-5
# Cell counts are broadcast up to this many rows of some forty bytes.
SMALL_CELLS = 500_000


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """A random rotation of `dim` dimensions, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_bounds(dim: int) -> list[int]:
    """Where blocks begin and end; fewer blocks for fewer dimensions."""
    number = min(BLOCKS, dim)
    return [dim * b // number for b in range(number + 1)]


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Double precision unit vectors; scaled first, so that no square overflows."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def visited_cells(block: np.ndarray, cuts: list[list[float]], budget: float):
    """(row, cell, at home) for the cells within the budget of each row of a block.

    Coordinates are taken one by one; what has used up the budget is dropped.
    """
    row, cell = np.arange(len(block)), np.zeros(len(block), dtype=np.int64)
    cost, home = np.zeros(len(block)), np.ones(len(block), dtype=bool)
    for j, at in enumerate(cuts):
        low, high = np.r_[-np.inf, at], np.r_[at, np.inf]
        x = block[row, j][:, None]
        outside = np.maximum(np.maximum(low[None, :] - x, x - high[None, :]), 0.0)
        own = np.searchsorted(at, x[:, 0], side="right")
        total = cost[:, None] + outside * outside
        k, part = np.nonzero(total <= budget + FINE)
        row, cost = row[k], total[k, part]
        cell, home = cell[k] * len(low) + part, home[k] & (part == own[k])
    return row, cell, home


def _stacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(len(column), -1)


def _by_dim(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column(at).to_numpy()
    for dim in np.unique(dims):
        yield int(dim), batch.filter(pa.array(dims == dim))


def leading(classes: DataFrame, number: int) -> DataFrame:
    """The first `number` rotated coordinates of each block, block after block."""

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _by_dim(batch, 0):
                turned = _stacked(rows.column(1)) @ rotation(dim)
                bounds = block_bounds(dim)
                out = np.full((len(turned), BLOCKS * number), np.nan)
                for b, (low, high) in enumerate(zip(bounds, bounds[1:])):
                    held = min(number, high - low)
                    out[:, b * number : b * number + held] = turned[:, low : low + held]
                flat = pa.array(out.ravel())
                sizes = np.arange(len(out) + 1, dtype=np.int32) * (BLOCKS * number)
                values = pa.ListArray.from_arrays(pa.array(sizes), flat)
                yield pa.record_batch([values], names=["lead"])

    return classes.select("dim", "unit").mapInArrow(rotate, "lead array<double>")


def cell_cuts(classes: DataFrame, number: int) -> list[list[list[float]]]:
    """Per block, cut points of its leading coordinates; none while one cell does.

    Any cuts give the same links; quantiles over all vectors balance the cells.
    """
    bits = max(0, math.ceil(math.log2(max(number, 1) / CELL_ROWS)))
    if bits == 0:
        return [[] for _ in range(BLOCKS)]
    wide = min(bits, 16)
    parts = [1 << (bits // wide + (j < bits % wide)) for j in range(wide)]
    lead = leading(classes, wide)
    asked = []
    for b in range(BLOCKS):
        for j, p in enumerate(parts):
            value = F.get("lead", F.lit(b * wide + j))
            shares = [k / p for k in range(1, p)]
            asked.append(F.percentile_approx(F.when(~F.isnan(value), value), shares, 1000))
    found = list(lead.agg(*asked).first())
    cuts = []
    for b in range(BLOCKS):
        own = found[b * wide : (b + 1) * wide]
        # Blocks have as many cuts as they have dimensions.
        cuts.append([sorted(set(c)) for c in own if c])
    return cuts


def resident_counts(classes: DataFrame, cuts: list, budget: float) -> DataFrame:
    """dim, block, cell, _rows: how many vectors live in each cell."""

    def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _by_dim(batch, 0):
                turned, bounds = _stacked(rows.column(1)) @ rotation(dim), block_bounds(dim)
                for b, (low, high) in enumerate(zip(bounds, bounds[1:])):
                    cell = visited_cells(turned[:, low:high], cuts[b][: high - low], -FINE)[1]
                    value, count = np.unique(cell, return_counts=True)
                    yield pa.record_batch(
                        [pa.array([dim] * len(value), pa.int32()), pa.array([b] * len(value), pa.int32())]
                        + [pa.array(value, pa.int64()), pa.array(count, pa.int64())],
                        names=["dim", "block", "cell", "_n"],
                    )

    counted = classes.select("dim", "unit").mapInArrow(
        live, "dim int, block int, cell bigint, _n bigint"
    )
    return counted.groupBy("dim", "block", "cell").agg(F.sum("_n").alias("_rows"))


def placed(classes: DataFrame, cuts: list, total: float) -> DataFrame:
    """Vectors once per cell they live in or visit."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, rows in _by_dim(batch, 0):
                turned, bounds = _stacked(rows.column(1)) @ rotation(dim), block_bounds(dim)
                for b, (low, high) in enumerate(zip(bounds, bounds[1:])):
                    budget = total * (high - low) / dim
                    row, cell, home = visited_cells(
                        turned[:, low:high], cuts[b][: high - low], budget
                    )
                    own = np.zeros(len(turned), dtype=np.int64)
                    own[row[home]] = cell[home]
                    kept = cell >= own[row]
                    row, cell, home = row[kept], cell[kept], home[kept]
                    some = rows.take(pa.array(row))
                    yield pa.record_batch(
                        [pa.array([dim] * len(row), pa.int32()), pa.array([b] * len(row), pa.int32())]
                        + [pa.array(cell), pa.array(~home), *some.columns[1:]],
                        names=["dim", "block", "cell", "guest", "unit", "rep", "n"],
                    )

    return classes.select("dim", "unit", "rep", "n").mapInArrow(
        place, "dim int, block int, cell bigint, guest boolean, unit binary, rep bigint, n bigint"
    )


class _Chunk:
    """Residents of one chunk, and what is linked in it."""

    def __init__(self, dim: int, block: int, total: float, threshold: float):
        self.dim, self.block, self.threshold = dim, block, threshold
        bounds = block_bounds(dim)
        self.low, self.high = bounds[block], bounds[block + 1]
        self.starts = np.array(bounds[:-1])
        self.budgets = total * np.diff(bounds) / dim
        self.unit = np.zeros((0, dim))
        self.ids = self.n = np.zeros(0, dtype=np.int64)

    def settle(self, unit: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        self.unit = np.vstack([self.unit, unit])
        self.ids, self.n = np.r_[self.ids, ids], np.r_[self.n, n]
        self.turned = self.unit @ rotation(self.dim)
        self.rough = self._rough(self.turned, True)

    def _rough(self, turned: np.ndarray, right: bool) -> np.ndarray:
        """Single-precision rows whose products are minus half the squared distances."""
        block = turned[:, self.low : self.high]
        half = -(block * block).sum(axis=1, keepdims=True) / 2
        ones = np.ones_like(half)
        return np.hstack([block, ones, half] if right else [block, half, ones]).astype(np.float32)

    def meet(self, unit: np.ndarray, ids: np.ndarray, n: np.ndarray, own: int | None):
        """Links of some vectors with the residents; `own`: they are residents from there."""
        turned = unit @ rotation(self.dim)
        near = self._rough(turned, False) @ self.rough.T
        left, right = np.nonzero(near >= -(self.budgets[self.block] + ROUGH) / 2)
        if own is not None:
            later = right > left + own
            left, right = left[later], right[later]
        linked = []
        for at in range(0, len(left), PAIRS):
            i, j = left[at : at + PAIRS], right[at : at + PAIRS]
            hit = (unit[i] * self.unit[j]).sum(axis=1) >= self.threshold
            i, j = i[hit], j[hit]
            apart = turned[i] - self.turned[j]
            apart = np.add.reduceat(apart * apart, self.starts, axis=1)
            first = (apart <= self.budgets + FINE).argmax(axis=1) == self.block
            linked.append((i[first], j[first]))
        i = np.concatenate([x for x, _ in linked]) if linked else left[:0]
        j = np.concatenate([x for _, x in linked]) if linked else right[:0]
        return _link_rows(ids[i], n[i], self.ids[j], self.n[j])


def _link_rows(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> pa.RecordBatch | None:
    """Per vector: how many vectors it is linked with here, and the least id of its tree."""
    if not len(a):
        return None
    ids, at = np.unique(np.r_[a, b], return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    links = np.bincount(i, nb, len(ids)) + np.bincount(j, na, len(ids))
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[i], root[j])
        was = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == was).all():
            break
    return pa.record_batch(
        [pa.array(ids, pa.int64()), pa.array(links.astype(np.int64)), pa.array(ids[root], pa.int64())],
        names=["rep", "links", "root"],
    )


def links_of(classes: DataFrame, threshold: float) -> DataFrame:
    """rep, links, root: partial sums of links per class, and edges of forests."""
    total = 2 - 2 * threshold
    cuts = cell_cuts(classes, classes.count())
    cells = resident_counts(classes, cuts, total)
    if sum(math.prod(len(c) + 1 for c in block) for block in cuts) <= SMALL_CELLS:
        cells = F.broadcast(cells)
    key = ["dim", "block", "cell"]
    chunks = F.ceil(F.col("_rows") / CELL_ROWS).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("_chunks")).cast("int")
    # A resident visits the later chunks of its cell, a guest all of them.
    dealt = (
        placed(classes, cuts, total)
        .join(cells, key)
        .withColumn("_chunks", chunks)
        .withColumn("_own", F.when(F.col("guest"), F.lit(0)).otherwise(own))
        .withColumn("chunk", F.explode(F.sequence("_own", F.col("_chunks") - 1)))
        .select(
            *key, "chunk", (F.col("guest") | (F.col("chunk") > F.col("_own"))).alias("guest"),
            "unit", "rep", "n",
        )
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chunk = None, None
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            change = np.zeros(batch.num_rows, dtype=bool)
            for column in columns:
                change[1:] |= column[1:] != column[:-1]
            starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for low, high in zip(starts, starts[1:]):
                tile = tuple(int(c[low]) for c in columns[:4])
                if tile != current:
                    current, chunk = tile, _Chunk(tile[0], tile[1], total, threshold)
                for at in range(low, high, VISITORS):
                    rows = batch.slice(at, min(VISITORS, high - at))
                    unit = _stacked(rows.column(5))
                    ids, n = rows.column(6).to_numpy(), rows.column(7).to_numpy()
                    own = None
                    if not columns[4][low]:
                        own = len(chunk.ids)
                        chunk.settle(unit, ids, n)
                        # Earlier residents meet the new ones, and these each other.
                        for before in range(0, own, VISITORS):
                            part = slice(before, min(before + VISITORS, own))
                            found = chunk_part(chunk, part, own)
                            if found is not None:
                                yield found
                    found = None
                    if len(chunk.ids):
                        found = chunk.meet(unit, ids, n, own)
                    if found is not None:
                        yield found

    def chunk_part(chunk: _Chunk, part: slice, new: int):
        fresh = _Chunk(chunk.dim, chunk.block, total, threshold)
        fresh.settle(chunk.unit[new:], chunk.ids[new:], chunk.n[new:])
        return fresh.meet(chunk.unit[part], chunk.ids[part], chunk.n[part], None)

    return (
        dealt.repartition(*key, "chunk")
        .sortWithinPartitions(*key, "chunk", "guest")
        .mapInArrow(join, "rep bigint, links bigint, root bigint")
    )


def near_vectors(rows: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id (smallest vec_id reachable), kept, per row."""
    sound = F.coalesce(
        (F.size("embedding") > 0)
        & F.forall(
            "embedding",
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
        )
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    keyed = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.when(sound, F.col("embedding").cast("array<double>")).alias("_x"),
    ).withColumns({"_a": F.xxhash64("_x"), "_b": F.xxhash64(F.lit(1), F.reverse("_x"))})
    full = keyed.where("_x is not null")

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            unit = [unit_rows(np.array([v]))[0].tobytes() for v in vectors]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([len(v) for v in vectors], pa.int32())]
                + [pa.array(unit, pa.binary())],
                names=["rep", "n", "dim", "unit"],
            )

    classes = full.groupBy("_a", "_b").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("_x").alias("_x")
    )
    vectors = staged(
        classes.select("rep", "n", "_x").mapInArrow(units, "rep bigint, n bigint, dim int, unit binary"),
        "vectors",
    )
    found = cut(links_of(vectors, threshold))
    sums = found.groupBy("rep").agg(F.sum("links").alias("_links"))
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per = (
        classes.select("_a", "_b", "rep", "n")
        .join(sums, "rep", "left")
        .join(linked.withColumnRenamed("id", "rep"), "rep", "left")
        .select(
            "_a",
            "_b",
            (F.col("n") - 1 + F.coalesce("_links", F.lit(0).cast("bigint"))).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        )
    )
    done = skew_join(full.select("vec_id", "_a", "_b"), per, ["_a", "_b"], "left")
    done = done.select("vec_id", "n_links", "component_id")
    alone = keyed.where("_x is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return done.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
