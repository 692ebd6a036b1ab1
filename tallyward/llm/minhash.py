"""Near duplicates by HyperMinHash sketches, verified on full shingle sets.

Each text becomes the set of its word shingles. A sketch splits the set's hashes
over buckets and keeps, of each bucket's least hash, the number of leading zeros and
the bits that follow, in 16 bits. Texts with equal sets are one class from then on.
Classes that agree in all registers of a band meet; where several bands bring the
same classes together, one of them is used. Those that meet are compared by the
Jaccard estimate of their registers, less the agreement expected by chance, and
only a spanning forest of what is near enough is handed on. Its components are
clusters; within a cluster the full sets are compared, again keeping a spanning
forest, so neither step writes the pairs of a group. Components of the verified
links are the result.

Bands or clusters that are too large for one task are dealt out as pairs of chunks,
with every pair of members in one of them. NULL texts and texts without words have
an empty set and are linked with nothing. Repeated rows are equal sets. Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.operators.skew import skew_join

from .common import components, cut, staged
from .groups import forest, sorted_groups
from .octets import mixed, runs, shingle_hashes, word_hashes

BUCKET_BITS = 7
MANTISSA_BITS = 10
# Registers per band: at a similarity of 0.8 one set in 5e7 shares no band.
BAND = 4
# The estimate has a deviation of 0.035 at most; members this much below the
# threshold are still compared in full.
MARGIN = 0.17
# Members of a band, and members and shingles of a cluster, that one task takes.
BAND_ROWS = 8_192
CLUSTER_ROWS = 4_096
CLUSTER_SHINGLES = 2_000_000

_SKETCH = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, registers binary"


def registers_of(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row of 16-bit registers per text, from its distinct hashes in ascending order.

    0 is an empty bucket; otherwise (leading zeros + 1) and the bits after the
    first one.
    """
    rows, buckets = len(counts), 1 << BUCKET_BITS
    out = np.zeros((rows, buckets), dtype=np.uint16)
    owner = np.repeat(np.arange(rows), counts)
    place = owner * buckets + (values >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.ones(len(values), dtype=bool)
    first[1:] = place[1:] != place[:-1]
    rest = (values[first] << np.uint64(BUCKET_BITS)) | np.uint64((1 << BUCKET_BITS) - 1)
    zeros = 64 - np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    zeros = np.maximum(zeros, 0)
    tail = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    register = ((zeros + 1) << MANTISSA_BITS) | tail.astype(np.int64)
    out.reshape(-1)[place[first]] = register.astype(np.uint16)
    return out


@lru_cache(maxsize=1)
def chance_table() -> np.ndarray:
    """Chance that two unrelated registers agree, by log2 of hashes per bucket + 1."""
    zeros = np.arange(1, 60)[:, None]
    step = np.arange(1 << MANTISSA_BITS)[None, :]
    low = (2.0**-zeros * (1 + step / (1 << MANTISSA_BITS))).ravel()
    high = (2.0**-zeros * (1 + (step + 1) / (1 << MANTISSA_BITS))).ravel()
    sizes = 2.0 ** np.arange(0, 40)
    held = np.stack(
        [np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-np.minimum(high, 1 - 1e-15))) for n in sizes]
    )
    return held @ held.T


def estimate(registers: np.ndarray, sizes: np.ndarray, x: int, others: np.ndarray) -> np.ndarray:
    """Jaccard estimates of x with others, corrected for chance agreement."""
    mine, theirs = registers[x], registers[others]
    same = ((theirs == mine) & (mine != 0)).sum(axis=1)
    union = np.maximum(((theirs != 0) | (mine != 0)).sum(axis=1), 1)
    per = np.log2(np.maximum(sizes / (1 << BUCKET_BITS), 1.0)).astype(np.int64)
    chance = chance_table()[per[x], per[others]]
    return (same / union - chance) / (1 - chance)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, set size, 128 bits that stand for the set, registers."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in runs(batch.column(1)):
                values, counts = shingle_hashes(*word_hashes(data, bounds), width)
                ends = np.cumsum(np.r_[0, counts])
                total = np.cumsum(np.r_[np.uint64(0), mixed(values)])
                other = np.cumsum(np.r_[np.uint64(0), mixed(values ^ np.uint64(0x5DEECE66D))])
                rows = registers_of(values, counts)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(at, len(counts)),
                        pa.array(counts, pa.int64()),
                        pa.array((total[ends[1:]] - total[ends[:-1]]).view(np.int64)),
                        pa.array((other[ends[1:]] - other[ends[:-1]]).view(np.int64)),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "registers"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(sketch, _SKETCH)


def band_keys(classes: DataFrame) -> DataFrame:
    """key, rep for every band of a class that is not empty throughout."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint64)
            rows = flat.reshape(batch.num_rows, -1)
            number = np.arange(rows.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            keys = mixed(mixed(rows) + number[None, :])
            who, band = np.nonzero(rows)
            ids = batch.column(0).to_numpy()
            yield pa.record_batch(
                [pa.array(keys[who, band].view(np.int64)), pa.array(ids[who])], names=["key", "rep"]
            )

    return classes.select("rep", "registers").mapInArrow(bands, "key bigint, rep bigint")


def _chunks(members: DataFrame, rep: str, number: Column) -> DataFrame:
    """Copies of members for all pairs of chunks (_i <= _j) that hold their chunk."""
    return (
        members.withColumn("_n", number.cast("int"))
        .withColumn("_own", F.pmod(F.xxhash64(rep), F.col("_n")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .withColumn("_i", F.least("_own", "_other"))
        .withColumn("_j", F.greatest("_own", "_other"))
        .drop("_n", "_own", "_other")
    )


def candidate_links(classes: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) whose components hold all classes that may be linked."""
    keys = band_keys(classes)
    met = (
        keys.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min("rep").alias("_low"),
            F.bit_xor(F.xxhash64("rep")).alias("_who"),
        )
        .where("_rows > 1")
    )
    # Bands that bring the same classes together do so for one of them.
    met = met.groupBy("_rows", "_low", "_who").agg(F.min("key").alias("key")).select("key", "_rows")
    members = keys.join(met, "key").join(classes.select("rep", "n_shingles", "registers"), "rep")
    number = F.ceil(F.col("_rows") / BAND_ROWS)
    dealt = _chunks(members, "rep", number).select(
        "key", "_i", "_j", "rep", "n_shingles", "registers"
    )
    least = threshold - MARGIN

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in sorted_groups(batches, 3):
            ids = rows.column(3).to_numpy()
            sizes = rows.column(4).to_numpy()
            flat = np.frombuffer(b"".join(rows.column(5).to_pylist()), dtype=np.uint16)
            table = flat.reshape(len(ids), -1)
            edges = forest(len(ids), lambda x, o: estimate(table, sizes, x, o) >= least)
            yield _edges(ids, edges)

    return (
        dealt.repartition("key", "_i", "_j")
        .sortWithinPartitions("key", "_i", "_j", "rep")
        .mapInArrow(link, "a bigint, b bigint")
    )


def _edges(ids: np.ndarray, edges: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(edges, dtype=np.int64).reshape(-1, 2)
    return pa.record_batch(
        [pa.array(ids[pairs[:, 0]], pa.int64()), pa.array(ids[pairs[:, 1]], pa.int64())],
        names=["a", "b"],
    )


def _jaccard(sets: list[np.ndarray], percent: int):
    """Which others have 100 * common >= percent * union with x, on full sets."""
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    terms = np.unique(np.concatenate(sets), return_inverse=True)[1]
    flag = np.zeros(int(terms.max()) + 1, dtype=np.int32)

    def near(x: int, others: np.ndarray) -> np.ndarray:
        mine = terms[starts[x] : starts[x] + sizes[x]]
        fits = (100 * np.minimum(sizes[others], sizes[x])) >= (
            percent * np.maximum(sizes[others], sizes[x])
        )
        hit = np.zeros(len(others), dtype=bool)
        some = others[fits]
        if not len(some):
            return hit
        flag[mine] = 1
        ends = np.cumsum(sizes[some])
        place = np.repeat(starts[some] - (ends - sizes[some]), sizes[some]) + np.arange(ends[-1])
        common = np.add.reduceat(flag[terms[place]], ends - sizes[some])
        flag[mine] = 0
        union = sizes[some] + sizes[x] - common
        hit[fits] = 100 * common >= percent * union
        return hit

    return near


def verified_links(docs: DataFrame, clusters: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges (a, b) with the components of the links within clusters (rep, cluster, n_shingles)."""
    sizes = clusters.groupBy("cluster").agg(
        F.greatest(
            F.ceil(F.sum("n_shingles") / CLUSTER_SHINGLES), F.ceil(F.count(F.lit(1)) / CLUSTER_ROWS)
        ).alias("_tasks")
    )
    members = clusters.join(sizes, "cluster").select("rep", "cluster", "_tasks")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in runs(batch.column(3)):
                values, counts = shingle_hashes(*word_hashes(data, bounds), width)
                parts = np.split(values, np.cumsum(counts)[:-1])
                columns = [batch.column(k).slice(at, len(counts)) for k in range(3)]
                yield pa.record_batch(
                    [*columns, pa.array([p.tobytes() for p in parts], pa.binary())],
                    names=["cluster", "_tasks", "rep", "shingles"],
                )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text").join(members, "rep")
    sets = texts.select("cluster", F.col("_tasks").cast("bigint"), "rep", "text").mapInArrow(
        shingle, "cluster bigint, _tasks bigint, rep bigint, shingles binary"
    )
    dealt = _chunks(sets, "rep", F.col("_tasks")).select("cluster", "_i", "_j", "rep", "shingles")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in sorted_groups(batches, 3):
            ids = rows.column(3).to_numpy()
            parts = [np.frombuffer(b, dtype=np.uint64) for b in rows.column(4).to_pylist()]
            kept = [k for k, p in enumerate(parts) if len(p)]
            if len(kept) > 1:
                near = _jaccard([parts[k] for k in kept], percent)
                yield _edges(ids[kept], forest(len(kept), near))

    return (
        dealt.repartition("cluster", "_i", "_j")
        .sortWithinPartitions("cluster", "_i", "_j", "rep")
        .mapInArrow(link, "a bigint, b bigint")
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id linked), kept, per row.

    Texts are linked if 100 * common shingles >= percent * shingles of either.
    """
    rows = staged(sketches(docs, width), "sketches")
    same = ["n_shingles", "set_a", "set_b"]
    full = rows.where("n_shingles > 0")
    classes = full.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    placed = skew_join(full, classes, same, "left")
    firsts = staged(
        placed.where("doc_id = rep")
        .select("rep", "n_shingles", "registers")
        .dropDuplicates(["rep", "n_shingles"]),
        "classes",
    )
    near = components(candidate_links(firsts, percent / 100))
    clusters = near.select(F.col("id").alias("rep"), F.col("component_id").alias("cluster"))
    clusters = clusters.unionByName(
        clusters.select(F.col("cluster").alias("rep"), "cluster").distinct()
    )
    clusters = cut(clusters.join(firsts.select("rep", "n_shingles"), "rep"))
    linked = components(verified_links(docs, clusters, width, percent)).select(
        F.col("id").alias("rep"), "component_id"
    )
    found = placed.select("doc_id", "n_shingles", "rep").join(linked, "rep", "left")
    found = found.select("doc_id", "n_shingles", F.coalesce("component_id", "rep").alias("component_id"))
    alone = rows.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return found.unionByName(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))
