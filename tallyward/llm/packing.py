"""Pack documents into sequences of a fixed number of tokens.

Every document is encoded once; pieces get a rank among the pieces of their length
in the task that made them. The histogram of lengths, never longer than a sequence
holds tokens, goes to the driver. There a configuration linear program (cover every
length's pieces with whole-sequence patterns, using as few patterns as possible) is
solved by multiplicative weights: lengths that are covered little weigh more, and a
knapsack dynamic program over the sequence's tokens prices the next pattern. The
fractions are rounded down; what is left is priced the same way and taken in whole
patterns until few pieces per length remain, which best fit packs, longest first. The
result is a list of patterns with multiplicities, from which every piece finds its
sequence and offset by its length and rank.

NULL texts count as empty; an empty text is one piece of one id, the end id.
Repeated rows are packed one by one; other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .tokens import encoder, slices

CAPACITY = 2048
# Patterns priced at most, and how sharply weights fall with coverage.
ROUNDS = 200
RATE = 3.0
# Pieces per length that best fit gets.
FEW = 16

PIECE_SCHEMA = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"
)


def token_pieces(
    docs: DataFrame, name: str, path: str, end_id: int, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of every document, each with its rank in (part, length).

    A document of more than `capacity` ids is cut into pieces of `capacity`, the
    first one shorter if it does not divide.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
        + [("ids_crc32", pa.int64()), ("part", pa.int32()), ("rank", pa.int64())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(name, path), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        seen = [0] * (capacity + 1)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for at, some in slices(texts):
                rows: list[tuple] = []
                for key, ids in zip(keys[at:], coder.encode(some)):
                    ids += end
                    n = len(ids) // 4
                    stop = n % capacity or capacity
                    start = piece = 0
                    while start < n:
                        stop = min(stop, n)
                        crc = zlib.crc32(ids[4 * start : 4 * stop])
                        size = stop - start
                        rows.append((key, piece, start, size, crc, part, seen[size]))
                        seen[size] += 1
                        start, stop, piece = stop, stop + capacity, piece + 1
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(cut, PIECE_SCHEMA)


def best_pattern(lengths: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """How often each length stands in a pattern of the greatest worth (ascending lengths)."""
    last = np.full(capacity + 1, -1, dtype=np.int64)
    # The best of a size stands at capacity - size, so that what a size is made of lies side by side.
    best = np.zeros(capacity + 1)
    dense = np.full(capacity + 1, -np.inf)
    dense[lengths] = worth
    place = np.zeros(capacity + 1, dtype=np.int64)
    place[lengths] = np.arange(len(lengths))
    low, value = int(lengths[0]), np.empty(capacity + 1)
    for size in range(low, capacity + 1):
        at = capacity - size
        high = min(size, int(lengths[-1]))
        some = np.add(best[at + low : at + high + 1], dense[low : high + 1], out=value[: high + 1 - low])
        k = int(some.argmax())
        if some[k] > best[at + 1]:
            best[at], last[size] = some[k], place[low + k]
        else:
            best[at] = best[at + 1]
    counts, size = np.zeros(len(lengths), dtype=np.int64), capacity
    while size > 0:
        if last[size] < 0:
            size -= 1
        else:
            counts[last[size]] += 1
            size -= int(lengths[last[size]])
    return counts


def fractional_patterns(
    lengths: np.ndarray, numbers: np.ndarray, capacity: int, rounds: int = ROUNDS
) -> list[tuple[np.ndarray, float]]:
    """Patterns and their fractional multiplicities, by multiplicative weights.

    A length's weight falls from twice to once its share of the sequence, the dual
    of a packing without gaps, so full patterns of uncovered lengths come first.
    """
    covered = np.zeros(len(lengths))
    found: dict[bytes, list] = {}
    for _ in range(min(rounds, 20 * len(lengths))):
        worth = lengths * (1 + np.exp(-RATE * (covered - covered.min()))) / capacity
        pattern = best_pattern(lengths, worth, capacity)
        used = pattern > 0
        step = float((numbers[used] / pattern[used]).min())
        covered[used] += pattern[used] * step / numbers[used]
        found.setdefault(pattern.tobytes(), [pattern, 0.0])[1] += step
    scale = max(1.0, float(np.median(covered)))
    return [(pattern, amount / scale) for pattern, amount in found.values()]


def exhaust(
    lengths: np.ndarray, left: np.ndarray, capacity: int
) -> list[tuple[np.ndarray, int]]:
    """Whole patterns until at most FEW pieces per length are left; `left` is lowered.

    A pattern is taken until a length runs out, so the steps follow the number of
    lengths, however many pieces there are.
    """
    found, numbers, covered = [], left.astype(float), np.zeros(len(left))
    while left.sum() > FEW * len(left):
        (open_,) = np.nonzero(left)
        worth = 1 + np.exp(-RATE * (covered[open_] - covered[open_].min()))
        pattern = np.zeros(len(left), dtype=np.int64)
        pattern[open_] = np.minimum(best_pattern(lengths[open_], worth * lengths[open_], capacity), left[open_])
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        left -= times * pattern
        covered[used] += pattern[used] * times / numbers[used]
        found.append((pattern, times))
    return found


def best_fit(lengths: np.ndarray, numbers: np.ndarray, capacity: int) -> list[list[int]]:
    """Longest first, each into the fullest sequence that still holds it; lists of
    places in `lengths`. Sequences are kept by room, so a step looks at rooms only."""
    rooms: list[list[list[int]]] = [[] for _ in range(capacity + 1)]
    held = np.zeros(capacity + 1, dtype=bool)
    for k in range(len(lengths) - 1, -1, -1):
        size = int(lengths[k])
        for _ in range(int(numbers[k])):
            room = size + int(held[size:].argmax())
            if held[room]:
                sequence = rooms[room].pop()
                held[room] = bool(rooms[room])
            else:
                sequence, room = [], capacity
            sequence.append(k)
            rooms[room - size].append(sequence)
            held[room - size] = True
    return [s for room in rooms for s in room]


def pack_histogram(
    histogram: Mapping[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS
) -> list[tuple[int, dict[int, int]]]:
    """Multiplicities and patterns (length → times) that hold exactly these pieces."""
    out = [(n, {capacity: 1}) for size, n in histogram.items() if size == capacity]
    lengths = np.array(sorted(s for s in histogram if s < capacity), dtype=np.int64)
    left = np.array([histogram[int(s)] for s in lengths], dtype=np.int64)
    if not len(lengths):
        return out
    patterns = fractional_patterns(lengths, left.astype(float), capacity, rounds)
    for pattern, amount in sorted(patterns, key=lambda p: -p[1]):
        used = pattern > 0
        times = int(min(np.floor(amount + 1e-9), (left[used] // pattern[used]).min()))
        if times > 0:
            left = left - times * pattern
            out.append((times, {int(s): int(n) for s, n in zip(lengths, pattern) if n}))
    for pattern, times in exhaust(lengths, left, capacity):
        out.append((times, {int(s): int(n) for s, n in zip(lengths, pattern) if n}))
    again: dict[tuple[int, ...], int] = {}
    for sequence in best_fit(lengths, left, capacity):
        again[tuple(sequence)] = again.get(tuple(sequence), 0) + 1
    for places, times in again.items():
        counts: dict[int, int] = {}
        for k in places:
            counts[int(lengths[k])] = counts.get(int(lengths[k]), 0) + 1
        out.append((times, counts))
    return out


def pattern_rows(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, ...]]:
    """(length, first rank, end rank, each, first sequence, offset) per pattern and length."""
    rows, ranks, sequence = [], {}, 0
    for times, counts in patterns:
        offset = 0
        for size in sorted(counts, reverse=True):
            each = counts[size]
            first = ranks.get(size, 0)
            ranks[size] = first + times * each
            rows.append((size, first, ranks[size], each, sequence, offset))
            offset += size * each
        sequence += times
    return rows


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """Add sequence_id and offset to pieces that are read from a written table.

    The plan that is broadcast has a row per pattern and length. There are at most
    `rounds` patterns from the program, a few per length from `exhaust`, and FEW
    per length from best fit, so its size follows `capacity`, not the pieces: some
    megabytes at 2048.
    """
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    rows = pattern_rows(pack_histogram(histogram, capacity, rounds))
    plan = spark.createDataFrame(
        rows or [(0, 0, 0, 1, 0, 0)],
        "length bigint, _from bigint, _to bigint, _each bigint, _sequence bigint, _offset bigint",
    )
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(
        "part",
        "length",
        F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint")).alias("_ahead"),
    )
    ranked = pieces.join(ahead, ["part", "length"]).withColumn("_r", F.col("rank") + F.col("_ahead"))
    inside = (
        (ranked["length"] == plan["length"])
        & (ranked["_r"] >= plan["_from"])
        & (ranked["_r"] < plan["_to"])
    )
    turn = F.col("_r") - F.col("_from")
    return ranked.join(F.broadcast(plan), inside).select(
        "doc_id",
        "piece",
        "start",
        ranked["length"],
        "ids_crc32",
        (F.col("_sequence") + F.floor(turn / F.col("_each")).cast("bigint")).alias("sequence_id"),
        (F.col("_offset") + turn % F.col("_each") * ranked["length"]).alias("offset"),
    )


def pack_documents(
    docs: DataFrame, name: str, path: str, end_id: int, capacity: int = CAPACITY
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    return pack_pieces(staged(token_pieces(docs, name, path, end_id, capacity), "pieces"), capacity)
