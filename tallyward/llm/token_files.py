"""Token ids of a corpus as files of bit-plane shuffled blocks with a chunk index.

Documents are put in ascending doc_id order by a range shuffle, each partition is
encoded as one stream, and the stream is stored as chunks of whole documents. A
chunk's ids are cut into blocks of a fixed number of ids; a block is transposed
into its four byte planes or 32 bit planes, and each plane is compressed with
zstandard. The chunk index (part, chunk, ids, documents and their lengths, sizes
of the compressed planes) lies in columns of its own, so that it is read without
the ids. The files are Parquet containers written through Spark, so a task that
runs again replaces its own output only.

NULL texts count as empty, an empty text still has the end id, equal doc_ids lie
next to each other in text order, NULL doc_ids come first, and other columns are ignored. An
empty table gives no chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tokens import encoder, slices

CHUNK_IDS = 1 << 18
BLOCK_IDS = 1 << 14
LEVEL = 3

CHUNK_SCHEMA = (
    "part int, chunk int, n_ids bigint, doc_ids array<bigint>, doc_lengths array<bigint>, "
    "plane_sizes array<int>, payload binary"
)


def planes_of(ids: np.ndarray, kind: str) -> np.ndarray:
    """Rows of bytes: the byte planes or bit planes of little-endian 32-bit ids."""
    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return np.ascontiguousarray(octets.T)
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")


def ids_of(planes: np.ndarray, n: int) -> np.ndarray:
    """The n ids whose planes these are."""
    if len(planes) == 4:
        return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)
    bits = np.unpackbits(planes, axis=1, count=n, bitorder="little")
    octets = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


def pack_blocks(ids: np.ndarray, kind: str, block: int) -> tuple[list[int], bytes]:
    import zstandard

    press = zstandard.ZstdCompressor(level=LEVEL)
    parts = [
        press.compress(plane.tobytes())
        for at in range(0, len(ids), block)
        for plane in planes_of(ids[at : at + block], kind)
    ]
    return [len(p) for p in parts], b"".join(parts)


def unpack_blocks(sizes: list[int], payload: bytes, n: int, kind: str, block: int) -> np.ndarray:
    import zstandard

    press, per = zstandard.ZstdDecompressor(), 4 if kind == "byte" else 32
    ends = np.cumsum([0, *sizes]).tolist()
    out = np.empty(n, dtype="<u4")
    for k, at in enumerate(range(0, n, block)):
        held = min(block, n - at)
        planes = [
            np.frombuffer(press.decompress(payload[ends[j] : ends[j + 1]]), dtype=np.uint8)
            for j in range(k * per, (k + 1) * per)
        ]
        out[at : at + held] = ids_of(np.vstack(planes), held)
    return out


def encode_chunks(
    docs: DataFrame,
    name: str,
    path: str,
    end_id: int,
    kind: str = "byte",
    chunk_ids: int = CHUNK_IDS,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """One row per chunk, of whole documents with at least chunk_ids ids together."""
    if kind not in ("byte", "bit"):
        raise ValueError("kind is byte or bit")
    schema = pa.schema(
        [
            ("part", pa.int32()),
            ("chunk", pa.int32()),
            ("n_ids", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_lengths", pa.list_(pa.int64())),
            ("plane_sizes", pa.list_(pa.int32())),
            ("payload", pa.binary()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(name, path), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        chunk, n_ids, held, doc_ids, lengths = 0, 0, [], [], []

        def row() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            sizes, payload = pack_blocks(ids, kind, block_ids)
            values = [part, chunk, len(ids), doc_ids, lengths, sizes, payload]
            return pa.record_batch([pa.array([v], t) for v, t in zip(values, schema.types)], schema)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for at, some in slices(texts):
                for key, ids in zip(keys[at:], coder.encode(some)):
                    held.append(ids + end)
                    doc_ids.append(key)
                    lengths.append(len(ids) // 4 + 1)
                    n_ids += lengths[-1]
                    if n_ids >= chunk_ids:
                        yield row()
                        chunk, n_ids, held, doc_ids, lengths = chunk + 1, 0, [], [], []
        if doc_ids:
            yield row()

    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(encode, CHUNK_SCHEMA)


def decode_chunks(chunks: DataFrame, kind: str = "byte", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Documents of the chunks: part, chunk, doc_id, before (ids before it in the
    chunk), n_tokens, and its ids as little-endian unsigned 32-bit integers."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack_blocks(r["plane_sizes"], r["payload"], r["n_ids"], kind, block_ids)
                ends = np.cumsum(r["doc_lengths"])
                n = len(ends)
                yield pa.record_batch(
                    {
                        "part": pa.array([r["part"]] * n, pa.int32()),
                        "chunk": pa.array([r["chunk"]] * n, pa.int32()),
                        "doc_id": pa.array(r["doc_ids"], pa.int64()),
                        "before": pa.array(ends - r["doc_lengths"], pa.int64()),
                        "n_tokens": pa.array(r["doc_lengths"], pa.int64()),
                        "ids": pa.array([x.tobytes() for x in np.split(ids, ends[:-1])], pa.binary()),
                    }
                )

    return chunks.mapInArrow(
        decode,
        "part int, chunk int, doc_id bigint, before bigint, n_tokens bigint, ids binary",
    )


def chunk_starts(chunks: DataFrame) -> DataFrame:
    """Ids before each chunk, from the index alone: part, chunk, chunk_start.

    Sums of whole parts, one row each, are run up in one task; they are as many as
    the writing tasks.
    """
    index = chunks.select("part", "chunk", "n_ids")
    before = (Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    parts = parts.select(
        "part",
        F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(*before)), none).alias("_p"),
    )
    inside = Window.partitionBy("part").orderBy("chunk").rowsBetween(*before)
    return index.withColumn("_c", F.coalesce(F.sum("n_ids").over(inside), none)).join(
        parts, "part"
    ).select("part", "chunk", (F.col("_p") + F.col("_c")).alias("chunk_start"))


def document_ids(chunks: DataFrame, kind: str = "byte", block_ids: int = BLOCK_IDS) -> DataFrame:
    """Read chunks back: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    found = decode_chunks(chunks, kind, block_ids).select(
        "part", "chunk", "doc_id", "before", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    return found.join(chunk_starts(chunks), ["part", "chunk"]).select(
        "doc_id", (F.col("chunk_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
