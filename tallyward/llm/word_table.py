"""BPE encoding and decoding through a table of distinct words.

Texts are split into words in tasks. A block of consecutive texts keeps its distinct
words once and every text as numbers of these words, so positions cost little more
than the compressed text. The words of all blocks are dealt to buckets by hash, and a
bucket's distinct words are encoded once each; their ids go back to the blocks, one
compressed row per block and bucket, and from there by number to every position.
Decoding joins the blocks with the vocabulary's pieces, some thousand ids to a row, and
puts pieces at the ids' positions.

The tokenizer cuts at ASCII white space, so a text's ids are those of its words in a
row. A word's ASCII letters are lowered as the tokenizer does it, and a full stop or
comma after a letter is a word of its own; words with "<|" stay as they are, since
special tokens are found before letters are lowered.

A NULL text counts as empty; an empty text, or one of white space, has no ids and the
empty decoded text. Every row gives a row, rows that share a doc_id or have none too;
doc_id is cast to a long, other columns are ignored. A long text is cut into rows of
its block like many short ones. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .token_files import ids_of, planes_of
from .tokens import slices

# Text of a block in bytes; a block also ends with its task.
BLOCK_BYTES = 64_000_000
# Distinct words of a block, some 200 bytes each while it is built.
BLOCK_WORDS = 800_000
# Text split at once.
SLICE_BYTES = 4_000_000
# Words in one row of the staged table, and in a bucket, some 200 bytes each there.
ROW_WORDS = 100_000
BUCKET_WORDS = 1_000_000
# Buckets there are at least, and ids in one row of pieces.
LEAST_BUCKETS = 64
ROW_PIECES = 4096
# Kinds of rows, in the order in which a block is put together.
WORDS, PIECES, RAW, TEXTS = 1, 2, 3, 4
# A full stop or comma that is a word of its own.
MARKS = (b".", b",")
BETWEEN = "<|endoftext|>"

BLOCK_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("kind", pa.int32()),
        ("no", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("codes", pa.binary()),
        ("more", pa.binary()),
        ("words", pa.list_(pa.string())),
    ]
)
BLOCK_DDL = (
    "block bigint, kind int, no int, doc_ids array<bigint>, lengths array<bigint>, "
    "codes binary, more binary, words array<string>"
)


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as compressed byte planes."""
    import zstandard

    planes = planes_of(numbers, "byte").tobytes()
    return len(numbers).to_bytes(8, "little") + zstandard.ZstdCompressor(level=9).compress(planes)


def unpacked(data: bytes) -> np.ndarray:
    import zstandard

    n = int.from_bytes(data[:8], "little")
    planes = zstandard.ZstdDecompressor().decompress(data[8:], max_output_size=4 * n or 1)
    return ids_of(np.frombuffer(planes, dtype=np.uint8).reshape(4, n), n)


def stem_of(word: bytes) -> tuple[bytes, bytes]:
    """What of a word is looked up, and the mark after it, if that stands apart."""
    if b"<|" in word:
        return word, b""
    word = word.lower()
    if word[-1:] in MARKS and word[-2:-1].isalpha():
        return word[:-1], word[-1:]
    return word, b""


class Block:
    """Texts as numbers of their distinct words."""

    def __init__(self, number: int):
        self.number, self.size, self.rows = number, 0, 0
        self.codes: dict[bytes, int] = defaultdict(count().__next__)

    def row(self, kind: int, no: int, **values: object) -> pa.RecordBatch:
        values |= {"block": self.number, "kind": kind, "no": no}
        return pa.record_batch(
            [pa.array([values.get(f.name)], f.type) for f in BLOCK_SCHEMA], BLOCK_SCHEMA
        )

    def add(self, keys: list[int | None], texts: list[bytes]) -> pa.RecordBatch:
        words = [text.split() for text in texts]
        lengths = [len(w) for w in words]
        found = (self.codes[w] for some in words for w in some)
        codes = np.fromiter(found, dtype="<u4", count=sum(lengths))
        self.size += sum(map(len, texts))
        self.rows += 1
        return self.row(TEXTS, self.rows, doc_ids=keys, lengths=lengths, codes=packed(codes))

    def full(self) -> bool:
        return self.size >= BLOCK_BYTES or len(self.codes) >= BLOCK_WORDS

    def close(self) -> Iterator[pa.RecordBatch]:
        """The words to look up, and which of them each word of a text stands for."""
        stems: dict[bytes, int] = defaultdict(count().__next__)
        pairs = [stem_of(word) for word in self.codes]
        # A mark takes a number where it first occurs, like any other word.
        numbers = np.fromiter((stems[w] for pair in pairs for w in pair if w), dtype=np.int64)
        marked = np.fromiter((bool(m) for _, m in pairs), dtype="<u4", count=len(pairs))
        yield self.row(RAW, 0, codes=packed(marked), more=packed(gaps(numbers)))
        words = [w.decode() for w in stems]
        for no, at in enumerate(range(0, len(words), ROW_WORDS)):
            yield self.row(WORDS, no, words=words[at : at + ROW_WORDS])


def gaps(numbers: np.ndarray) -> np.ndarray:
    """How far each number lies below the next new one; numbers are given in turn."""
    top = np.concatenate([[-1], np.maximum.accumulate(numbers)[:-1]]) if len(numbers) else numbers
    return top + 1 - numbers


def numbers_of(found: np.ndarray) -> np.ndarray:
    """The numbers whose gaps these are."""
    new = found == 0
    return np.cumsum(new) - new - found


def split_words(docs: DataFrame) -> DataFrame:
    """Blocks of the documents: rows of words, of word numbers per text, and of stems."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, turn = TaskContext.get().partitionId() << 32, count()
        block = Block(task + next(turn))
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for at, some in slices(texts, SLICE_BYTES):
                yield block.add(keys[at : at + len(some)], some)
                if block.full():
                    yield from block.close()
                    block = Block(task + next(turn))
        if block.rows:
            yield from block.close()

    # A task takes as many input splits as fill a block, while cores have tasks enough.
    octets = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    cores = docs.sparkSession.sparkContext.defaultParallelism
    tasks = max(2 * cores, -(-octets // BLOCK_BYTES))
    ready = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return ready.coalesce(tasks).mapInArrow(split, BLOCK_DDL)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def encode_words(path: str, words: list[str]) -> list[list[int]]:
    """Ids of each word; plain words are encoded in one text with a special token between."""
    coder = tokenizer(path)
    between = coder.token_to_id(BETWEEN)
    plain = [w for w in words if "<|" not in w]
    odd = [w for w in words if "<|" in w]
    found = dict(zip(odd, (e.ids for e in coder.encode_batch_fast(odd, add_special_tokens=False))))
    (all_ids,) = coder.encode_batch_fast([BETWEEN.join(plain)], add_special_tokens=False)
    ids = np.array(all_ids.ids, dtype=np.int64)
    ends = [*np.flatnonzero(ids == between).tolist(), len(ids)]
    at, flat = 0, ids.tolist()
    for word, end in zip(plain, ends):
        found[word] = flat[at:end]
        at = end + 1
    return [found[w] for w in words]


def bucket_words(blocks: DataFrame) -> DataFrame:
    """Words by bucket: (bucket, block, places, words), the words compressed in order."""
    held = blocks.where(F.col("kind") == WORDS)
    total = held.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_WORDS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=9)
        for batch in batches:
            for r in range(batch.num_rows):
                block, no, words = (batch.column(c)[r].as_py() for c in range(3))
                by: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
                for place, word in enumerate(words, no * ROW_WORDS):
                    octets = word.encode()
                    by[zlib.crc32(octets) % buckets].append((octets, place))
                keys, places, packs = list(by), [], []
                for some in by.values():
                    places.append(packed(np.diff([p for _, p in some], prepend=0)))
                    packs.append(press.compress(b" ".join(w for w, _ in some)))
                yield pa.record_batch(
                    {
                        "bucket": pa.array(keys, pa.int32()),
                        "block": pa.array([block] * len(keys), pa.int64()),
                        "places": pa.array(places, pa.binary()),
                        "words": pa.array(packs, pa.binary()),
                    }
                )

    return held.select("block", "no", "words").mapInArrow(
        deal, "bucket int, block bigint, places binary, words binary"
    )


def word_ids(bucketed: DataFrame, path: str) -> DataFrame:
    """(block, places, sizes, ids): every distinct word of a bucket is encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press, now, known = zstandard.ZstdDecompressor(), None, {}
        for batch in batches:
            buckets = batch.column(0).to_pylist()
            sizes, ids = [], []
            for bucket, data in zip(buckets, batch.column(3).to_pylist()):
                if bucket != now:
                    now, known = bucket, {}
                words = press.decompress(data).decode().split(" ")
                new = [w for w in words if w not in known]
                known.update(zip(new, encode_words(path, new)))
                found = [known[w] for w in words]
                sizes.append(packed(np.array([len(f) for f in found])))
                ids.append(packed(np.fromiter(chain.from_iterable(found), dtype=np.int64)))
            yield pa.record_batch(
                {
                    "block": batch.column(1),
                    "places": batch.column(2),
                    "sizes": pa.array(sizes, pa.binary()),
                    "ids": pa.array(ids, pa.binary()),
                }
            )

    dealt = bucketed.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(encode, "block bigint, places binary, sizes binary, ids binary")


def id_pieces(spark, path: str) -> DataFrame:
    """The vocabulary as rows (no, pieces) of ROW_PIECES ids each, from no * ROW_PIECES on.

    Pieces hold no white space, so a row's are one compressed text; ids without a piece,
    which no text has, are empty in it.
    """
    import zstandard

    press = zstandard.ZstdCompressor(level=9)
    names = {i: p for p, i in tokenizer(path).get_vocab(with_added_tokens=True).items()}
    rows = [
        (no, press.compress(" ".join(names.get(no * ROW_PIECES + k, "") for k in range(ROW_PIECES)).encode()))
        for no in range(max(names) // ROW_PIECES + 1)
    ]
    return spark.createDataFrame(rows, "no int, pieces binary")


def _spread(
    values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, picks: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Runs of `values`, of given starts and sizes, picked in a row; and the picked sizes."""
    taken = sizes[picks]
    ends = np.cumsum(taken)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) - np.repeat(ends - taken - starts[picks], taken)
    return values[at], taken


def _bounds(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


class Assembly:
    """The tables of one block while its texts are put together."""

    def __init__(self):
        self.places: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.pieces: dict[int, bytes] = {}

    def words(self, places: bytes, sizes: bytes, ids: bytes) -> None:
        # Places ascend and are kept as differences.
        self.places.append(np.cumsum(unpacked(places).astype(np.int64)))
        for held, data in ((self.sizes, sizes), (self.ids, ids)):
            held.append(unpacked(data).astype(np.int64))

    def close(self, marked: bytes, found: bytes) -> None:
        """Ids and decoded text of every word that stands in a text."""
        none = np.empty(0, dtype=np.int64)
        places, found_sizes, values = (
            np.concatenate([none, *held]) for held in (self.places, self.sizes, self.ids)
        )
        starts, sizes = np.empty_like(places), np.empty_like(places)
        starts[places], sizes[places] = _bounds(found_sizes)[:-1], found_sizes
        stems = numbers_of(unpacked(found).astype(np.int64))
        self.values, per_stem = _spread(values, starts, sizes, stems)
        bounds = _bounds(per_stem)[_bounds(1 + unpacked(marked).astype(np.int64))]
        self.starts, self.n = bounds[:-1], np.diff(bounds)
        flat = [self.pieces[i] for i in self.values.tolist()]
        edges = bounds.tolist()
        self.decoded = [b" ".join(flat[a:b]) for a, b in zip(edges, edges[1:])]
        self.silent = bool((self.n == 0).any())

    def texts(self, keys: list, lengths: list[int], codes: bytes) -> Iterator[tuple]:
        """(doc_id, ids, decoded text in UTF-8) of each text in a row of the block."""
        picks = unpacked(codes).astype(np.int64)
        ids, taken = _spread(self.values, self.starts, self.n, picks)
        ids, sums = ids.astype("<u4"), _bounds(taken)
        at = 0
        for key, length in zip(keys, lengths):
            mine = picks[at : at + length]
            if self.silent:
                mine = mine[self.n[mine] > 0]
            text = b" ".join(map(self.decoded.__getitem__, mine.tolist()))
            yield key, ids[sums[at] : sums[at + length]], text
            at += length


PART_COLUMNS = (
    "block", "kind", "no", "places", "sizes", "ids", "pieces", "doc_ids", "lengths", "codes", "more",
)
OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
        ("ids", pa.binary()),
        ("decoded", pa.string()),
    ]
)


def codec(docs: DataFrame, path: str, whole: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens and SHA-256 of its ids and of the text decoded from them.

    With `whole` also the ids (little-endian unsigned 32-bit) and the decoded text.
    """
    spark = docs.sparkSession
    blocks = staged(split_words(docs), "word-blocks", compression="zstd")
    found = word_ids(bucket_words(blocks), path).withColumns({"kind": F.lit(WORDS), "no": F.lit(0)})
    # As many rows as the tokenizer's vocabulary asks for.
    vocabulary = id_pieces(spark, path)
    rows = F.sequence(F.lit(0), F.lit(vocabulary.count() - 1))
    pieces = (
        blocks.where(F.col("kind") == RAW)
        .select("block", F.explode(rows).alias("no"))
        .join(F.broadcast(vocabulary), "no")
        .withColumn("kind", F.lit(PIECES))
    )
    parts = (
        blocks.where(F.col("kind").isin(RAW, TEXTS))
        .drop("words")
        .unionByName(found, allowMissingColumns=True)
        .unionByName(pieces, allowMissingColumns=True)
        .select(*PART_COLUMNS)
    )
    schema = pa.schema(list(OUT) if whole else list(OUT)[:4])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        held, now, unpress = Assembly(), None, zstandard.ZstdDecompressor()
        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(c)[r] for c, name in enumerate(PART_COLUMNS)}
                block, kind = row["block"].as_py(), row["kind"].as_py()
                if block != now:
                    held, now = Assembly(), block
                if kind == WORDS:
                    held.words(*(row[c].as_py() for c in ("places", "sizes", "ids")))
                elif kind == PIECES:
                    first = row["no"].as_py() * ROW_PIECES
                    pieces = unpress.decompress(row["pieces"].as_py()).split(b" ")
                    held.pieces |= {first + k: p for k, p in enumerate(pieces)}
                elif kind == RAW:
                    held.close(row["codes"].as_py(), row["more"].as_py())
                else:
                    texts = held.texts(*(row[c].as_py() for c in ("doc_ids", "lengths", "codes")))
                    yield _answer(texts, schema, whole)

    ordered = parts.repartition("block").sortWithinPartitions("block", "kind", "no")
    ddl = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return ordered.mapInArrow(assemble, ddl + (", ids binary, decoded string" if whole else ""))


def _answer(texts: Iterator[tuple], schema: pa.Schema, whole: bool) -> pa.RecordBatch:
    rows = []
    for key, ids, text in texts:
        data = ids.tobytes()
        row = [key, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(text).hexdigest()]
        rows.append([*row, data, text.decode()] if whole else row)
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema)
