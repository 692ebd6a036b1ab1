"""Language of whole texts by a blended-spectrum string kernel.

A text is the set of byte n-grams (one to three bytes, A-Z as a-z) it contains,
hashed to a fixed number of features; the kernel of two texts is the cosine of
their sets. A bounded sample of labelled documents of every language is reduced to
feature bitmaps by the executors. On the driver, landmarks drawn from it give a
Nyström approximation of the kernel, and ridge regression on it, one language
against the rest, gives weights per landmark. Scoring is batched: a matrix of
feature sets times the landmarks' sets, then times the weights.

What part of a text's kernel norm its projection on the landmarks keeps tells whether
it is in a learned language at all. The least part is learned from the sample, by the
number of features, each landmark projected on the others only.

A text that is NULL or has no letter is `und` with score 0. Documents without a
label, or held out, are not learned from; every other label is learned, and more than
MAX_LANGS of them are an error. Without any label all texts are `und`. Repeated rows are
scored one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .octets import LOWER, mixed, runs
from .tokens import release

FEATURES = 1 << 13
GRAMS = (1, 2, 3)
# Documents learned from: at most this many per language. More languages are an error,
# as the sample, some 200 kB for each, is learned from on the driver.
PER_LANG = 200
MAX_LANGS = 256
# Landmarks there are at least, and at least for each language.
LANDMARKS = 160
LANDMARKS_PER_LANG = 8
RIDGE = 0.1
# A text of a learned language keeps at least this share of what nearly all of the sample keep
# (all but KEPT_BELOW in a hundred) that have as many features to within a factor of two.
KEPT_SHARE = 0.5
KEPT_BELOW = 1
# Sizes of which the sample has fewer texts take the next smaller size's least part.
ENOUGH = 5
# Texts scored at a time.
ROWS = 256
UNKNOWN = "und"
# Any letter: a word character that is neither a digit nor an underscore.
LETTER = r"\p{L}"


@dataclass(frozen=True)
class Model:
    """Landmark feature sets scaled by their norms, weights per landmark, languages.

    root maps kernel values to coordinates; least has the least part by size class.
    """

    landmarks: np.ndarray
    weights: np.ndarray
    langs: tuple[str, ...]
    root: np.ndarray
    least: np.ndarray


def size_classes(sets: np.ndarray) -> np.ndarray:
    """Texts of as many features to within a factor of two have one class."""
    return np.log2(np.maximum((sets > 0).sum(axis=1), 1)).astype(np.int64)


def least_parts(parts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Least part per size class; 0 where neither it nor a smaller one has texts enough."""
    least = np.zeros(int(np.log2(FEATURES)) + 1)
    for k in range(len(least)):
        own = parts[classes == k]
        if len(own) >= ENOUGH:
            least[k] = KEPT_SHARE * np.percentile(own, KEPT_BELOW)
        elif k:
            least[k] = least[k - 1]
    return least


def feature_sets(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of FEATURES zeros and ones per text."""
    rows = len(bounds) - 1
    out = np.zeros((rows, FEATURES), dtype=np.float32)
    low = LOWER[data].astype(np.uint64)
    owner = np.repeat(np.arange(rows), np.diff(bounds))
    for n in GRAMS:
        count = len(low) - n + 1
        if count <= 0:
            break
        code = np.full(count, n, dtype=np.uint64)
        for k in range(n):
            code = code * np.uint64(257) + low[k : k + count]
        inside = owner[:count] == owner[n - 1 :]
        place = (mixed(code) % np.uint64(FEATURES)).astype(np.int64)
        out[owner[:count][inside], place[inside]] = 1.0
    return out


def unit_rows(sets: np.ndarray) -> np.ndarray:
    return sets / np.sqrt(np.maximum(sets.sum(axis=1, keepdims=True), 1.0))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """lang and feature bitmap (FEATURES / 8 bytes) of the documents to learn from.

    The first per_lang of each language by a hash of doc_id, among documents that
    are labelled, not held out, and have a letter. At most per_lang * MAX_LANGS rows.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & ~held_out() & F.col("text").rlike(LETTER)
    ).select("doc_id", "lang", "text")
    if usable.select("lang").distinct().limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, bounds in runs(batch.column(2), 500_000):
                bits = np.packbits(feature_sets(data, bounds).astype(bool), axis=1)
                n = len(bits)
                yield pa.record_batch(
                    [batch.column(0).slice(at, n), batch.column(1).slice(at, n)]
                    + [pa.array([b.tobytes() for b in bits], pa.binary())],
                    names=["doc_id", "lang", "bits"],
                )

    by_hash = Window.partitionBy("lang").orderBy("_order", "doc_id")
    # Ranking sees narrow rows and keeps per_lang of each task before they meet.
    chosen = (
        usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("_order"))
        .withColumn("_rank", F.row_number().over(by_hash))
        .where(F.col("_rank") <= per_lang)
        .select("doc_id")
    )
    # At most per_lang * MAX_LANGS ids.
    texts = usable.join(F.broadcast(chosen.distinct()), "doc_id", "left_semi")
    bits = texts.mapInArrow(reduce, "doc_id bigint, lang string, bits binary")
    return bits.dropDuplicates(["doc_id", "lang"]).select("doc_id", "lang", "bits")


def fit(docs: DataFrame, per_lang: int = PER_LANG, landmarks: int | None = None) -> Model | None:
    """Learn from the sample; None if there is nothing to learn from."""
    rows = sorted(labelled_sample(docs, per_lang).collect(), key=lambda r: (r["lang"], r["doc_id"]))
    if not rows:
        return None
    langs = tuple(sorted({r["lang"] for r in rows}))
    landmarks = landmarks or max(LANDMARKS, LANDMARKS_PER_LANG * len(langs))
    bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in rows), dtype=np.uint8)
    sets = unit_rows(np.unpackbits(bits.reshape(len(rows), -1), axis=1).astype(np.float32))
    sets = sets.astype(np.float64)
    names = np.array([r["lang"] for r in rows])
    # Landmarks are drawn from the languages in turn, so that each has some.
    turn = np.zeros(len(rows), dtype=np.int64)
    for lang in langs:
        turn[names == lang] = np.arange((names == lang).sum())
    drawn = np.argsort(turn, kind="stable")[:landmarks]
    marks = sets[drawn]
    value, vector = np.linalg.eigh(marks @ marks.T)
    kept = value > 1e-8 * value.max()
    root = vector[:, kept] / np.sqrt(value[kept])
    mapped = sets @ marks.T @ root
    wanted = np.where(names[:, None] == np.array(langs)[None, :], 1.0, -1.0)
    # Languages weigh the same, however many documents each has.
    share = np.sqrt(1.0 / np.array([(names == n).sum() for n in names]))[:, None]
    mapped_w, wanted_w = mapped * share, wanted * share
    ridge = mapped_w.T @ mapped_w + RIDGE / len(rows) * np.eye(mapped.shape[1])
    weights = root @ np.linalg.solve(ridge, mapped_w.T @ wanted_w)
    parts = (mapped**2).sum(axis=1)
    # What a landmark keeps on all others follows from the inverse of the kernel matrix.
    parts[drawn] = 1 - 1 / np.diag(np.linalg.inv(marks @ marks.T + 1e-6 * np.eye(len(marks))))
    least = least_parts(parts, size_classes(sets))
    return Model(marks.astype(np.float32), weights, langs, root, least)


def scored(model: Model | None, texts: pa.Array, lettered: np.ndarray):
    """Names, scores, and whether each is in a learned language, in blocks of ROWS."""
    # Workers are kept from stage to stage; one that encoded has no use for its known words here.
    release()
    names: list[str] = [UNKNOWN] * len(texts)
    scores, known = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
    if model is None:
        return names, scores, known
    for at, data, bounds in runs(texts, 1_000_000):
        for low in range(0, len(bounds) - 1, ROWS):
            part = bounds[low : low + ROWS + 1]
            sets = feature_sets(data[part[0] : part[-1]], part - part[0])
            kernel = unit_rows(sets) @ model.landmarks.T
            value = kernel @ model.weights
            parts = ((kernel @ model.root) ** 2).sum(axis=1)
            known[at + low : at + low + len(sets)] = parts >= model.least[size_classes(sets)]
            best = value.argmax(axis=1)
            top = np.clip((value.max(axis=1) + 1) / 2, 0.0, 1.0)
            for k, (lang, sure) in enumerate(zip(best.tolist(), top.tolist()), at + low):
                if lettered[k]:
                    names[k], scores[k] = model.langs[lang], sure
    return names, scores, known


def _lettered() -> F.Column:
    return F.coalesce(F.col("text").rlike(LETTER), F.lit(False))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every row."""
    # Landmarks and weights: some megabytes, whatever the table.
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = np.array(batch.column(3).to_pylist(), dtype=bool)
            names, scores, _ = scored(sent.value, batch.column(2), lettered)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out().alias("held_out"),
        "text",
        _lettered().alias("_lettered"),
    )
    return rows.mapInArrow(score, "doc_id bigint, held_out boolean, lang_pred string, score double")


def in_known_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs that have letters and are in a language that was learned."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = np.array(batch.column(batch.num_columns - 1).to_pylist(), dtype=bool)
            _, _, known = scored(sent.value, batch.column(at), lettered)
            rows = batch.filter(pa.array(known & lettered))
            yield pa.record_batch(rows.columns[:-1], names=docs_columns)

    docs_columns = docs.columns
    return docs.select("*", _lettered().alias("_lettered")).mapInArrow(sift, docs.schema)
