"""Collocations of two to five words, mined by SON partitioning.

Texts are dealt to shards of one language, and a shard is kept as its distinct words and
the texts as numbers of them. A shard that holds a share w of its language's words is
mined completely at a local support of w times the global one, rounded up: a phrase
that is frequent in the language is so in at least one shard. Inside a shard phrases
grow word by word from frequent shorter ones. The union of local finds, less those
whose counts plus what other shards may hide stay below the support, is then counted
exactly. A shard with a local support of one hides nothing, so nothing is counted again
there; shards with more are at most `support` a language, so candidates sent to them
multiply by no more. Words and pairs go first; longer phrases are mined only where all
pairs in them proved frequent, which keeps small shards from listing every rare phrase.

Words, supports and counts are per language (NULL: und). A NULL text counts as empty;
an empty table, or one without a frequent phrase, gives no rows. Repeated rows count as
often as they stand there; doc_id and other columns are ignored. A very long text stays
whole in one shard.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged
from .tokens import slices
from .word_table import packed, unpacked

SUPPORT = 100
LONGEST = 5
# Text of a shard in bytes, at most but for a single longer text, and shards of a
# language at least. With as many shards at every size, so is the local support.
SHARD_BYTES = 24_000_000
LEAST_SHARDS = 32
# Text cut at once.
SLICE_BYTES = 4_000_000

# Marks that end a piece; words lie between blanks and tabs.
ENDS = b".,;:!?\n\x0b\x0c\r"
# A byte no UTF-8 text holds stands for the end of a piece.
END = b"\xff"
TO_END = bytes.maketrans(ENDS, END * len(ENDS))
APART = b" " + END + b" "

SHARD_SCHEMA = pa.schema(
    [
        ("shard", pa.int64()),
        ("lang", pa.string()),
        ("n", pa.int64()),
        ("words", pa.list_(pa.string())),
        ("codes", pa.binary()),
    ]
)
SHARD_DDL = "shard bigint, lang string, n bigint, words array<string>, codes binary"


def cut_words(texts: list[bytes]) -> list[bytes]:
    """Words of texts in a row, END between pieces and texts."""
    return APART.join(texts).lower().translate(TO_END).replace(END, APART).split()


class Shard:
    """Words of one language under construction; END is word 0."""

    def __init__(self, number: int, lang: str):
        self.number, self.lang, self.n = number, lang, 0
        self.codes: dict[bytes, int] = defaultdict(count().__next__)
        self.codes[END]
        self.parts: list[np.ndarray] = []

    def add(self, texts: list[bytes]) -> None:
        words = cut_words(texts)
        codes = np.fromiter(map(self.codes.__getitem__, words), dtype="<u4", count=len(words))
        self.parts += [codes, np.zeros(1, dtype="<u4")]
        self.n += int(np.count_nonzero(codes))

    def row(self) -> pa.RecordBatch:
        words = [w.decode() for w in list(self.codes)[1:]]
        codes = packed(np.concatenate(self.parts))
        values = [self.number, self.lang, self.n, words, codes]
        return pa.record_batch([pa.array([v], t) for v, t in zip(values, SHARD_SCHEMA.types)], SHARD_SCHEMA)


def make_shards(docs: DataFrame) -> DataFrame:
    """Shards of the documents (text, lang), each of one language.

    Rows are dealt to their language's shards by a hash of text, id and reading task, so
    shards are of much the same size, and copies spread over them.
    """
    lang = F.coalesce("lang", F.lit("und")).alias("lang")
    text = F.coalesce("text", F.lit("")).alias("text")
    turn = F.xxhash64("text", "doc_id") + F.spark_partition_id()
    ready = docs.select(lang, text, turn.alias("_turn"))
    octets = ready.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("_octets"))
    # One row per language. A join with it is broadcast only while Spark finds it small.
    octets = staged(octets, "phrase-octets")
    shards = F.greatest(F.lit(LEAST_SHARDS), F.ceil(F.col("_octets") / SHARD_BYTES))
    dealt = ready.join(octets, "lang").select(
        "lang", F.pmod("_turn", shards).cast("int").alias("_shard"), "text"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, turn = TaskContext.get().partitionId() << 32, count()
        now, shard = None, None
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            texts = batch.column(2).cast(pa.binary())
            at = 0
            for key, run in groupby(keys):
                mine = texts.slice(at, len(list(run))).to_pylist()
                at += len(mine)
                if key != now:
                    if shard is not None:
                        yield shard.row()
                    now, shard = key, Shard(task + next(turn), key[0])
                for _, some in slices(mine, SLICE_BYTES):
                    shard.add(some)
        if shard is not None:
            yield shard.row()

    ordered = dealt.repartition("lang", "_shard").sortWithinPartitions("lang", "_shard")
    return ordered.mapInArrow(cut, SHARD_DDL)


class Mined:
    """A shard's codes, and for each length the phrase that begins at each place.

    A phrase of length k + 1 is a phrase of length k and the word after it; phrases of
    a length are numbered from 0, and -1 stands where none begins.
    """

    def __init__(self, words: list[str], codes: bytes):
        self.words = [None, *words]
        self.codes = unpacked(codes).astype(np.int64)
        self.width = len(self.words)

    def longer(self, at: np.ndarray, k: int) -> np.ndarray:
        """Keys of phrases of k + 1 words at every place, -1 where there is none."""
        after = np.zeros_like(self.codes)
        after[: max(len(after) - k, 0)] = self.codes[k:]
        return np.where((at >= 0) & (after > 0), at * self.width + after, -1)

    def given(self, phrases: list[str], longest: int) -> Iterator[tuple[int, np.ndarray, dict[int, str]]]:
        """Walks down the given phrases word by word: the length, the number of the
        prefix at every place, and the given phrases by their numbers."""
        codes = {w: c for c, w in enumerate(self.words) if c}
        walks = [(p, [codes.get(w, 0) for w in p.split(" ")]) for p in phrases]
        walks = [(p, path, path[0]) for p, path in walks if all(path)]
        at = np.where(self.codes > 0, self.codes, -1)
        for k in range(2, longest + 1):
            walks = [(p, path, number) for p, path, number in walks if len(path) >= k]
            keys = [number * self.width + path[k - 1] for _, path, number in walks]
            known = np.unique(np.array(keys, dtype=np.int64))
            at = numbered(self.longer(at, k - 1), known)
            numbers = np.searchsorted(known, keys).tolist()
            walks = [(p, path, number) for (p, path, _), number in zip(walks, numbers)]
            yield k, at, {number: p for p, path, number in walks if len(path) == k}


def numbered(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each key among sorted known ones, -1 for others."""
    if not len(known):
        return np.full(len(keys), -1)
    place = np.searchsorted(known, keys)
    place[place == len(known)] = 0
    return np.where(known[place] == keys, place, -1)


def frequent_in(
    held: Mined, local: int, longest: int, pairs: list[str] | None
) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """Length, phrases and counts of what occurs at least `local` times in a shard.

    Words and phrases up to `longest` words; with `pairs`, phrases of three words and
    more all of whose pairs are given.
    """
    if pairs is None:
        hits = np.bincount(held.codes, minlength=held.width)
        keep = hits >= local
        keep[0] = False
        found = np.flatnonzero(keep)
        yield 1, [held.words[w] for w in found.tolist()], hits[found]
        k, at, names = 1, np.where(keep[held.codes], held.codes, -1), held.words
    else:
        k, at, names = next(held.given(pairs, 2))
    while k < longest:
        keys = held.longer(at, k)
        # The phrase less its first word is one of the kept ones too.
        keys[:-1][at[1:] < 0] = -1
        known, hits = np.unique(keys[keys >= 0], return_counts=True)
        known, hits = known[hits >= local], hits[hits >= local]
        parts = zip(*(x.tolist() for x in np.divmod(known, held.width)))
        names = [f"{names[a]} {held.words[w]}" for a, w in parts]
        k, at = k + 1, numbered(keys, known)
        yield k, names, hits


def count_in(held: Mined, phrases: list[str], longest: int) -> Iterator[tuple[int, list[str], np.ndarray]]:
    """Length, phrases and counts of the given phrases that occur in a shard."""
    hits, wanted = np.bincount(held.codes, minlength=held.width), {p for p in phrases if " " not in p}
    single = [(w, n) for w, n in zip(held.words[1:], hits[1:].tolist()) if w in wanted]
    yield 1, [w for w, _ in single], np.array([n for _, n in single], dtype=np.int64)
    for k, at, given in held.given([p for p in phrases if " " in p], longest):
        hits = np.bincount(at[at >= 0], minlength=max(given, default=-1) + 1)
        met = [(p, int(hits[number])) for number, p in given.items() if hits[number]]
        yield k, [p for p, _ in met], np.array([n for _, n in met], dtype=np.int64)


def _per_shard(rows: DataFrame, find: Callable[[Mined, dict], Iterator]) -> DataFrame:
    """What `find` yields for each shard, as rows (shard, lang, local, k, phrase, hits)."""
    names = rows.columns
    schema = pa.schema(
        [
            ("shard", pa.int64()),
            ("lang", pa.string()),
            ("local", pa.int64()),
            ("k", pa.int32()),
            ("phrase", pa.string()),
            ("hits", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(c)[r].as_py() for c, n in enumerate(names)}
                held = Mined(row["words"], row["codes"])
                for k, phrases, hits in find(held, row):
                    n = len(phrases)
                    values = [[row[c]] * n for c in ("shard", "lang", "local")]
                    values += [[k] * n, phrases, hits]
                    yield pa.record_batch([pa.array(v, t) for v, t in zip(values, schema.types)], schema)

    return rows.mapInArrow(
        run, "shard bigint, lang string, local bigint, k int, phrase string, hits bigint"
    )


class Miner:
    """The shards of a corpus with their local supports."""

    def __init__(self, docs: DataFrame, support: int, longest: int):
        self.support, self.longest = support, longest
        shards = staged(make_shards(docs), "phrase-shards", compression="zstd")
        # The share of the support, rounded up; a shard without words has none of it.
        local = F.greatest(F.expr(f"({support} * n + total - 1) div total"), F.lit(1)).alias("local")
        totals = shards.groupBy("lang").agg(F.sum("n").alias("total")).where("total > 0")
        hidden = F.sum(F.col("local") - 1).alias("hidden")
        sizes = shards.select("lang", "shard", "n").join(totals, "lang").select("*", local)
        # One row per language. A join with it is broadcast only while Spark finds it small.
        self.totals = staged(sizes.groupBy("lang", "total").agg(hidden), "phrase-totals")
        self.shards = shards.join(self.totals.select("lang", "total"), "lang").select(
            "shard", "lang", "words", "codes", local
        )
        # At most `support` shards of a language have more than a hundredth of it.
        self.wide = staged(sizes.where("local > 1").select("shard", "lang"), "phrase-wide")

    def short(self) -> DataFrame:
        """Words and pairs that are frequent in a shard."""
        return _per_shard(self.shards, lambda held, row: frequent_in(held, row["local"], 2, None))

    def long(self, short: DataFrame, pairs: DataFrame) -> DataFrame:
        """Longer phrases that are frequent in a shard, of pairs that are so in the language."""
        longest = self.longest
        met = short.where("local = 1 and k = 2").join(pairs, ["lang", "phrase"], "left_semi")
        sent = met.select("shard", "phrase").unionByName(self._sent(pairs))
        rows = self.shards.join(_lists(sent), "shard")
        return _per_shard(
            rows, lambda held, row: frequent_in(held, row["local"], longest, row["phrases"])
        )

    def _sent(self, phrases: DataFrame) -> DataFrame:
        return phrases.select("lang", "phrase").join(self.wide, "lang").select("shard", "phrase")

    def exact(self, found: DataFrame) -> DataFrame:
        """(lang, k, phrase, f) of the found phrases that reach the support."""
        sums = found.groupBy("lang", "k", "phrase").agg(
            F.sum("hits").alias("f"),
            F.sum(F.col("local") - 1).alias("_shown"),
            F.coalesce(F.sum(F.when(F.col("local") == 1, F.col("hits"))), F.lit(0)).alias("_sure"),
        )
        sums = sums.join(self.totals.select("lang", "hidden"), "lang")
        sums = staged(sums.where(F.expr(f"f + hidden - _shown >= {self.support}")), "phrase-candidates")
        unsure = sums.where("hidden > _shown")
        longest = self.longest
        rows = self.shards.where("local > 1").join(_lists(self._sent(unsure)), "shard")
        counted = _per_shard(rows, lambda held, row: count_in(held, row["phrases"], longest))
        counted = counted.groupBy("lang", "phrase").agg(F.sum("hits").alias("_counted"))
        again = unsure.join(counted, ["lang", "phrase"], "left").withColumn(
            "f", F.col("_sure") + F.coalesce("_counted", F.lit(0))
        )
        columns = ["lang", "k", "phrase", "f"]
        both = sums.where("hidden = _shown").select(*columns).unionByName(again.select(*columns))
        return both.where(F.col("f") >= self.support)


def _lists(sent: DataFrame) -> DataFrame:
    """The phrases sent to each shard; a shard is bounded, so is what can occur in it, and
    candidates go unasked only to shards with over a hundredth of their language."""
    return sent.groupBy("shard").agg(F.collect_list("phrase").alias("phrases"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f) of all words and phrases up to `longest` words with f >= support,
    and (lang, n), the words of each language."""
    miner = Miner(docs, support, longest)
    short = staged(miner.short(), "phrases-short")
    known = staged(miner.exact(short), "phrases-known")
    more = miner.exact(staged(miner.long(short, known.where("k = 2")), "phrases-long"))
    every = staged(known.unionByName(more), "phrases-frequent")
    return every, miner.totals.select("lang", F.col("total").alias("n"))


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _absorbed(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the greatest count of a longer phrase around a phrase."""
    words = F.split("phrase", " ")
    parts = phrases.where("k > 2").select(
        "lang", "k", "f", words.alias("_w"), F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("_m")
    )
    parts = parts.select(
        "lang", "f", "_w", "_m", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("_m") + 1)).alias("_s")
    )
    return (
        parts.select("lang", _joined(F.col("_w"), F.col("_s"), F.col("_m")).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )


def collocations(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, first: int = 2000
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    The score of a cut is floor(1000 * a * n / (l * r)) in whole numbers of 38 digits; a
    phrase has its lowest-scoring cut, the earliest of equal ones. Phrases that stand
    in a longer one as often as by themselves are left out.
    """
    every, sizes = frequent_phrases(docs, support, longest)
    phrases = every.where("k > 1")
    words, cut = F.split("phrase", " "), F.col("cut")
    cuts = phrases.select(
        "lang", "phrase", F.col("f").alias("a"), "k", words.alias("_w"),
        F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"),
    ).select(
        "lang", "phrase", "a", "cut",
        _joined(F.col("_w"), F.lit(1), cut).alias("_first"),
        _joined(F.col("_w"), cut + 1, F.col("k") - cut).alias("_rest"),
    )

    def part(column: str, name: str) -> DataFrame:
        return every.select("lang", F.col("phrase").alias(column), F.col("f").alias(name))

    big = "cast({} as decimal(19, 0))".format
    score = f"({big('a * 1000')} * {big('n')}) div ({big('l')} * {big('r')})"
    scored = (
        cuts.join(part("_first", "l"), ["lang", "_first"])
        .join(part("_rest", "r"), ["lang", "_rest"])
        .join(sizes, "lang")
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct(F.expr(score).alias("score"), "cut", "l", "r")).alias("_best"))
        .select("lang", "phrase", "a", "n", "_best.score", "_best.l", "_best.r")
    )
    kept = scored.join(_absorbed(phrases), ["lang", "phrase"], "left").where(
        "longer is null or longer < a"
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
