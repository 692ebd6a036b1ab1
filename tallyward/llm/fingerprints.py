"""Document fingerprints by consistent weighted sampling.

A text is a bag of lower-case words weighted by how often they occur. For every
sample, a word's hash seeds r and c from Gamma(2, 1) and b from the unit interval;
its weight w gives t = floor(ln w / r + b) and a = c / exp(r (t - b + 1)), and the
word of least a is drawn together with its t. Two bags draw the same pair with a
probability that is their generalised Jaccard similarity, the sum of lesser weights
over the sum of greater ones; a fingerprint is 32 draws, 8 hexadecimal digits each.

Texts are shuffled once, by ranges of doc_id. A range also gets the first document
of the next one, so every document meets its successor, and all further steps stay
within their range. NULL counts as empty. Texts without words have the empty
fingerprint, which is like itself (1) and unlike any other (0). Equal doc_ids follow
each other in text order, NULL comes first; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 32
# Ranges of doc_id per shuffle partition.
RANGES = 4
LOWEST = -(1 << 63)
LOW = 0xFFFFFFFF


def _cuts(docs: DataFrame, number: int) -> list[int]:
    """Cut points of doc_id into about `number` equal ranges; any would do."""
    shares = [k / number for k in range(1, number)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * number)).first()[0]
    return sorted(set(found or []))


def _range_of(key: Column, cuts: list[int]) -> Column:
    """How many cut points are below key, found among every k-th, then among k."""
    if not cuts:
        return F.lit(0)
    k = math.isqrt(len(cuts)) + 1
    coarse = F.array(*[F.lit(c).cast("bigint") for c in cuts[k - 1 :: k]])
    every = F.array(*[F.lit(c).cast("bigint") for c in cuts])
    if len(cuts) < k:
        coarse = F.array().cast("array<bigint>")
    full = F.size(F.filter(coarse, lambda c: c < key))
    rest = F.filter(F.slice(every, full * k + 1, k), lambda c: c < key)
    return full * k + F.size(rest)


def with_next(docs: DataFrame) -> DataFrame:
    """_range, _no, doc_id, text, next_text, _ghost; by doc_id, the first after the last.

    Ghosts are the documents that only stand at the end of a range, as successors.
    """
    spark = docs.sparkSession
    number = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _cuts(docs, number)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LOWEST))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        key.alias("_key"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("_range", _range_of(F.col("_key"), cuts))
    firsts = rows.groupBy("_range").agg(F.min("_key").alias("_first"))
    order = Window.orderBy("_range")
    # One row per range: the range before it, the last one before the first.
    firsts = firsts.select(
        "_range",
        "_first",
        F.coalesce(
            F.lag("_range").over(order), F.max("_range").over(Window.partitionBy())
        ).alias("_before"),
    )
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("ghost"))
    other = F.struct(F.col("_before").alias("range"), F.lit(True).alias("ghost"))
    dealt = rows.join(F.broadcast(firsts), "_range").withColumn(
        "_to", F.explode(F.when(F.col("_key") == F.col("_first"), F.array(own, other)).otherwise(F.array(own)))
    )
    dealt = dealt.select(
        F.col("_to.range").alias("_range"), F.col("_to.ghost").alias("_ghost"), "_key", "doc_id", "text"
    )
    within = Window.partitionBy("_range").orderBy("_ghost", "_key", "text")
    return dealt.withColumns(
        {"_no": F.row_number().over(within), "next_text": F.lead("text").over(within)}
    )


def edited_text(text: Column, next_text: Column) -> Column:
    """text with its last floor(n / 2) characters replaced by the next text's first."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))


def weighted_terms(text: Column) -> Column:
    """Array of (term: hash of a lower-case word, n: how often it occurs)."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))

    def runs(s: Column) -> Column:
        # The last place of every run of equal hashes.
        ends = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i + 1)),
        )
        return F.transform(
            F.array(ends),
            lambda e: F.transform(
                e,
                lambda at, k: F.struct(
                    F.get(s, at).alias("term"),
                    (at - F.coalesce(F.get(e, k - 1), F.lit(-1))).cast("double").alias("n"),
                ),
            ),
        )[0]

    empty = F.array().cast("array<struct<term:bigint,n:double>>")
    # A lambda binds the sorted hashes once.
    return F.transform(
        F.array(hashes), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(empty)
    )[0]


def drawn(term: Column, weight: Column, k: int) -> Column:
    """One word's entry for sample k: ordered by a, low 32 bits stand for (word, t)."""

    def unit(bits: Column, shift: int, width: int) -> Column:
        part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
        return (part.cast("double") + 0.5) / float(1 << width)

    one, two = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.ln(unit(one, 0, 24) * unit(one, 24, 24))
    log_c = F.ln(-F.ln(unit(two, 0, 24) * unit(two, 24, 24)))
    b = unit(one, 48, 16)
    t = F.floor(F.ln(weight) / r + b)
    log_a = log_c - r * (t - b + 1)
    rank = F.greatest(F.lit(0.0), F.least(F.lit(2.0**31 - 1), (log_a + 96.0) * 2.0**23))
    who = F.xxhash64(term, t, F.lit(k)).bitwiseAND(F.lit(LOW))
    return F.shiftleft(rank.cast("bigint"), 32).bitwiseOR(who)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; two empty fingerprints are alike."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda e: e))
    return same / F.lit(float(SAMPLES))


def as_text(samples: Column) -> Column:
    return F.array_join(
        F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), ""
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_next(docs).withColumn(
        "_edited", F.when(~F.col("_ghost"), edited_text(F.col("text"), F.col("next_text")))
    )
    kept = ["_range", "_no", "_ghost", "doc_id", "n_chars", "edited_sha256"]

    def entry(which: int, text: str) -> Column:
        return F.struct(
            F.lit(which).alias("which"), weighted_terms(F.col(text)).alias("terms")
        )

    both = F.when(F.col("_ghost"), F.array(entry(0, "text"))).otherwise(
        F.array(entry(0, "text"), entry(1, "_edited"))
    )
    terms = (
        rows.select(
            "_range",
            "_no",
            "_ghost",
            "doc_id",
            F.char_length("text").cast("bigint").alias("n_chars"),
            F.sha2(F.coalesce("_edited", F.lit("")), 256).alias("edited_sha256"),
            F.explode(both).alias("_bag"),
        )
        .select(*kept, F.col("_bag.which").alias("_which"), F.explode_outer("_bag.terms").alias("_t"))
        .select(*kept, "_which", F.col("_t.term").alias("_term"), F.col("_t.n").alias("_n"))
    )
    # A bag without words has one row without a term. That is looked at once per bag: under
    # a condition per draw Spark would compute what a draw uses several times over again.
    least = [F.min(drawn(F.col("_term"), F.col("_n"), k)).alias(f"_m{k}") for k in range(SAMPLES)]
    there = F.count("_term").alias("_there")
    samples = F.array(
        *[F.when(F.col("_there") > 0, F.col(f"_m{k}").bitwiseAND(F.lit(LOW))) for k in range(SAMPLES)]
    )
    drawn_rows = terms.groupBy(*kept, "_which").agg(there, *least).select(
        *kept, "_which", samples.alias("_own")
    )
    # A document's row is followed by its edited text's, then by the next document's.
    within = Window.partitionBy("_range").orderBy("_no", "_which")
    found = drawn_rows.withColumns(
        {"_edit": F.lead("_own", 1).over(within), "_next": F.lead("_own", 2).over(within)}
    ).where("_which = 0 and not _ghost")
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_edit")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edit")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )
