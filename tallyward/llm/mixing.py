"""Mix sources to target weights by whole blocks of tokens.

The words of a source, document after document, are one stream that is cut into
blocks of a fixed number of words. Target words per source give each source a
number of output slots; a pseudorandom permutation spreads all slots over output
shards of a fixed size, so a shard's source counts are multinomial draws without
replacement from the slots: every shard is full and every total is met. Slot k of
a source takes, in round k / blocks, the block at k % blocks under a permutation
of that source and round, and blocks are joined by (source, index). In a round a
block comes up at most once, so nothing repeats more often than there are rounds.

Sizes of NULL and wordless texts are 0 and nothing of them is taken. Repeated
rows are rows of their own; other columns are ignored. A NULL source is a source
like any other, last in order. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, permuted, staged, word_count

WEIGHTS = (1, 2, 3)
MAX_ROUNDS = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
# A plan of up to so many sources, some sixty bytes each, is broadcast.
SMALL_PLAN = 50_000
# Documents of a source are run up in groups of about this many.
GROUP_ROWS = 4096
# Slots of a source are made in pieces of this many.
PIECE_SLOTS = 8192


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """Per source: source_no (by code point, NULL last), source_size, n_rows, target.

    Sources share all words by weight. A target stops at max_rounds times its
    source's size and the excess is shared again by weight among the others, until
    none is above. This is the water level: with sources in order of limit per
    weight, the first one whose share of what the earlier ones leave is within
    its limit sets the level. Sources, one row each, are put in order in one task.
    """
    per = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("source_no", F.row_number().over(by_name).cast("bigint"))
    per = per.withColumns(
        {
            "_w": F.get(given, ((F.col("source_no") - 1) % len(weights)).cast("int")),
            "_cap": F.col("source_size").cast("double") * max_rounds,
        }
    ).withColumn("_per", F.col("_cap") / F.col("_w"))
    up = Window.orderBy("_per", "source_no")
    everything = Window.partitionBy()
    per = per.withColumns(
        {
            "_all": F.sum("source_size").over(everything).cast("double"),
            "_full": F.coalesce(
                F.sum("_cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
            ),
            "_rest": F.sum("_w").over(up.rowsBetween(0, Window.unboundedFollowing)),
        }
    ).withColumn("_level", (F.col("_all") - F.col("_full")) / F.col("_rest"))
    fits = F.when(F.col("_level") <= F.col("_per"), F.struct("_per", "source_no", "_level"))
    level = F.min(fits).over(everything).getField("_level")
    return per.select(
        "source",
        "source_no",
        "source_size",
        "n_rows",
        F.least("_cap", level * F.col("_w")).alias("target"),
    )


def place_documents(sizes: DataFrame, targets: DataFrame, small: bool) -> DataFrame:
    """Give each row its first word's place in its source's stream: column `start`.

    `small`: the targets may be broadcast. Rows are grouped by a hash of doc_id, group sums are run up per source, and
    rows within their group, so a source with any share of all rows is spread.
    """
    groups = F.greatest(_long(1), F.ceil(F.col("n_rows") / GROUP_ROWS).cast("bigint"))
    plan = targets.select(F.col("source").alias("_source"), "source_no", "n_rows")
    plan = F.broadcast(plan) if small else plan
    placed = sizes.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id",
        "size",
        "source_no",
        F.pmod(F.xxhash64("doc_id"), groups).alias("_group"),
    )
    none, before = _long(0), (Window.unboundedPreceding, -1)
    sums = placed.groupBy("source_no", "_group").agg(F.sum("size").alias("_n"))
    run = Window.partitionBy("source_no").orderBy("_group").rowsBetween(*before)
    sums = sums.select(
        "source_no", "_group", F.coalesce(F.sum("_n").over(run), none).alias("_first")
    )
    inside = (
        Window.partitionBy("source_no", "_group").orderBy("doc_id", "size").rowsBetween(*before)
    )
    return (
        placed.withColumn("_in", F.coalesce(F.sum("size").over(inside), none))
        .join(sums, ["source_no", "_group"])
        .select("doc_id", "source_no", "size", (F.col("_first") + F.col("_in")).alias("start"))
    )


def draw_slots(
    targets: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    max_rounds: int = MAX_ROUNDS,
    seed: int = 0,
) -> DataFrame:
    """The output: shard, place in it, source_no and the block that stands there.

    A source's slots are as many whole rounds as its target holds, and of the next
    round as many blocks as come nearest to the rest.
    """
    size, target = F.col("source_size"), F.col("target")
    per = targets.where("source_size > 0").withColumns(
        {
            "_blocks": F.ceil(size / block_words).cast("bigint"),
            "_rounds": F.least(F.floor(target / size).cast("bigint"), _long(max_rounds)),
        }
    )
    rest = F.round((target - F.col("_rounds") * size) * F.col("_blocks") / size).cast("bigint")
    rest = F.when(F.col("_rounds") < max_rounds, F.least(F.greatest(rest, _long(0)), "_blocks"))
    per = per.withColumn(
        "_slots", F.col("_rounds") * F.col("_blocks") + F.coalesce(rest, _long(0))
    )
    ahead = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "source_no",
        "_blocks",
        "_slots",
        F.coalesce(F.sum("_slots").over(ahead), _long(0)).alias("_ahead"),
        F.sum("_slots").over(Window.partitionBy()).alias("_total"),
    ).where("_slots > 0")
    # Rows are few and small here but grow PIECE_SLOTS-fold, so they are not merged.
    tasks = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = per.withColumn(
        "_piece", F.explode(F.sequence(_long(0), F.floor((F.col("_slots") - 1) / PIECE_SLOTS).cast("bigint")))
    ).repartition(tasks, "source_no", "_piece")
    first = F.col("_piece") * PIECE_SLOTS
    slots = pieces.withColumn(
        "_k", F.explode(F.sequence(first, F.least(first + PIECE_SLOTS, F.col("_slots")) - 1))
    )
    place = permuted(F.col("_ahead") + F.col("_k"), F.col("_total"), _long(seed))
    turn = F.floor(F.col("_k") / F.col("_blocks")).cast("bigint")
    key = F.xxhash64(_long(seed), "source_no", turn)
    return slots.select(
        place.alias("_at"),
        "source_no",
        permuted(F.col("_k") % F.col("_blocks"), F.col("_blocks"), key).alias("block"),
    ).select(
        F.floor(F.col("_at") / shard_slots).cast("bigint").alias("shard"),
        (F.col("_at") % shard_slots).alias("place"),
        "source_no",
        "block",
    )


def mixed_words(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    block_words: int = BLOCK_WORDS,
    max_rounds: int = MAX_ROUNDS,
    seed: int = 0,
) -> DataFrame:
    """Per row of docs: doc_id, size, source_size, target, taken (words, repeats counted)."""
    sizes = staged(
        docs.select("doc_id", "source", word_count("text").alias("size")), "sizes"
    )
    # One row per source, made once for all that read it.
    targets = cut(source_targets(sizes, weights, max_rounds))
    small = targets.count() <= SMALL_PLAN
    placed = place_documents(sizes, targets, small)
    drawn = draw_slots(targets, block_words, SHARD_SLOTS, max_rounds, seed)
    times = drawn.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("_times"))
    end = F.col("start") + F.col("size")
    held = placed.where("size > 0").withColumn(
        "block",
        F.explode(
            F.sequence(
                F.floor(F.col("start") / block_words).cast("bigint"),
                F.floor((end - 1) / block_words).cast("bigint"),
            )
        ),
    )
    low = F.col("block") * block_words
    held = held.withColumn(
        "_words", F.least(end, low + block_words) - F.greatest(F.col("start"), low)
    )
    taken = (
        held.join(times.hint("merge"), ["source_no", "block"])
        .groupBy("source_no", "start")
        .agg(F.sum(F.col("_words") * F.col("_times")).alias("taken"))
    )
    # Spark takes the slots for as few as the sources they are made from and would
    # broadcast them; they are as many as the blocks.
    # Rows without words share their start with another row but take nothing.
    found = placed.where("size > 0").join(taken.hint("merge"), ["source_no", "start"], "left")
    found = found.select("doc_id", "source_no", "size", F.coalesce("taken", _long(0)).alias("taken"))
    rest = placed.where("size = 0").select("doc_id", "source_no", "size", _long(0).alias("taken"))
    plan = targets.select("source_no", "source", "source_size", "target")
    plan = F.broadcast(plan) if small else plan
    return found.unionByName(rest).join(plan, "source_no").select(
        "doc_id", "source", "size", "source_size", "target", "taken"
    )
