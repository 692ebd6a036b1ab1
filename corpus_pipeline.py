"""A corpus pipeline of five stages, each by one operator of tallyward.llm.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of
documents; the last returns the packed pieces. A stage's rows are written as Parquet
and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import reach, small_batches, staged
from tallyward.llm.language import fit, in_known_language
from tallyward.llm.lines import without_repeats
from tallyward.llm.minhash import near_duplicates
from tallyward.llm.mixing import mixed_words
from tallyward.llm.packing import pack_documents

TOKENIZER, END_ID = "byte_bpe_50k.json", 0


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text, without letters, or in no language learned go."""
    reach(spark)
    small_batches(spark)
    return in_known_language(docs, fit(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier in the corpus go, and documents that consist of such."""
    return without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their five-word shingles one stays.

    It is the one with the smallest doc_id, one without an id only among its like. Every
    row counts by itself, whether it shares its doc_id with others or has none.
    """
    reach(spark)
    rows = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "near-rows")
    found = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), width=5, percent=80)
    groups = found.where("not kept").select("component_id").distinct()
    members = found.join(groups, "component_id").select(F.col("doc_id").alias("__row"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    ranked = members.join(rows.select("__row", "doc_id"), "__row").select("component_id", order.alias("_order"))
    first = ranked.groupBy("component_id").agg(F.min("_order")["__row"].alias("_first"))
    gone = members.join(first, "component_id").where("__row <> _first").select("__row")
    return rows.join(gone, "__row", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words.

    A document of which the mix takes 1.4 times the words comes once, and with a
    chance of 0.4 by its own hash, twice. Rows that share a doc_id, or have none, count
    as one document whose words the mix takes in common.
    """
    mix = mixed_words(docs).groupBy("doc_id").agg(
        F.sum("taken").alias("_taken"), F.sum("size").alias("_size")
    )
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    times = F.floor(F.col("_taken") / F.col("_size") + chance).cast("int")
    often = mix.where("_size > 0").select(F.col("doc_id").alias("_doc"), times.alias("_times"))
    again = F.explode(F.array_repeat(F.lit(0), F.col("_times")))
    kept = docs.join(often.where("_times > 0"), docs["doc_id"].eqNullSafe(F.col("_doc")))
    return kept.withColumn("_again", again).select(*[docs[c] for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    import public_tokenizers

    reach(spark)
    small_batches(spark)
    return pack_documents(docs, TOKENIZER, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [
    ("language", keep_known_languages),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack),
]

# Connected groups and learned languages are beyond one SQL statement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = staged(docs, f"stage-{number}")
    return docs
