"""One query per operator over its whole table, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from .common import reach
from .licences import scan_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


# Integer inner products of every fiftieth row with all rows, exact as they stay below 2**53.
NEGATIVES_SQL = """
WITH sound AS (
  SELECT DISTINCT vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
         list_dot_product(a.v, c.v)::BIGINT AS score
  FROM sound a JOIN sound c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 50 = 0
), near AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT n.anchor_id, n.positive_id,
       CAST(row_number() OVER best AS INTEGER) AS rank,
       s.other AS negative_id, n.positive_score, s.score AS negative_score
FROM near n JOIN scored s ON s.anchor_id = n.anchor_id AND NOT s.same
 AND 50 * n.positive_score <= 100 * s.score AND 100 * s.score <= 95 * n.positive_score
WINDOW best AS (PARTITION BY n.anchor_id, n.positive_id ORDER BY s.score DESC, s.other)
QUALIFY row_number() OVER best <= 3
"""


# Every phrase counted in one statement; letters beyond A-Z keep their case.
PHRASES_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM starts, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)
), sizes AS (
  SELECT lang, count(*) AS n FROM starts GROUP BY lang
), freq AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), cand AS (
  SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM freq WHERE k > 1
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, j AS cut, s.n,
         array_to_string(w[1:j], ' ') AS first_part, array_to_string(w[j + 1:], ' ') AS rest
  FROM cand c, (SELECT unnest(range(1, 5)) AS j), sizes s WHERE j < k AND s.lang = c.lang
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.n, x.f AS l, y.f AS r,
         (1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN freq x ON x.lang = c.lang AND x.phrase = c.first_part
  JOIN freq y ON y.lang = c.lang AND y.phrase = c.rest
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, cut) = 1
), around AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(f) AS longer
  FROM cand, (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS s)
  WHERE m < k AND s + m - 1 <= k GROUP BY ALL
)
SELECT s.lang, row_number() OVER best AS rank, s.phrase, s.a, s.l, s.r, s.n, s.score::BIGINT AS score
FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
WHERE o.longer IS NULL OR o.longer < s.a
WINDOW best AS (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase)
QUALIFY row_number() OVER best <= 2000
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reach(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, read back from the files they were written to."""
    from .common import staged
    from .token_files import document_ids, encode_chunks

    name = "word_bpe_49k.json"
    chunks = encode_chunks(
        table(spark, sf_dir, "documents"), name, tokenizer_path(name), end_id=1
    )
    return document_ids(staged(chunks, "token-files", compression="none"))


@query("op9_mix_sources")
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    from .mixing import mixed_words

    return mixed_words(table(spark, sf_dir, "documents")).drop("source")


@query("op7_pack_best_fit")
def op7_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    from .packing import pack_documents

    name = "byte_bpe_50k.json"
    return pack_documents(table(spark, sf_dir, "documents"), name, tokenizer_path(name), end_id=0)


@query("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    from .language import fit, predict

    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))


@query("op5_minhash")
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of every document by shingles of three words."""
    from .minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


@query("op2_near_vectors")
def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of embeddings with a cosine of at least 0.9, as links per vector and classes."""
    from .vectors import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), 0.9)


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    from .fingerprints import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


@query("op4_secrets")
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    from .secrets import secret_report

    return secret_report(table(spark, sf_dir, "documents"))


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat an earlier one, exactly or nearly."""
    from .lines import line_report

    return line_report(table(spark, sf_dir, "documents"))


@query("op1_licences", scan_sql())
def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document, as a whole and of its lines."""
    from .licences import scan_licences

    return scan_licences(table(spark, sf_dir, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    return corpus_pipeline.run(spark, sf_dir)


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding, some labels changed first."""
    from pyspark.sql import functions as F

    from .negatives import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)


@query("op12_word_table")
def op12_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document through a table of distinct words, and the text they decode to."""
    from .word_table import codec

    return codec(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op13_phrases", PHRASES_SQL)
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of each language of the documents."""
    from .phrases import collocations

    return collocations(table(spark, sf_dir, "documents"))
