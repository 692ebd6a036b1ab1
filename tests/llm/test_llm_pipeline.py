"""The pipeline against a plain version of its stages, and the registered queries."""

import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from tallyward.llm.common import ARROW_BYTES, BATCH_BYTES, small_batches
from tallyward.llm.language import scored
from tallyward.llm.mixing import mixed_words
from tallyward.llm.tokens import encoder

from .test_llm_basics import joined, shingles, words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
public_tokenizers = pytest.importorskip("public_tokenizers")


def corpus():
    """Two languages, shared lines, copies, near copies, texts without letters."""
    rng = np.random.default_rng(12)
    texts = []
    for k in range(90):
        letters = list("abcdefgh") if k % 2 else list("stuvwxyz")

        def line(n):
            return " ".join("".join(rng.choice(letters, int(rng.integers(3, 9)))) for _ in range(n))

        body = [line(int(rng.integers(8, 30))) for _ in range(int(rng.integers(1, 6)))]
        if k % 5 == 0:
            body.insert(0, "abc shared head line of many" if k % 2 else "xyz shared head line stuv")
        texts.append((("aa", "zz")[k % 2 == 0], "\n".join(body)))
        if k % 9 == 0:
            texts.append((texts[-1][0], texts[-1][1]))
        if k % 11 == 0:
            # One line with every fourth word anew: no near line, but shingles in common.
            texts.append((texts[-1][0], texts[-1][1].replace("\n", " ") + " " + line(2)))
    rows = [(k, t, lang, f"src{k % 3}", len(t)) for k, (lang, t) in enumerate(texts)]
    rows += [(900, None, None, "src0", None), (901, "12 -- 34", "aa", None, 8), (902, "", "aa", "src1", 0)]
    return rows


def without_letters(rows):
    return [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]


def without_repeats(rows):
    marks = re.compile("[" + re.escape(string.punctuation) + r"\s]+")
    seen, out = set(), []
    for doc_id, text, lang, source, _ in rows:
        kept = []
        for line in text.split("\n"):
            plain = marks.sub(" ", line.lower()).strip()
            if not plain or plain not in seen:
                kept.append(line)
            seen.add(plain)
        if kept:
            text = "\n".join(kept)
            out.append((doc_id, text, lang, source, len(text)))
    return out


def without_near(rows):
    sets = {r[0]: shingles(r[1], 5) for r in rows}
    keys = sorted(sets)
    edges = [
        (a, b)
        for i, a in enumerate(keys)
        for b in keys[:i]
        if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    group = joined(keys, edges)
    return [r for r in rows if group[r[0]] == r[0]]


def pieces(rows):
    from tokenizers import Tokenizer

    name = corpus_pipeline.TOKENIZER
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    out = []
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [corpus_pipeline.END_ID]
        ends = [len(ids) % 2048 or 2048] if len(ids) > 2048 else [len(ids)]
        while ends[-1] < len(ids):
            ends.append(ends[-1] + 2048)
        for piece, (low, high) in enumerate(zip([0, *ends], ends)):
            crc = zlib.crc32(np.array(ids[low:high], "<u4").tobytes())
            out.append((doc_id, piece, low, high - low, crc))
    return sorted(out)


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    docs, stages = spark.read.parquet(str(tmp_path / "documents.parquet")), dict(corpus_pipeline.STAGES)
    want = rows
    plain = {"language": without_letters, "line dedup": without_repeats, "near dedup": without_near}
    for name, force in plain.items():
        docs, before = stages[name](spark, docs, str(tmp_path)), len(want)
        want = force(want)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(map(tuple, docs.collect())) == want
        assert len(want) < before
    taken = {r["doc_id"]: r for r in mixed_words(docs).collect()}
    mixed = [tuple(r) for r in stages["mix"](spark, docs, str(tmp_path)).collect()]
    often = {r[0]: mixed.count(r) for r in want}
    assert set(mixed) <= set(want) and sum(often.values()) == len(mixed)
    for row in want:
        share = taken[row[0]]["taken"] / len(words(row[1]))
        assert int(share) <= often[row[0]] <= int(share) + 1
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    found = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    assert found == pieces(mixed)
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_take_nulls_and_repeated_rows(spark, tmp_path):
    rows = [(1, "some words here to read", "en", "s", None)] * 2 + [(None, None, None, None, None)]
    rows += [(2, "other words there to write", None, None, 26)]
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(rows, DOCS)
        assert stage(spark, docs, str(tmp_path)).count() >= 1


def test_near_stage_decides_by_row(spark, tmp_path):
    """Rows that share a doc_id, or have none, are rows of their own."""
    a, b, c, d = ("one two three four five six", "quite other words stand in here now", "a third text with words of its own", "and the last one of these short texts")
    rows = [(5, a), (7, a), (7, b), (None, a), (None, c), (1, d), (1, d), (None, None), (2, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", None) for k, t in rows], DOCS)
    got = dict(corpus_pipeline.STAGES)["near dedup"](spark, docs, str(tmp_path))
    want = [(5, a), (7, b), (None, c), (1, d), (None, None), (2, "")]
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_mix_stage_takes_rows_without_an_id(spark, tmp_path):
    rows = [(None, "a b c"), (None, "d e"), (7, "x y"), (7, "z"), (8, "u v w")]
    docs = spark.createDataFrame([(k, t, "en", "s", None) for k, t in rows], DOCS)
    got = dict(corpus_pipeline.STAGES)["mix"](spark, docs, str(tmp_path))
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(rows, key=repr)


def test_every_operator_has_its_query():
    names = entry_module.queries()
    for number in range(1, 14):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None


def test_licence_query_matches_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    sf = "/root/testdata/sf0.01"
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    df = entry_module.queries()["op1_licences"](spark, sf)
    want = con.execute(entry_module.oracle_sql()["op1_licences"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)
    assert df.where(F.col("n_licence_lines") > 0).count() > 10


def test_language_stage_drops_what_was_not_learned(spark, tmp_path):
    """A planted unlearned language and letter noise go, texts of learned languages stay."""
    rng = np.random.default_rng(4)

    def text(parts, n):
        return " ".join("".join(rng.choice(parts, int(rng.integers(1, 4)))) for _ in range(n))

    learned = {"aa": ["the", "ing", "an", "er", "st"], "bb": ["eau", "que", "oi", "ré", "le"]}
    rows = [
        (100 * k + j, text(parts, 20 + 2 * j), lang, "s", None)
        for k, (lang, parts) in enumerate(learned.items())
        for j in range(60)
    ]
    letters = list("abcdefghijklmnopqrstuvwxyz")
    other = [(1000 + j, text(["ква", "жду", "шо", "мы"], 20 + 6 * j), None, "s", None) for j in range(20)]
    noise = [
        (2000 + j, " ".join("".join(rng.choice(letters, 6)) for _ in range(20 + 6 * j)), None, "s", None)
        for j in range(20)
    ]
    docs = spark.createDataFrame(rows + other + noise, DOCS)
    stage = dict(corpus_pipeline.STAGES)["language"]
    assert sorted(map(tuple, stage(spark, docs, str(tmp_path)).collect())) == rows


def test_language_stage_frees_what_packing_remembers():
    """Workers outlive a stage; the words known to one that packed are not held while languages are told."""
    encoder(corpus_pipeline.TOKENIZER, public_tokenizers.path(corpus_pipeline.TOKENIZER)).encode([b"some words"])
    scored(None, pa.array(["some words"]), np.ones(1, dtype=bool))
    assert encoder.cache_info().currsize == 0


def test_workers_get_a_few_megabytes_of_text_at_a_time(spark, tmp_path):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["size"])

    before = spark.conf.get(ARROW_BYTES)
    docs = spark.createDataFrame([(1, "some words here to read", "en", "s", None)], DOCS)
    texts = spark.range(0, 8000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text"))
    try:
        for name in ("language", "pack"):
            spark.conf.set(ARROW_BYTES, before)
            dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
            got = [r["size"] for r in texts.mapInArrow(sizes, "size long").collect()]
            assert sum(got) >= 16_000_000 and max(got) <= BATCH_BYTES + 100_000
        spark.conf.set(ARROW_BYTES, "1000")
        small_batches(spark)
        assert spark.conf.get(ARROW_BYTES) == "1000"
    finally:
        spark.conf.set(ARROW_BYTES, before)
