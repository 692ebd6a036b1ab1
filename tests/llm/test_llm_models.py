"""Vectors, MinHash, language, mixing, packing and token files against brute force."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import minhash, mixing, vectors
from tallyward.llm.language import fit, predict
from tallyward.llm.minhash import near_duplicates
from tallyward.llm.mixing import draw_slots, mixed_words, source_targets
from tallyward.llm.packing import best_fit, pack_documents, pack_histogram
from tallyward.llm.token_files import document_ids, encode_chunks, ids_of, pack_blocks, planes_of, unpack_blocks
from tallyward.llm.tokens import SPLITS, Encoder
from tallyward.llm.vectors import near_vectors

from .test_llm_basics import joined, shingles, words

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
public_tokenizers = pytest.importorskip("public_tokenizers")


def table(spark, texts, lang="en"):
    rows = [(k, t, lang, f"s{k % 4}" if k % 9 else None, len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def near_copies(groups, copies, seed):
    rng = np.random.default_rng(seed)
    texts = []
    for g in range(groups):
        base = [f"w{int(x)}" for x in rng.integers(0, 900, int(rng.integers(1, 160)))]
        for _ in range(copies):
            mine = list(base)
            for _ in range(int(rng.integers(0, 6))):
                mine[int(rng.integers(len(mine)))] = f"v{int(rng.integers(1e6))}"
            texts.append(" ".join(mine))
    order = rng.permutation(len(texts))
    return [texts[k] for k in order] + [None, "", " \n", "One two", "one TWO", "one two three"]


def check_near(spark, texts, width, percent):
    sets = [shingles(t, width) for t in texts]
    edges = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = joined(range(len(texts)), edges)
    rows = near_duplicates(table(spark, texts), width, percent).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["component_id"] == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert len(set(want.values())) < len(texts) - 20


def test_minhash(spark):
    check_near(spark, near_copies(30, 8, 1), 3, 85)
    check_near(spark, near_copies(30, 8, 2), 5, 80)


def test_minhash_in_chunks(spark, monkeypatch):
    for name in ("BAND_ROWS", "CLUSTER_ROWS"):
        monkeypatch.setattr(minhash, name, 3)
    check_near(spark, near_copies(6, 30, 3), 3, 85)


def check_vectors(spark, rows, threshold=0.9):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r["vec_id"]: r for r in near_vectors(df, threshold).collect()}
    assert len(got) == len(rows)
    sound = {}
    for key, x, _ in rows:
        if x and all(v is not None and np.isfinite(v) for v in x) and any(x):
            y = np.array(x, dtype=np.float32).astype(float)
            sound[key] = y / np.linalg.norm(y)
    links = {key: 0 for key, _, _ in rows}
    edges = []
    for a in sound:
        for b in sound:
            if a < b and len(sound[a]) == len(sound[b]) and sound[a] @ sound[b] >= threshold:
                links[a] += 1
                links[b] += 1
                edges.append((a, b))
    want = joined(links, edges)
    assert edges
    for key, row in got.items():
        assert (row["n_links"], row["component_id"]) == (links[key], want[key])
        assert row["kept"] == (key == want[key])


def some_vectors(n=400, dim=24):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(n // 8, dim))
    x = base[rng.integers(0, len(base), n)] + rng.normal(size=(n, dim)) * rng.uniform(0.05, 0.5, (n, 1))
    rows = [(k, [float(v) for v in r], k % 3) for k, r in enumerate(x)]
    rows += [(n + k, rows[k][1], 0) for k in range(0, 40, 3)]
    odd = [None, [], [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1)]
    odd += [[float("inf")] + [1.0] * (dim - 1), [3.0], [5.0], [-1.0], [1.0, 2.0], [1e30, 2e30]]
    return rows + [(n + 100 + k, v, None) for k, v in enumerate(odd)]


def test_vectors(spark):
    check_vectors(spark, some_vectors())


def test_vectors_in_cells_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CELL_ROWS", 16)
    monkeypatch.setattr(vectors, "VISITORS", 7)
    monkeypatch.setattr(vectors, "PAIRS", 11)
    check_vectors(spark, some_vectors())


def test_vectors_empty(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, rep string")
    assert near_vectors(df).collect() == []


def test_language(spark):
    rng = np.random.default_rng(6)
    letters = {"xx": "abcde", "yy": "vwxyz", "zz": "klmné"}
    rows = []
    for k in range(240):
        lang = ("xx", "yy", "zz")[k % 3]
        text = " ".join("".join(rng.choice(list(letters[lang]), 5)) for _ in range(int(rng.integers(2, 40))))
        rows.append((k, text, lang if k % 7 else None, "s", 0, "clash"))
    rows += [(900, None, "xx", None, None, None), (901, "123 !!", "xx", None, None, None)]
    rows += [(902, "", None, None, None, None), (903, "abcde " * 50_000, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS + ", score string")
    model = fit(docs)
    got = {r["doc_id"]: r for r in predict(docs, model).collect()}
    assert len(got) == len(rows)
    for key, row in got.items():
        assert row["held_out"] == (zlib.crc32(str(key).encode()) % 4 == 2)
        assert 0 <= row["score"] <= 1
        if key < 240:
            assert row["lang_pred"] == ("xx", "yy", "zz")[key % 3]
    assert [got[k]["lang_pred"] for k in (900, 901, 902, 903)] == ["und", "und", "und", "xx"]
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert fit(none) is None
    assert {r["lang_pred"] for r in predict(none, None).collect()} == {"und"}


def water_level(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > most * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: most * sizes[s] for s in over})


def test_mixing(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(["w"] * int(n)) for n in rng.integers(0, 400, 500)] + [None, ""]
    docs = table(spark, texts)
    docs = docs.withColumn("source", F.when(F.col("doc_id") < 12, "a-small").otherwise(F.col("source")))
    rows = mixed_words(docs).collect()
    again = mixed_words(docs.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == len(texts)
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert r["size"] == len(words(texts[r["doc_id"]])) and 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    want = water_level(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-12)
        assert abs(taken[s] - target[s]) <= 2 * mixing.BLOCK_WORDS
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)


def test_shards_are_full_and_slots_unique(spark):
    sizes = spark.createDataFrame([(k, f"s{k % 3}", 1000 + k) for k in range(60)], "doc_id bigint, source string, size bigint")
    slots = draw_slots(source_targets(sizes), 64, 100).collect()
    places = sorted((r["shard"], r["place"]) for r in slots)
    assert places == [(k // 100, k % 100) for k in range(len(slots))]


def test_mixing_of_nothing(spark):
    assert mixed_words(spark.createDataFrame([], DOCS + ", size string, target string")).collect() == []
    (row,) = mixed_words(table(spark, [None])).collect()
    assert (row["size"], row["target"], row["taken"]) == (0, 0.0, 0)


TEXTS = [
    None,
    "",
    "Hello, world. It's 12  o'clock\n\n\tnow",
    "Überraschung … déjà vu  x " * 40,
    "<|endoftext|> inside <|endoftext|>text",
    "long words and more " * 4000,
    "\x1c odd \x85 space  here",
]


@pytest.mark.parametrize("name", sorted(SPLITS))
def test_encoder_equals_whole_texts(name):
    import random

    coder = Encoder(name, public_tokenizers.path(name))
    rng = random.Random(1)
    alphabet = list("ab .,'\n\t\r AZé½Σς…́  ≠!s1 　") + ["<|endoftext|>", "'s", "'re"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    texts += [t or "" for t in TEXTS]
    for text, ids in zip(texts, coder.encode([t.encode() for t in texts])):
        want = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want


def ids_by_force(name, texts, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000, 4097):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert (ids_of(planes_of(ids, kind), n) == ids).all()
        sizes, payload = pack_blocks(ids, kind, 1000)
        assert (unpack_blocks(sizes, payload, n, kind, 1000) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_token_files(spark, kind):
    name, texts = "word_bpe_49k.json", TEXTS * 3
    docs = table(spark, texts).withColumn("ids", F.lit("clash"))
    chunks = encode_chunks(docs, name, public_tokenizers.path(name), 1, kind, 500, 128)
    rows = sorted(document_ids(chunks, kind, 128).collect(), key=lambda r: r["doc_id"])
    start = 0
    for row, ids in zip(rows, ids_by_force(name, texts, 1), strict=True):
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    none = encode_chunks(docs.limit(0), name, public_tokenizers.path(name), 1)
    assert document_ids(none).collect() == []


def test_packing(spark):
    name, texts = "byte_bpe_50k.json", TEXTS * 4 + ["word " * n for n in range(0, 3000, 37)]
    docs = table(spark, texts).withColumn("length", F.lit("clash"))
    rows = pack_documents(docs, name, public_tokenizers.path(name), 0).collect()
    found = {(r["doc_id"], r["piece"]): r for r in rows}
    assert len(found) == len(rows)
    total = 0
    for k, ids in enumerate(ids_by_force(name, texts, 0)):
        total += len(ids)
        ends = [len(ids) % 2048 or 2048] if len(ids) > 2048 else [len(ids)]
        while ends[-1] < len(ids):
            ends.append(ends[-1] + 2048)
        for piece, (low, high) in enumerate(zip([0, *ends], ends)):
            row = found.pop((k, piece))
            assert (row["start"], row["length"], row["ids_crc32"]) == (low, high - low, crc(ids[low:high]))
    assert not found
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 3
    assert pack_documents(docs.limit(0), name, public_tokenizers.path(name), 0).collect() == []


def test_histograms_are_packed_whole():
    rng = np.random.default_rng(2)
    for n in (1, 30, 3000):
        sizes = np.clip(np.exp(rng.normal(3.3, 1, n)).astype(int), 1, 128)
        histogram = {int(s): int((sizes == s).sum()) for s in np.unique(sizes)}
        held = {}
        number = 0
        for times, counts in pack_histogram(histogram, 128, 50):
            assert sum(s * c for s, c in counts.items()) <= 128
            number += times
            for s, c in counts.items():
                held[s] = held.get(s, 0) + times * c
        assert held == histogram
        low = -(-int(sizes.sum()) // 128)
        greedy = len(best_fit(np.array(sorted(histogram)), np.array([histogram[s] for s in sorted(histogram)]), 128))
        assert low <= number <= max(greedy, 1.02 * low)
    assert pack_histogram({}, 128) == [] and pack_histogram({128: 5}, 128) == [(5, {128: 1})]


def test_repeated_rows_and_nulls(spark):
    rows = [(1, "a b c d e f", "en", "s", 5)] * 3 + [(None, None, None, None, None), (2, "x", None, None, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    name = "byte_bpe_50k.json"
    assert len(pack_documents(docs, name, public_tokenizers.path(name), 0).collect()) == 5
    assert len(near_duplicates(docs).collect()) == 5
    assert len(mixed_words(docs).collect()) == 5
    assert len(predict(docs, fit(docs)).collect()) == 5
    assert not re.search("nothing", str(near_duplicates(docs.limit(0)).collect()))


def test_spaced_words_are_learned_in_one_text():
    """Without a special token between them, each with the ids it has alone."""
    from tallyward.llm.tokens import Encoder

    name = "byte_bpe_50k.json"
    coder = Encoder(name, public_tokenizers.path(name))
    calls, plain = [], coder._ids
    coder._ids = lambda text: calls.append(text) or plain(text)
    words = [" one", " it's", " '", " 's", " \u00e9t\u00e9", " \u0301x", " 12,5", " \u4e2d\u6587", " \x1cx", " \u0120a", "\ntwo", "\n", " "]
    coder._learn([w.encode() for w in words])
    assert calls[0] == "".join(words[:10]) and len(calls) == 2
    for word in words:
        ids = coder.tokenizer.encode(word, add_special_tokens=False).ids
        assert coder.young[word.encode()] == np.array(ids, dtype="<u4").tobytes()


def test_best_pattern_equals_plain_knapsack():
    from tallyward.llm.packing import best_pattern

    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = np.unique(rng.integers(1, 60, size=rng.integers(1, 20)))
        worth = rng.random(len(lengths)) * lengths
        best = np.zeros(61)
        for size in range(1, 61):
            best[size] = max([best[size - 1], *(best[size - n] + w for n, w in zip(lengths, worth) if n <= size)])
        counts = best_pattern(lengths, worth, 60)
        assert (counts * lengths).sum() <= 60 and abs((counts * worth).sum() - best[60]) < 1e-9
