"""Hard negatives, the word table and collocations against brute force."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.llm import negatives
from tallyward.llm.negatives import hard_negatives, packed_planes, scores, subset_tables, width_of
from tallyward.llm.phrases import collocations, frequent_phrases
from tallyward.llm.word_table import codec, encode_words, gaps, numbers_of, packed, unpacked

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
public_tokenizers = pytest.importorskip("public_tokenizers")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_scores_are_exact():
    rng = np.random.default_rng(1)
    for dims in (1, 7, 8, 65):
        for low, high in ((-256, 255), (-1, 0), (0, 0), (-70_000, 3)):
            a, b = (rng.integers(low, high + 1, (n, dims)) for n in (5, 40))
            planes = packed_planes(b, width_of(low, high))
            assert (scores(subset_tables(a), planes) == b @ a.T).all()


def brute_negatives(rows, every=50, positives=5, negatives=3):
    sound = {}
    for key, x, label in rows:
        if None in (key, x, label) or any(v is None or not math.isfinite(v) for v in x):
            continue
        x = tuple(math.floor(256 * float(np.float32(v))) for v in x)
        sound[(key, x, label)] = None
    out = []

    def best(anchor, wanted):
        found = [
            (-sum(p * q for p, q in zip(anchor[1], o[1])), o[0]) for o in sound if o[0] != anchor[0] and wanted(o)
        ]
        return sorted(found)

    for anchor in sound:
        if anchor[0] % every:
            continue
        for p, positive in best(anchor, lambda o: o[2] == anchor[2])[:positives]:
            fits = [
                (n, other)
                for n, other in best(anchor, lambda o: o[2] != anchor[2])
                if 50 * -p <= 100 * -n <= 95 * -p
            ]
            for rank, (n, other) in enumerate(fits[:negatives], 1):
                out.append((anchor[0], positive, rank, other, -p, -n))
    return sorted(out)


def some_rows(n=400, dims=12):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, dims))
    rows = []
    for k in range(n):
        x = base[k % 6] + rng.normal(size=dims) * 0.4
        rows.append((k, [float(v) for v in x.astype(np.float32)], int(rng.integers(4)) if k % 3 else 0))
    # Ties by copies under other ids, an exact repeat, and rows that take no part.
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(0, 60, 4)] + [rows[50], rows[7]]
    odd = [None, [None] * dims, [float("nan")] * dims, [float("inf")] + [1.0] * (dims - 1)]
    rows += [(5000 + 50 * k, x, 1) for k, x in enumerate(odd)]
    rows += [(6000, rows[0][1], None), (None, rows[0][1], 1), (7000, [], 2), (7050, [0.5], 2)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:
        # Many lanes and groups of a few rows each.
        monkeypatch.setattr(negatives, "LANE_ROWS", 37)
        monkeypatch.setattr(negatives, "TABLE_BYTES", 2 * 1024 * 3)
    rows = some_rows()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    df = df.withColumns({"key": F.lit("x"), "row_id": F.lit(0), "rank": F.lit(1)})
    got = sorted(map(tuple, hard_negatives(df).collect()))
    want = brute_negatives(rows)
    assert got == want and len(want) > 50


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert hard_negatives(df).collect() == []
    one = spark.createDataFrame([(50, [1.0], 1)], "vec_id bigint, embedding array<float>, label int")
    assert hard_negatives(one).collect() == []
    huge = spark.createDataFrame([(50, [1e30], 1)], "vec_id bigint, embedding array<float>, label int")
    with pytest.raises(ValueError):
        hard_negatives(huge)


def test_numbers_and_gaps():
    for numbers in ([], [0], [0, 1, 0, 2, 2, 1, 3], [0, 0, 0, 1]):
        numbers = np.array(numbers, dtype=np.int64)
        assert (numbers_of(gaps(numbers)) == numbers).all()
        assert (unpacked(packed(numbers)) == numbers).all()


ODD = [
    None,
    "",
    " \t\n ",
    "Hello, World. it's 5, 6 a.b.c. !).",
    "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>, <| |>",
    "  　  x y .",
    "été ÉTÉ. İstanbul ΣΑΣ",
    "中文没有空格 \U0001f600\U0001f44d\U0001f3fd",
    "x\x00y \x1c\x1d z",
    ", . ,. .,",
]


def test_word_table(spark):
    from tokenizers import Tokenizer

    rng = np.random.default_rng(2)
    letters = list("abcdefghijklmnopéß.,'-<|>19")
    words = ["".join(rng.choice(letters, int(rng.integers(1, 9)))) for _ in range(900)]
    texts = ODD + [" ".join(rng.choice(words, int(rng.integers(1, 300)))) for _ in range(150)]
    texts += ["Very Long, " * 60_000, "q" * 300_000]
    rows = [(k % 140 if k % 9 else None, t, "en", "s", 0, 7) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS + ", block bigint")
    tokenizer = Tokenizer.from_file(WORD_BPE)

    def want(doc_id, text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        data = np.array(ids, "<u4").tobytes()
        digests = [hashlib.sha256(x).hexdigest() for x in (data, decoded.encode())]
        return (doc_id, len(ids), *digests, data, decoded)

    got = [(*r[:4], bytes(r[4]), r[5]) for r in codec(docs, WORD_BPE, whole=True).collect()]
    assert sorted(got, key=repr) == sorted((want(r[0], r[1]) for r in rows), key=repr)
    assert sorted(map(tuple, codec(docs, WORD_BPE).collect()), key=repr) == sorted((g[:4] for g in got), key=repr)
    assert codec(docs.limit(0), WORD_BPE).collect() == []


def test_words_alone_have_the_ids_they_have_in_a_text():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    words = ["abc", "it's", "<", "|", "<|x", "a<|endoftext|>", "é", "..."]
    want = [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert encode_words(WORD_BPE, words) == want and encode_words(WORD_BPE, []) == []


def brute_phrases(rows, support, longest, first):
    counts, sizes = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[(lang or "und", *w[i : i + k])] += 1
    frequent = {p: f for p, f in counts.items() if f >= support}
    out = []
    for lang in sizes:
        found = []
        for p, a in frequent.items():
            if p[0] != lang or len(p) < 3:
                continue
            w = p[1:]
            around = (
                q
                for q, f in frequent.items()
                if q[0] == lang and len(q) > len(p) and f >= a
                and any(q[1:][i : i + len(w)] == w for i in range(len(q) - len(p) + 1))
            )
            if next(around, None):
                continue
            cuts = []
            for k in range(1, len(w)):
                left, right = frequent[(lang, *w[:k])], frequent[(lang, *w[k:])]
                cuts.append((1000 * a * sizes[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out), {(p[0], " ".join(p[1:])): f for p, f in frequent.items()}


@pytest.mark.parametrize("support", [3, 40])
def test_collocations(spark, support):
    rng = np.random.default_rng(9)
    words = ["The", "of", "AND", "xÉy", " q", "new", "york", "city", "in"] + [f"w{k}" for k in range(40)]
    weights = 1 / np.arange(1, len(words) + 1)
    texts = []
    for _ in range(260):
        parts = list(rng.choice(words, int(rng.integers(0, 40)), p=weights / weights.sum()))
        if rng.random() < 0.4:
            parts[len(parts) // 2 : len(parts) // 2] = ["new", "York", "city", "in", "THE"]
        texts.append("".join(w + str(rng.choice([" ", "  ", "\t", ", ", ".", "\n", "! "], p=[0.6, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05])) for w in parts))
    texts += [None, "", " . , ", "a a a a a a a a a a", "the the the the"]
    rows = [(k if k % 7 else None, t, ("en", "fr", None)[k % 3] if k % 5 else "en", "s", 1) for k, t in enumerate(texts)]
    rows += rows[:40]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    want, frequent = brute_phrases(rows, support, 5, 30)
    every, _ = frequent_phrases(docs, support)
    assert {(r["lang"], r["phrase"]): r["f"] for r in every.collect()} == frequent
    assert sorted(map(tuple, collocations(docs, support, first=30).collect())) == want
    assert len(want) > (20 if support == 3 else 4)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert collocations(docs).collect() == []
    one = spark.createDataFrame([(1, "Very Long " * 40_000 + "end", None, None, None)], DOCS)
    got = [tuple(r) for r in collocations(one).collect()]
    # Runs of five words hold every shorter one, but those are more frequent.
    assert {r[0] for r in got} == {"und"} and all(r[6] == 80_001 for r in got)
    assert max(len(r[2].split()) for r in got) == 5
