"""Shared helpers and text hashing against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyward.llm import common
from tallyward.llm.common import components, permuted
from tallyward.llm.groups import forest, sorted_groups
from tallyward.llm.octets import runs, shingle_hashes, word_hashes

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def shingles(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def joined(nodes, edges):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)]
    edges += [(1000 + k, 1001 + k) for k in range(60)] + [(2000, k) for k in range(2001, 2100)]
    nodes = {x for e in edges for x in e}
    df = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    got = {r["id"]: r["component_id"] for r in df.collect()}
    want = {n: c for n, c in joined(nodes, edges).items() if n != c}
    assert got == want


def test_components_with_dealt_out_nodes(spark, monkeypatch):
    monkeypatch.setattr(common, "MANY_EDGES", 10)
    edges = [(7, k) for k in range(8, 400)] + [(k, k + 1) for k in range(500, 530)]
    df = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    got = {r["id"]: r["component_id"] for r in df.collect()}
    assert got == {**{k: 7 for k in range(8, 400)}, **{k: 500 for k in range(501, 531)}}


def test_components_of_nothing(spark):
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert components(none).collect() == []
    loop = spark.createDataFrame([(3, 3)], "a bigint, b bigint")
    assert components(loop).collect() == []


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 7, 64, 1000, 4099):
        df = spark.range(n).select(
            permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(9).cast("bigint")).alias("p")
        )
        assert sorted(r[0] for r in df.collect()) == list(range(n))


def test_word_and_shingle_hashes():
    rng = random.Random(2)
    pieces = ["a", "B", "é", "the", "THE", "x.y", " ", "\n", "\t", " ", "ab"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    texts += [None, "", " ", "word " * 5000]
    to_hash, to_set = {}, {}
    for at, data, bounds in runs(pa.array(texts), 3000):
        for width in (3, 5):
            hashes, counts = word_hashes(data, bounds)
            values, numbers = shingle_hashes(hashes, counts, width)
            ends = np.cumsum(numbers)
            for k, n in enumerate(numbers.tolist()):
                assert counts[k] == len(words(texts[at + k]))
                want = (width, frozenset(shingles(texts[at + k], width)))
                got = tuple(values[ends[k] - n : ends[k]].tolist())
                assert len(got) == len(want[1])
                assert to_hash.setdefault(want, got) == got
                assert to_set.setdefault((width, got), want) == want


def test_forest_and_groups():
    links = {(0, 3), (3, 5), (1, 2)}
    edges = forest(6, lambda x, o: np.array([tuple(sorted((x, k))) in links for k in o.tolist()], bool))
    assert joined(range(6), edges) == {0: 0, 1: 1, 2: 1, 3: 0, 4: 4, 5: 0}
    batches = [
        pa.record_batch({"k": pa.array(keys, pa.int64()), "v": pa.array(range(len(keys)))})
        for keys in ([1, 1, 2], [], [2, 2, 3], [4])
    ]
    sizes = [(key[0], rows.num_rows) for key, rows in sorted_groups(batches, 1)]
    assert sizes == [(1, 2), (2, 3), (3, 1), (4, 1)]
