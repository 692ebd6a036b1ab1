import math

import pytest

from helpers import close, rows
from tallyward.operators.merge import (
    MergedFeature,
    merge_parts,
    merge_wide,
    population_of_parts,
    population_stats,
    wide_of_parts,
)

LONG = [
    ("a", "cnt", 3.0),
    ("a", "ratio", 0.123456),
    ("b", "cnt", 5000.0),
    ("b", "ratio", None),
    ("c", "other", 1.0),
    ("d", "cnt", 0.0),
]


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame(LONG, "dval string, fkey string, fval double")


def test_wide_rounds_clips_transforms_and_fills(long):
    features = (
        MergedFeature("cnt", clip=1000.0, func="log"),
        MergedFeature("ratio", fill=-2.0),
    )
    got = rows(merge_wide(long, features, "device"))
    assert got == [
        ("a", round(math.log(3), 4), 0.1235),
        ("b", math.log(1000), -2.0),  # the clip is not rounded
        ("c", -1.0, -2.0),
        ("d", -1.0, -2.0),  # log(0) is NULL
    ]


def test_population_over_present_values_only(long):
    features = (MergedFeature("cnt", clip=1000.0), MergedFeature("never"))
    got = {r.fkey: (r.avg_value, r.std_value) for r in population_stats(long, features).collect()}
    numbers = [3.0, 1000.0, 0.0]
    mean = sum(numbers) / 3
    std = math.sqrt(sum((n - mean) ** 2 for n in numbers) / 3)
    assert got == {"cnt": (round(mean, 4), round(std, 4)), "never": (None, None)}


def test_unknown_transform_and_double_names(long):
    with pytest.raises(ValueError):
        MergedFeature("x", func="drop table")
    with pytest.raises(ValueError):
        merge_wide(long, (MergedFeature("x"), MergedFeature("x")))


def test_parts_give_both_outputs(spark):
    rng = [(f"e{k % 9}", f, float(k % 13) + 0.37 * (k % 5)) for k in range(120) for f in ("a", "b")]
    # Copies of a feature, a NULL, and one that never occurs.
    data = rng + [("e1", "a", None), ("e99", "b", 1e6), ("e99", "b", 1e6)]
    long = spark.createDataFrame(data, "dval string, fkey string, fval double")
    features = (MergedFeature("a", clip=9.0, func="log"), MergedFeature("b"), MergedFeature("c", fill=-7.0))
    parts = merge_parts(long, features)
    close(rows(wide_of_parts(parts, features)), rows(merge_wide(long, features)))
    close(rows(population_of_parts(parts, features)), rows(population_stats(long, features)))
    none = merge_parts(long.limit(0), features)
    assert rows(population_of_parts(none, features)) == rows(population_stats(long.limit(0), features))
