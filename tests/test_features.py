import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from tallyward.operators.entity import Entity, FeatureGroup, entity_features
from tallyward.operators.features import (
    Count,
    DistinctCount,
    DistinctRatio,
    Percentile,
    Ratio,
    Stat,
    TopNRatio,
)
from tallyward.operators.groups import GroupSpec

LOG = [
    ("a", "x", 1, 10.0),
    ("a", "x", 2, 20.0),
    ("a", "y", 3, None),
    ("a", None, 4, -5.0),
    ("b", "z", 5, 7.0),
    (None, "z", 6, 1.0),
    ("", "z", 7, 1.0),
]


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(LOG, "d string, app string, n int, v double")


def values(log, *features, dkey=("d",), where=True):
    group = FeatureGroup("g", (Entity(dkey, features),), where)
    long = entity_features(log, group)
    return {(r.dval, r.fkey): r.fval for r in long.collect()}


def test_counts_ignore_null_conditions(log):
    got = values(log, Count("all"), Count("big", "v > 5"), where="d = 'a' OR d = 'b'")
    assert got == {("a", "all"): 4, ("a", "big"): 2, ("b", "all"): 1, ("b", "big"): 1}


def test_distinct_counts_null_key_as_a_value(log):
    key = ("app",)
    got = values(log, DistinctCount("apps", columns=key), where="d = 'a'")
    assert got == {("a", "apps"): 3}
    got = values(log, DistinctCount("apps", "app IS NOT NULL", key), where="d = 'a'")
    assert got == {("a", "apps"): 2}


def test_joined_keys_skip_nulls_and_collide(spark):
    pairs = spark.createDataFrame(
        [("d", "q", None), ("d", None, "q"), ("d", "", "q")], "d string, a string, b string"
    )
    assert values(pairs, DistinctCount("n", columns=("a", "b"))) == {("d", "n"): 2}


def test_null_and_empty_text_are_one_distinct_key(spark):
    texts = spark.createDataFrame([("d", None), ("d", ""), ("d", "k")], "d string, a string")
    assert values(texts, DistinctCount("n", columns=("a",))) == {("d", "n"): 2}
    numbers = spark.createDataFrame([("d", None), ("d", 0), ("d", 1)], "d string, a int")
    assert values(numbers, DistinctCount("n", columns=("a",))) == {("d", "n"): 3}


def test_ratio_is_null_without_rows(log):
    got = values(
        log,
        Ratio("share", top="app = 'x'", bottom="v IS NOT NULL"),
        Ratio("none", bottom="v > 1000"),
        where="d = 'a'",
    )
    assert got[("a", "share")] == pytest.approx(2 / 3)
    assert got[("a", "none")] is None


def test_stats_clip_only_when_asked(log):
    got = values(
        log,
        Stat("plain", True, "avg", "v"),
        Stat("clipped", True, "sum", "v", 15.0),
        Stat("low", True, "min", "v"),
        Stat("seen", True, "count", "v"),
        Stat("spread", "v > 0", "stddev_pop", "v"),
        where="d = 'a'",
    )
    assert got[("a", "plain")] == pytest.approx(25 / 3)
    assert got[("a", "clipped")] == 20.0
    assert got[("a", "low")] == -5.0
    assert got[("a", "seen")] == 3
    assert got[("a", "spread")] == 5.0


def test_percentile_next_to_other_kinds(log):
    got = values(
        log,
        Percentile("p50", True, 0.5, "n", 3.0),
        DistinctCount("apps", columns=("app",)),
        Count("all"),
        where="d = 'a'",
    )
    assert got == {("a", "p50"): 2.0, ("a", "apps"): 3.0, ("a", "all"): 4.0}


def test_null_and_empty_entities_are_separate_groups_with_one_name(log):
    group = FeatureGroup("g", (Entity(("d",), (Count("all"),)),), "d IS NULL OR d = ''")
    assert rows(entity_features(log, group), "dval", "fval") == [("", 1.0), ("", 1.0)]


def test_several_entities_make_one_table(log):
    group = FeatureGroup(
        "g",
        (
            Entity(("d",), (Count("by_d"),)),
            Entity(("d", "app"), (Count("by_d_app"), DistinctCount("n", columns=("n",)))),
        ),
        "d = 'a' AND app IS NOT NULL",
    )
    got = rows(entity_features(log, group))
    assert got == [
        ("count", "d", "a", "by_d", 3.0),
        ("count", "d_app", "a|x", "by_d_app", 2.0),
        ("count", "d_app", "a|y", "by_d_app", 1.0),
        ("distinct_count", "d_app", "a|x", "n", 2.0),
        ("distinct_count", "d_app", "a|y", "n", 1.0),
    ]
    assert group.kinds == ("count", "distinct_count")


def test_top_n_weighs_all_rows_of_a_ranked_key(spark):
    log = spark.createDataFrame(
        [("d", "x", True), ("d", "x", False), ("d", "x", False), ("d", "y", True)]
        + [("d", "z", False)] * 5
        + [("e", "x", False)],
        "d string, k string, ok boolean",
    )
    got = values(log, TopNRatio("top1", "ok", ("k",), 1), TopNRatio("top2", "ok", ("k",), 2))
    # x and y tie with one passing row each; y ranks first, z has no passing row.
    assert got[("d", "top1")] == pytest.approx(1 / 4)
    assert got[("d", "top2")] == 1.0
    assert got[("e", "top1")] is None


def test_top_n_breaks_ties_by_text(spark):
    log = spark.createDataFrame(
        [("d", 9), ("d", 10), ("d", 10), ("d", 9), ("d", 1)], "d string, k int"
    )
    two_keys = values(log.union(log.limit(0)), TopNRatio("top1", True, ("k",), 1))
    assert two_keys[("d", "top1")] == pytest.approx(2 / 5)


def test_top_key_from_aggregates_equals_ranking(spark):
    from tallyward.operators.topn import top_n_ratios

    log = spark.range(4000).selectExpr(
        "CAST(sqrt(id) AS INT) % 40 AS d", "hash(id) % 7 AS k", "hash(id, 1) % 5 = 0 AS ok"
    )
    features = (TopNRatio("ok1", "ok", ("k",), 1), TopNRatio("all1", True, ("k",), 1))
    ranked = {(r.dval, r.fkey): r.fval for r in top_n_ratios(log, ("d",), features).collect()}
    assert values(log, *features) == ranked and len(ranked) == 80


def test_ranking_in_slices_changes_nothing(spark, monkeypatch):
    from tallyward.operators import topn

    log = spark.range(5000).selectExpr("id % 3 AS d", "hash(id) % 200 AS k")
    features = (TopNRatio("top5", True, ("k",), 5), TopNRatio("top50", True, ("k",), 50))
    whole = values(log, *features)
    monkeypatch.setattr(topn, "GROUP_LIMIT", 1)
    assert values(log, *features) == whole and len(whole) == 6


def test_a_top_key_needs_no_pass_of_its_own(log):
    features = (
        Count("all"),
        DistinctCount("apps", columns=("app",)),
        TopNRatio("top1", True, ("app",), 1),
    )
    df = entity_features(log, FeatureGroup("g", (Entity(("d",), features),)))
    assert plan_of(df).count("Exchange hashpartitioning") == 2


def test_two_top_n_features_on_different_keys(log):
    got = values(
        log, TopNRatio("app1", True, ("app",), 1), TopNRatio("n1", True, ("n",), 1), where="d = 'a'"
    )
    assert got == {("a", "app1"): 0.5, ("a", "n1"): 0.25}


@pytest.mark.parametrize(
    "build",
    [
        lambda: Entity(("d",), (Count("x"), Count("x"))),
        lambda: Entity("d", (Count("x"),)),
        lambda: Entity(("d",), (DistinctRatio("x", columns=("k",)),)),
        lambda: Entity(("d",), ()),
        lambda: DistinctCount("x"),
        lambda: TopNRatio("x", True, ("k",), 0),
        lambda: Percentile("x", True, 1.5, "v"),
        lambda: FeatureGroup("g", ()),
        lambda: GroupSpec("g", ("a,b", "b,a"), (Count("x"),)),
        lambda: GroupSpec("g", (), (Count("x"),)),
        lambda: GroupSpec("g", ("a",), (TopNRatio("x", True, ("k",), 1),)),
    ],
)
def test_bad_specs_are_rejected(build):
    with pytest.raises(ValueError):
        build()


def test_columns_and_texts_mean_the_same(log):
    one = values(log, Count("n", "v > 5 AND app = 'x'"))
    other = values(log, Count("n", (F.col("v") > 5) & (F.col("app") == "x")))
    assert one == other


@pytest.mark.parametrize("few", [10_000, 100_000])
def test_percentiles_of_large_groups_are_exact(spark, monkeypatch, few):
    """In slices and sorted at once, for NULL groups and mixed types."""
    monkeypatch.setattr("tallyward.operators.percentiles.FEW", few)
    many = spark.range(120_000).select(
        F.when(F.col("id") % 3 > 0, F.lit("e")).alias("d"),
        F.pmod(F.xxhash64("id"), F.lit(50_000)).alias("v"),
        (F.pmod(F.hash("id"), F.lit(1000)) / 8).alias("w"),
    )
    features = (
        Percentile("p07", True, 0.07, "v"),
        Percentile("p90", True, 0.9, "v"),
        Percentile("top", "v < 40000", 1.0, "v"),
        Percentile("w50", True, 0.5, "w"),
        Percentile("none", "v < 0", 0.5, "v"),
    )
    (entity,) = FeatureGroup("g", (Entity(("d",), features),)).entities
    got = {}
    for r in entity_features(many, FeatureGroup("g", (entity,))).collect():
        got.setdefault(r.dval, {})[r.fkey] = r.fval
    want = {}
    for r in many.collect():
        want.setdefault(r.d or "", []).append((r.v, r.w))

    def ranked(values, share):
        return sorted(values)[max(-(-len(values) * share // 100), 1) - 1]

    for name, held in want.items():
        v, w = [a for a, _ in held], [b for _, b in held]
        assert got[name] == {
            "p07": ranked(v, 7),
            "p90": ranked(v, 90),
            "top": max(x for x in v if x < 40_000),
            "w50": ranked(w, 50),
            "none": None,
        }
