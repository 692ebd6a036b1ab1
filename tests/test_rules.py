import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import close, rows
from tallyward.operators import rules as R
from tallyward.operators.rules import GridDim, Strategy


def grid(dim):
    points = [round(dim.low + i * dim.step, 3) for i in range(int((dim.high - dim.low) / dim.step) + 1)]
    return points if max(points) >= dim.high else [*points, dim.high]


def steps(value, points):
    value = -1.0 if value is None else value
    return [t for t in points if t <= value] or [-1.0]


def texts(features, strategy):
    """All rules a group meets, by brute force."""
    sides = [steps(features.get(d.feature), grid(d)) for d in strategy.grid]
    return {
        " and ".join(f"{d.feature} >= {float(t)}" for d, t in zip(strategy.grid, combo))
        for combo in itertools.product(*sides)
    }


@pytest.mark.parametrize(
    "low, high, step, want",
    [
        (0.2, 0.9, 0.1, [0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]),
        (5.0, 100.0, 10.0, [5.0, 15.0, 25.0, 35.0, 45.0, 55.0, 65.0, 75.0, 85.0, 95.0, 100.0]),
        (1.0, 1.0, 1.0, [1.0]),
        (0.0, 1.0, 0.3333, [0.0, 0.333, 0.667, 1.0]),
    ],
)
def test_grid_points(spark, low, high, step, want):
    table = R.grid_table(spark, [Strategy("s", (GridDim("f", low, high, step),))])
    assert table.collect()[0].dims[0].thresholds == want


@pytest.mark.parametrize(
    "value, want", [(0.1, 0), (0.2, 1), (0.25, 1), (0.4, 3), (9.0, 3), (None, 0)]
)
def test_points_reached(spark, value, want):
    df = spark.createDataFrame([(value, [0.2, 0.3, 0.4])], "v double, g array<double>")
    (row,) = df.select(R.points_reached(F.col("v"), F.col("g")).alias("n")).collect()
    assert row.n == want


@pytest.mark.parametrize(
    "build",
    [
        lambda: GridDim("f", 0.0, 1.0, 0.0),
        lambda: GridDim("f", 1.0, 0.0, 0.1),
        lambda: GridDim("f", -1.0, 1.0, 0.1),
        lambda: Strategy("s", ()),
        lambda: Strategy("s", (GridDim("f", 0, 1, 1), GridDim("f", 0, 1, 1))),
    ],
)
def test_bad_grids(build):
    with pytest.raises(ValueError):
        build()


STRATEGIES = (
    Strategy("s", (GridDim("a", 0.2, 0.9, 0.2), GridDim("3b", 5, 40, 10), GridDim("c", 1, 4, 1))),
    Strategy("s,t", (GridDim("3b", 5, 20, 5),)),
    Strategy("u", (GridDim("c", 1, 6, 2), GridDim("a", 0.5, 0.6, 0.1))),
)


def random_groups(seed, count=120):
    rng = random.Random(seed)
    groups = []
    for i in range(count):
        features = {
            "a": rng.choice([0.0, 0.1, 0.2, 0.35, 0.5, 0.6, 1.0]),
            "3b": rng.randrange(50),
            "c": rng.randrange(7),
        }
        for name in list(features):
            if rng.random() < 0.1:
                del features[name]
        groups.append((rng.choice(["s", "s,t", "u", "not in the spec"]), f"p{i}", features))
    return groups


def frame(spark, groups):
    data = [(s, p, json.dumps(f)) for s, p, f in groups]
    data.append(("s", "broken", "{not json"))
    return spark.createDataFrame(data, "group_schema string, group_pattern string, feature_json string")


def test_expansion_equals_brute_force(spark):
    groups = random_groups(1)
    got = R.expand_rules(frame(spark, groups), STRATEGIES, {"n": F.count(F.lit(1))})
    want = {}
    by_schema = {s.schema: s for s in STRATEGIES}
    for schema, _, features in [*groups, ("s", "broken", {})]:
        if schema in by_schema:
            for text in texts(features, by_schema[schema]):
                want[(schema, text)] = want.get((schema, text), 0) + 1
    assert {(r.group_schema, r.rule_condition): r.n for r in got.collect()} == want
    (row,) = got.where("rule_condition = '3b >= 5.0'").collect()
    assert [tuple(t) for t in row.rule] == [("3b", 5.0)]


def mined(spark, kinds):
    """Groups with labels: (schema, pattern, features, game, ug, ecom)."""
    data = [
        (s, p, json.dumps(f), *[None if k is None else json.dumps(k) for k in ks])
        for s, p, f, *ks in kinds
    ]
    names = "group_schema string, group_pattern string, feature_json string, game_json string, ug_json string, ecom_json string"
    return R.mine_strategies(spark.createDataFrame(data, names), STRATEGIES)


def test_rule_of_one_kind_has_null_metrics_for_others(spark):
    got = mined(
        spark,
        [
            ("s,t", "p1", {"3b": 7}, None, {"ug_activation_cnt": 4, "ug_day_0_scale": 0.5}, None),
            ("s,t", "p2", {"3b": 7}, None, {"ug_activation_cnt": 6}, None),
            ("s,t", "p3", {"3b": 1}, None, None, None),
            ("s,t", "p4", {"3b": 12}, None, None, {"ord_cnt": "10", "trust_ord_cnt": 0, "fail_cnt": 2}),
        ],
    )
    found = {r.rule_condition: r.asDict() for r in got.collect()}
    assert set(found) == {"3b >= 5.0", "3b >= 10.0"}
    low = found["3b >= 5.0"]
    assert (low["ug_activation_cnt"], low["ug_day_0_activation_cnt"]) == (10.0, 4.0)
    assert low["ug_day_0_scale"] == 0.5  # only where the scale is known
    assert low["game_activation_cnt"] is None
    assert (low["ord_cnt"], low["fail_ratio"], low["trust_fail_ratio"]) == (10.0, 0.2, None)
    assert found["3b >= 10.0"]["ug_activation_cnt"] is None
    table = {r.rule_condition: json.loads(r.ad_performance_json) for r in R.strategies_json(got).collect()}
    assert "game_activation_cnt" not in table["3b >= 5.0"]
    assert list(table["3b >= 10.0"]) == ["ord_cnt", "fail_cnt", "fail_ratio", "trust_ord_cnt"]


def test_mining_equals_brute_force(spark):
    rng = random.Random(3)
    labelled = []
    for schema, pattern, features in random_groups(2):
        game = {"game_activation_cnt": rng.randrange(9), "game_day_1_scale": rng.random()}
        if rng.random() < 0.3:
            del game["game_day_1_scale"]
        labelled.append((schema, pattern, features, game if rng.random() < 0.8 else None, None, None))
    got = mined(spark, labelled)
    by_schema = {s.schema: s for s in STRATEGIES}
    sums = {}
    for schema, _, features, game, _, _ in labelled:
        if game is None or schema not in by_schema:
            continue
        for text in texts(features, by_schema[schema]):
            total = sums.setdefault((schema, text), [0, None, None])
            count, scale = game["game_activation_cnt"], game.get("game_day_1_scale")
            total[0] += count
            if scale is not None:
                total[1] = (total[1] or 0) + count
                total[2] = (total[2] or 0) + count * scale
    want = [
        (s, t, float(n), None if k is None else float(k), w / k if k else None)
        for (s, t), (n, k, w) in sums.items()
    ]
    names = ("game_activation_cnt", "game_day_1_activation_cnt", "game_day_1_scale")
    close(rows(got, "group_schema", "rule_condition", *names), want)


@pytest.mark.parametrize("seed", [4, 5, 6])
@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_match_equals_text_join(spark, monkeypatch, seed, broadcast):
    monkeypatch.setattr(R, "BROADCAST_CELLS", broadcast)
    rng = random.Random(seed)
    by_schema = {s.schema: s for s in STRATEGIES}
    known = sorted(
        {
            (s, t)
            for s, _, f in random_groups(seed + 10)
            if s in by_schema
            for t in texts(f, by_schema[s])
        }
    )
    chosen = rng.sample(known, 6) + [
        ("s,t", "3b >= 6.0"),  # not on the grid
        ("s,t", "c >= 5.0"),  # another feature
        ("s", "3b >= 5.0 and a >= 0.2 and c >= 1.0"),  # another order
        ("gone", "a >= 0.2"),
        ("s,t", "nonsense"),
    ]
    rules = spark.createDataFrame(chosen, "group_schema string, rule_condition string")
    groups = random_groups(seed)
    got = R.match_patterns(frame(spark, groups), rules, STRATEGIES)
    want = [
        (s, p)
        for s, p, f in [*groups, ("s", "broken", {})]
        if s in by_schema and any((s, t) in chosen for t in texts(f, by_schema[s]))
    ]
    assert rows(got, "group_schema", "group_pattern") == sorted(want)


def test_match_returns_each_group_once(spark):
    groups = frame(spark, [("s,t", "p", {"3b": 30})]).unionAll(frame(spark, [("s,t", "p", {"3b": 30})]))
    rules = spark.createDataFrame(
        [("s,t", "3b >= 5.0"), ("s,t", "3b >= 10.0")], "group_schema string, rule_condition string"
    )
    assert rows(R.match_patterns(groups, rules, STRATEGIES), "group_pattern") == [("p",)]


def test_targets_read_texts_as_numbers_and_drop_nulls(spark):
    strategies = spark.createDataFrame(
        [
            ("s", "r1", '{"ord_cnt": "35.0", "trust_fail_ratio": 0.9}'),
            ("s", "r2", '{"ord_cnt": 4, "trust_fail_ratio": 0.9}'),
            ("s", "r3", '{"ord_cnt": 100}'),
        ],
        "group_schema string, rule_condition string, ad_performance_json string",
    )
    got = R.good_rules(strategies, ("ord_cnt >= 30", F.col("trust_fail_ratio") >= 0.8))
    assert rows(got) == [("s", "r1")]
    with pytest.raises(ValueError):
        R.good_rules(strategies, ())


def test_performance_join_keeps_every_group(spark):
    names = "group_schema string, group_pattern string, feature_json string"
    groups = spark.createDataFrame([("s", "p", "{}"), ("s", "q", "{}")], names)
    label = spark.createDataFrame([("s", "p", '{"x": 1}'), ("s", "z", "{}")], names)
    joined = R.performance_join(groups, label, label.limit(0), label)
    assert rows(joined, "group_pattern", "game_json", "ug_json", "ecom_json") == [
        ("p", '{"x": 1}', None, '{"x": 1}'),
        ("q", None, None, None),
    ]
