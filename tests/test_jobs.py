"""The whole chain through tables on disk."""

import json

import pytest

from helpers import rows
from tallyward.operators.entity import Entity, FeatureGroup
from tallyward.operators.features import Count, DistinctCount, DistinctRatio, TopNRatio
from tallyward.operators.groups import GroupSpec
from tallyward.operators.iat import IatKey, IatStat, IatStep, InterArrival
from tallyward.operators.merge import MergedFeature
from tallyward.operators.rules import GridDim, Strategy
from tallyward.plans import jobs
from tallyward.sources import tables as S

DAY = "20240102"


@pytest.fixture(scope="module")
def log(spark):
    data = [
        (f"r{i}", f"d{i % 6}", "s1" if i % 3 else "s2", f"c{i % 2}", i, DAY, f"{i % 24:02d}")
        for i in range(60)
    ]
    return spark.createDataFrame(
        data, "request_id string, union_imei string, site string, city string, t bigint, date string, hour string"
    )


def test_entity_features_then_merge(spark, log, tmp_path):
    arrival = InterArrival(("t",), (IatKey("t", (IatStep("minus", (IatStat("gap", "avg"),)),)),))
    group = FeatureGroup(
        "devices",
        (
            Entity(
                ("union_imei",),
                (
                    Count("n"),
                    DistinctCount("sites", columns=("site",)),
                    TopNRatio("top1", True, ("city",), 1),
                ),
                (arrival,),
            ),
        ),
    )
    table, text, wide_path = (str(tmp_path / n) for n in ("long", "text", "wide"))
    for stage in (False, True):
        jobs.run_entity_features(
            lambda *window: log, group, DAY, "23", 24, "v1", table, stage
        )
    spec = jobs.MergeSpec(
        "devices",
        "union_imei",
        group.kinds,
        "v1",
        (MergedFeature("n"), MergedFeature("sites"), MergedFeature("top1"), MergedFeature("gap"), MergedFeature("gone", 0.5)),
        population=True,
    )
    wide, stats = jobs.run_merge(spark, table, spec, DAY, "23", wide_path, text)
    want = [(f"d{i}", 10.0, 1.0, 1.0, 6.0, 0.5) for i in range(6)]
    assert rows(wide) == want
    names = "union_imei string, n double, sites double, top1 double, gap double, gone double"
    written = S.read_table(spark, wide_path, S.Table(names, ("date", "hour")), {"date": DAY})
    assert rows(written, *wide.columns) == want
    lines = [r[0] for r in spark.read.text(f"{text}/feature/devices/v1/{DAY}/23").collect()]
    assert sorted(lines)[0] == "d0,10.0,1.0,1.0,6.0,0.5"
    assert {r.fkey: (r.avg_value, r.std_value) for r in stats.collect()}["gap"] == (6.0, 0.0)
    assert spark.read.text(f"{text}/population_stats/devices/v1/{DAY}/23").count() == 5


def test_groups_labels_rules_and_match(spark, log, tmp_path):
    schemas = ("site", "site,city")
    spec = GroupSpec(
        "REQ",
        schemas,
        (
            Count("req_cnt"),
            DistinctRatio("3d_new", columns=("union_imei",), top="t < 3"),
        ),
        "request_id != ''",
    )
    paths = {n: str(tmp_path / n) for n in ("groups", "game", "ug", "ecom", "rules", "hits")}
    jobs.run_group_features(lambda *window: log, spec, DAY, "23", 24, paths["groups"])

    activations = spark.createDataFrame(
        [(f"r{i}", 0.0, 2000.0, 0.5, 0.5) for i in range(40)],
        "req_id string, retention_day double, stay_time double, union_baseline_active_ratio double, union_baseline_1800_ratio double",
    )
    orders = spark.createDataFrame(
        [(f"r{i}", f"o{i}", 25.0, 1.0, 1.0, 0.0) for i in range(30)],
        "request_id string, order_id string, create_order_amount double, is_pay double, is_fail double, is_reliable double",
    )
    labels = jobs.Performance(paths["game"], paths["ug"], paths["ecom"])
    jobs.run_performance_labels(
        jobs.Performance(activations, activations.limit(0), orders), log, schemas, DAY, "REQ", labels
    )
    strategies = (
        Strategy("site", (GridDim("req_cnt", 10, 40, 10), GridDim("3d_new", 0.1, 0.5, 0.2))),
        Strategy("site,city", (GridDim("req_cnt", 5, 15, 5),)),
    )
    for _ in range(2):
        jobs.run_mining(spark, paths["groups"], labels, strategies, DAY, "REQ", paths["rules"])
    rules = S.read_strategies(spark, paths["rules"], DAY, "REQ")
    found = {(r[0], r[1]): json.loads(r[2]) for r in rules.collect()}
    # site s1 holds 40 requests of devices d1, d2, d4, d5, two of them new.
    assert found[("site", "req_cnt >= 40.0 and 3d_new >= 0.5")]["ord_cnt"] == 20.0
    assert found[("site", "req_cnt >= 10.0 and 3d_new >= 0.1")]["ord_cnt"] == 30.0
    assert "ug_activation_cnt" not in found[("site", "req_cnt >= 10.0 and 3d_new >= 0.1")]

    hits = jobs.run_match(
        spark,
        paths["groups"],
        paths["rules"],
        strategies,
        ("ord_cnt >= 25", "trust_fail_ratio >= 0.9", "game_activation_cnt >= 10"),
        DAY,
        DAY,
        "REQ",
        paths["hits"],
    )
    want = [("site", "s1"), ("site", "s2"), ("site,city", "s1|c0"), ("site,city", "s1|c1"), ("site,city", "s2|c0"), ("site,city", "s2|c1")]
    assert rows(hits, "group_schema", "group_pattern") == want
    stored = S.read_table(spark, paths["hits"], S.ANOMALY_PATTERNS, {"date": DAY, "version": "REQ"})
    assert rows(stored, "group_schema", "group_pattern") == want
