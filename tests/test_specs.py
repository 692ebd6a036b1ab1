"""The ready-made specs run on logs with the source columns."""

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from tallyward.operators.entity import entity_features
from tallyward.operators.groups import group_features, to_feature_json
from tallyward.operators.merge import merge_wide
from tallyward.operators.rules import expand_rules, grid_table, match_patterns
from tallyward.plans import specs
from tallyward.sources.columns import CONVERT_EVENT_COLUMNS, CONVERT_WIDE_COLUMNS, REQUEST_COLUMNS


def log(spark, names, known):
    """Twelve rows with the named columns, NULL unless `known`."""
    df = spark.range(12).selectExpr("id", *[f"{e} AS {n}" for n, e in known.items()])
    return df.selectExpr(
        *[n if n in known else f"CAST(NULL AS STRING) AS {n}" for n in names]
    )


KNOWN = {
    "req_id": "concat('r', id)",
    "union_imei": "concat('d', id % 4)",
    "ad_source": "1",
    "site_id": "id % 2",
    "device_model": "concat('m', id % 3)",
    "final_decision": "id % 2",
    "antispam_list_rules": "IF(id % 4 = 0, 'X_DID', NULL)",
    "union_imei_first_time_difference": "id * 100000",
    "battery_remaining_pct": "CAST(id AS DOUBLE)",
}


@pytest.fixture(scope="module")
def requests(spark):
    known = {**KNOWN, "hit_black_device_flag": "CAST(id % 4 = 1 AS INT)"}
    return log(spark, [*REQUEST_COLUMNS, "hit_black_device_flag"], known)


def test_device_convert(spark):
    known = {
        "union_imei": "concat('d', id % 2)",
        "app_id": "id % 3",
        "app_flag": "IF(id % 3 = 1, 12, 0)",
        "ecpm_rmb": "CAST(id * 1000 AS DOUBLE)",
        "at_time_timestamp": "id * 20",
    }
    long = entity_features(log(spark, CONVERT_EVENT_COLUMNS, known), specs.DEVICE_CONVERT)
    spec = specs.device_convert_merge("v1")
    wide = {r.union_imei: r.asDict() for r in merge_wide(long, spec.features, spec.dkey).collect()}
    assert spec.kinds == ("count", "distinct_count", "ratio", "stats", "top_n_ratio", "iat")
    first = wide["d0"]
    assert first["device_all_app_distinct_cnt"] == 2.0
    assert first["device_all_app_risk_ratio"] == 0.3333
    assert first["device_all_app_top1_ratio"] == 0.5
    assert first["device_all_ecpm_rmb_avg"] == pytest.approx((2000 + 4000 + 5000 * 3) / 5)
    assert (first["device_all_iat_avg"], first["device_all_iat_le30s_ratio"]) == (40.0, 0.0)


@pytest.mark.parametrize("name", ["RESOURCE", "RESOURCE_V1", "RESOURCE_V3", "RESOURCE_V4"])
def test_request_groups_and_their_rules(spark, requests, name):
    spec, strategies = getattr(specs, name), getattr(specs, f"{name}_STRATEGIES")
    assert {s.schema for s in strategies} <= set(spec.schemas)
    assert {d.feature for s in strategies for d in s.grid} <= {f.name for f in spec.features}
    wide = group_features(requests, spec)
    assert plan_of(wide).count("Exchange hashpartitioning") == 2
    found = {r[0] for r in wide.select("group_schema").distinct().collect()}
    assert found == set(spec.schemas)
    assert grid_table(spark, strategies).count() == len(strategies)


def test_plain_groups(spark, requests):
    assert group_features(requests, specs.request_groups("plain")).count() == 8
    converts = log(spark, CONVERT_WIDE_COLUMNS, {n: e for n, e in KNOWN.items() if n in CONVERT_WIDE_COLUMNS})
    (row,) = group_features(converts, specs.convert_groups("c")).where(
        "group_schema LIKE '%rom_version' AND group_pattern = '1'"
    ).collect()
    assert (row.convert_cnt, row.battery_remaining_pt90, row.uimei_distinct_cnt) == (6, 11.0, 2)


def test_six_dimensions(spark, requests):
    """The widest grid: mining spreads cells, matching finds what it mined."""
    spec, strategies = specs.RESOURCE_V4, specs.RESOURCE_V4_STRATEGIES
    groups = to_feature_json(group_features(requests, spec)).where("group_pattern != ''").cache()
    rules = expand_rules(groups, strategies, {"n": F.count(F.lit(1))})
    best = rules.orderBy(F.desc("n"), "group_schema", "rule_condition").limit(1).cache()
    (rule,) = best.collect()
    hits = match_patterns(groups, best.select("group_schema", "rule_condition"), strategies)
    found = rows(hits, "group_schema", "group_pattern")
    assert len(found) == rule.n and {s for s, _ in found} == {rule.group_schema}
