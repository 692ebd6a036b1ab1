import json

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from tallyward.operators.features import (
    Count,
    DistinctCount,
    DistinctRatio,
    Percentile,
    Ratio,
    Stat,
)
from tallyward.operators.groups import GroupSpec, group_features, to_feature_json

FEATURES = (
    Count("n"),
    DistinctCount("devices", "device != ''", ("device",)),
    DistinctRatio("new_ratio", columns=("device",), top="age <= 3"),
    Ratio("young", top="age <= 3"),
    Stat("age_avg", True, "avg", "age", 10.0),
)


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(
        [
            ("s1", "c1", "d1", 1),
            ("s1", "c1", "d1", 30),
            ("s1", "c2", "d2", 9),
            ("s1", None, "", 2),
            (None, "c1", "d3", None),
        ],
        "site string, city string, device string, age int",
    )


def test_patterns_of_several_schemas(log):
    spec = GroupSpec("g", ("site", "site,city"), FEATURES)
    got = {(r[0], r[1]): tuple(r[2:]) for r in group_features(log, spec).collect()}
    assert got[("site", "s1")] == (4, 2, pytest.approx(2 / 3), 0.5, pytest.approx(22 / 4))
    assert got[("site", "")] == (1, 1, 0.0, 0.0, None)
    assert got[("site,city", "s1|c1")] == (2, 1, 1.0, 0.5, 5.5)
    assert got[("site,city", "s1")] == (1, 0, 1.0, 1.0, 2.0)  # NULL city is skipped
    assert got[("site,city", "c1")] == (1, 1, 0.0, 0.0, None)
    assert len(got) == 6


def test_explode_equals_one_aggregation_per_schema(log):
    schemas = ("site", "city,device", "site,city,device")
    got = group_features(log, GroupSpec("g", schemas, FEATURES[:2]))
    want = []
    for schema in schemas:
        text = F.concat_ws("|", *schema.split(","))
        per = log.groupBy(text.alias("p")).agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct(F.when(F.col("device") != "", F.col("device"))).alias("k"),
        )
        want += [(schema, *r) for r in rows(per)]
    assert rows(got) == sorted(want, key=repr)


def test_features_that_cannot_merge_get_their_own_branch(log):
    features = (
        *FEATURES,
        Percentile("age_p50", True, 0.5, "age"),
        Stat("age_std", True, "stddev_pop", "age"),
        DistinctCount("cities", "city IS NOT NULL", ("city",)),
    )
    wide = group_features(log, GroupSpec("g", ("site",), features))
    got = {r["group_pattern"]: r.asDict() for r in wide.collect()}
    assert wide.columns == ["group_schema", "group_pattern", *[f.name for f in features]]
    assert got["s1"]["n"] == 4 and got["s1"]["age_p50"] == 2 and got["s1"]["cities"] == 2
    assert got[""]["age_std"] is None


def test_source_condition_and_digit_names(log):
    spec = GroupSpec("g", ("site",), (DistinctRatio("3d_ratio", columns=("device",), top="age <= 3"),), "device != ''")
    (row,) = group_features(log, spec).where("group_pattern = 's1'").collect()
    assert row["3d_ratio"] == 0.5


def test_json_leaves_nulls_out(log):
    wide = group_features(log, GroupSpec("g", ("site",), FEATURES))
    got = {r.group_pattern: json.loads(r.feature_json) for r in to_feature_json(wide).collect()}
    assert "age_avg" not in got[""] and got["s1"]["n"] == 4


def test_distinct_features_of_a_key_share_one_pass(log):
    features = tuple(
        DistinctRatio(f"r{i}", columns=("device",), top=f"age <= {i}") for i in range(6)
    )
    plan = plan_of(group_features(log, GroupSpec("g", ("site", "city"), (*features, Count("n")))))
    assert "Expand" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
