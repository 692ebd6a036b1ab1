"""What the physical plans of the registered queries must and must not contain."""

import re

import pytest

import __spark_entry__  # noqa: F401 - registers the queries
from catalog.registry import QUERIES
from helpers import plan_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    return {n: plan_of(q(spark, SF)) for n, q in QUERIES.items()}


def test_no_python_and_no_products(plans):
    for name, plan in plans.items():
        assert "Python" not in plan and "Pandas" not in plan, name
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_plain_features_of_an_entity_take_one_scan(plans):
    for name in ("entity_count", "entity_ratio", "entity_stats_clip", "entity_pct"):
        assert plans[name].count("FileScan") == 1, name


def test_scans_read_only_what_is_used(plans):
    (schema,) = re.findall(r"ReadSchema: (\S+)", plans["entity_stats_clip"])
    assert schema == "struct<user_id:bigint,value:double>"


def test_filters_reach_the_scan(plans):
    assert "EqualTo(c_mktsegment,MACHINERY)" in plans["semi_join_filter"]
    assert "LeftSemi" in plans["semi_join_filter"] and "LeftAnti" in plans["anti_join_filter"]


def test_top_n_is_cut_before_entities_come_together(plans):
    assert "WindowGroupLimit" in plans["entity_top_n_ratio"]
    assert ", Partial" in plans["entity_top_n_ratio"]


def test_rules_parse_a_groups_json_once(plans):
    for name in ("rule_expand", "strategy_mining", "pattern_match"):
        assert "lambdafunction(from_json" not in plans[name].replace(" ", ""), name
        for call in re.findall(r"(?:transform|filter)\([^\n]*", plans[name]):
            assert "from_json" not in call.split("lambdafunction")[-1], name


def test_shuffle_partitions_follow_the_input():
    from tallyward.session import shuffle_settings

    def partitions(*args):
        return int(shuffle_settings(*args)["spark.sql.shuffle.partitions"])

    assert partitions(10**6) == 200
    assert partitions(10**6, 4000) == 8000
    assert 90_000 < partitions(100 * 10**12) < 95_000


def test_tasks_of_a_query_are_fitted_to_its_tables(spark, tmp_path, monkeypatch):
    from catalog import inputs
    from catalog.registry import QUERIES
    from tallyward import session

    assert [session.byte_size(t) for t in ("64MB", "16k", "134217728b", "7")] == [2**26, 2**14, 2**27, 7]
    keys = (
        "spark.sql.shuffle.partitions",
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    )
    kept = {k: spark.conf.get(k) for k in keys}
    monkeypatch.setattr(session, "FITTED_BYTES", 1024)
    try:
        plan = plan_of(QUERIES["group_patterns"](spark, "/root/testdata/sf0.01"))
        size = inputs.stored_bytes(spark, "/root/testdata/sf0.01/lineitem.parquet")
        partitions = -(-size // 1024)
        assert f", {partitions})" in plan
        assert int(spark.conf.get(keys[0])) == partitions > 8
        assert session.byte_size(spark.conf.get(keys[1])) == session.SCAN_BYTES
        assert session.byte_size(spark.conf.get(keys[2])) == session.MERGED_BYTES
        inputs.table(spark, "/root/testdata/sf0.01", "nation")
        assert int(spark.conf.get(keys[0])) == partitions
        session.fit_session(spark, 10**15)
        assert int(spark.conf.get(keys[0])) == -(-(10**15) // session.PARTITION_BYTES)
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
