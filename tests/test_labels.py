import pytest

from tallyward.operators.labels import order_labels, retention_labels

ACTIVATIONS = "req_id string, retention_day double, stay_time double, union_baseline_active_ratio double, union_baseline_1800_ratio double"


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame(
        [("r1", "s1", "d1"), ("r2", "s1", "d2"), ("r3", "s1", None), ("r4", "s2", "d1"), (None, "s2", "d9")],
        "request_id string, site string, union_imei string",
    )


def test_retention(spark, requests):
    activations = spark.createDataFrame(
        [
            ("r1", 0.0, 1900.0, 0.5, 0.5),
            ("r1", 0.0, 100.0, None, 0.5),
            ("r2", 4.0, 2000.0, 0.5, 0.25),
            ("r2", 40.0, 2000.0, 0.5, 0.25),
            ("r3", 0.0, 2000.0, 0.5, None),
            ("r4", 1.0, 2000.0, 0.5, 0.0),
            ("r4", None, 2000.0, 0.5, 0.5),
            (None, 0.0, 2000.0, 0.5, 0.5),
            ("r9", 0.0, 2000.0, 0.5, 0.5),
        ],
        ACTIVATIONS,
    )
    labels = retention_labels(activations, requests, ("site",), "game")
    got = {r.group_pattern: r.asDict() for r in labels.collect()}
    assert set(got) == {"s1", "s2"}
    s1, s2 = got["s1"], got["s2"]
    assert s1["game_uimei_cnt"] == 2  # NULL devices are not counted
    assert s1["game_activation_cnt"] == 2
    assert s1["game_day_0_scale"] == pytest.approx(2.0 / 2)
    assert s1["game_day_1_scale"] is None
    assert s1["game_day_3_10_scale"] == 4.0
    assert s1["game_day_3_30_scale"] == 4.0
    assert s1["game_day_1_30_scale"] == 4.0  # day 40 counts: no upper limit
    assert s2["game_activation_cnt"] == 0
    assert s2["game_day_1_scale"] == 0.0  # the term 1 / 0 is skipped
    assert s2["game_day_2_scale"] is None


def test_repeated_request_ids_count_every_pair(spark):
    requests = spark.createDataFrame(
        [("", "s1", f"d{i % 3}") for i in range(50)], "request_id string, site string, union_imei string"
    )
    activations = spark.createDataFrame([("", 0.0, 2000.0, 0.5, 0.5)] * 40, ACTIVATIONS)
    (row,) = retention_labels(activations, requests, ("site",), "ug").collect()
    assert row.ug_activation_cnt == 50 * 40
    assert row.ug_uimei_cnt == 3
    assert row.ug_day_0_scale == 2.0


def test_orders(spark, requests):
    orders = spark.createDataFrame(
        [
            ("r1", "o1", 100.0, 1.0, 0.0, 1.0),
            ("r1", None, 30.0, 0.0, 1.0, 0.0),
            ("r2", "o3", 20.0, 0.0, 1.0, 0.0),
            ("r2", "o4", None, 1.0, 0.0, None),
            ("r4", "o5", 1.0, 1.0, 0.0, 0.0),
        ],
        "request_id string, order_id string, create_order_amount double, is_pay double, is_fail double, is_reliable double",
    )
    got = {r.group_pattern: r.asDict() for r in order_labels(orders, requests, ("site",)).collect()}
    s1, s2 = got["s1"], got["s2"]
    assert (s1["ord_cnt"], s1["unpay_cnt"], s1["fail_cnt"], s1["re_cnt"]) == (4, 2, 2, 1)
    assert (s1["unpay_ratio"], s1["sum_order_amount"]) == (0.5, 150.0)
    assert s1["trust_ord_cnt"] == 1  # an order without id is not counted
    assert (s1["trust_sum_order_amount"], s1["trust_unpay_cnt"]) == (130.0, 1.0)
    assert s1["trust_fail_ratio"] == 1.0
    assert (s2["trust_ord_cnt"], s2["trust_fail_ratio"]) == (0, None)
