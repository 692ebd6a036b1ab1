import json

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from tallyward.functions.predicates import trailing_window
from tallyward.functions.scalars import ecpm_bin, ip_prefix, transform
from tallyward.operators.joins import cast_lookup, drop_listed, flag_join, keep_listed, tag_lookup
from tallyward.sources import logs, performance
from tallyward.sources.columns import (
    CONVERT_EVENT_COLUMNS,
    CONVERT_WIDE_COLUMNS,
    REQUEST_COLUMNS,
    UNFLAGGED_ONLY,
)

DAY, HOUR = "20240102", "01"


def with_empty(df, names):
    return df.selectExpr("*", *[f"CAST(NULL AS STRING) {n}" for n in names if n not in df.columns])


def test_column_lists():
    assert [len(c) for c in (CONVERT_EVENT_COLUMNS, CONVERT_WIDE_COLUMNS, REQUEST_COLUMNS)] == [36, 82, 93]
    for names in (CONVERT_EVENT_COLUMNS, CONVERT_WIDE_COLUMNS, REQUEST_COLUMNS):
        assert len(set(names)) == len(names)
    assert set(UNFLAGGED_ONLY) < set(REQUEST_COLUMNS)


@pytest.mark.parametrize(
    "ip, three, two",
    [
        ("1.2.3.4", "1.2.3", "1.2"),
        ("::1", "::1", "::1"),
        ("", "", ""),
        (None, None, None),
        ("1.2.3", "1.2.3", "1.2.3"),
    ],
)
def test_ip_prefix(spark, ip, three, two):
    df = spark.createDataFrame([(ip,)], "ip string")
    got = df.select(ip_prefix(F.col("ip"), 3), ip_prefix(F.col("ip"), 2)).collect()
    assert tuple(got[0]) == (three, two)


def test_price_bins(spark):
    df = spark.createDataFrame([(None,), (25000000.0,), (99999.0,)], "e double")
    assert [r[0] for r in df.select(ecpm_bin(F.col("e"))).collect()] == [0, 200, 0]


def test_log_of_zero_is_null(spark):
    df = spark.createDataFrame([(0.0,)], "v double")
    assert df.select(transform("log", F.col("v"))).collect()[0][0] is None


HOURS = [("20240101", "2"), ("20240101", "03"), ("20240101", "23"), ("20240102", "00"), ("20240102", "1"), ("20240102", "02")]


@pytest.mark.parametrize("hours, want", [(1, 1), (2, 2), (3, 3), (23, 4), (24, 5), (100, 5)])
def test_trailing_window(spark, hours, want):
    df = spark.createDataFrame(HOURS, "date string, hour string")
    assert df.where(trailing_window(DAY, "1", hours)).count() == want


def test_trailing_window_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([(*h, i) for i, h in enumerate(HOURS)], "p_date string, hour string, n int")
    df.write.partitionBy("p_date", "hour").parquet(str(tmp_path / "log"))
    log = spark.read.schema("n int, p_date string, hour string").parquet(str(tmp_path / "log"))
    got = log.where(trailing_window(DAY, HOUR, 2, date_col="p_date"))
    assert got.count() == 2
    plan = plan_of(got.select("n"))
    assert "Filter" not in plan.split("FileScan")[0]
    assert "unix_timestamp" in plan.split("PartitionFilters")[1]


def test_window_needs_an_hour():
    with pytest.raises(ValueError):
        trailing_window(DAY, HOUR, 0)


@pytest.fixture(scope="module")
def request_log(spark):
    df = spark.createDataFrame(
        [
            ("r1", "1.2.3.4", "d1", DAY, "01"),
            ("r2", None, "d2", DAY, "01"),
            (None, "::1", "d3", DAY, "00"),
            ("r4", "1.1.1.1", "d4", "20240101", "00"),
        ],
        "request_id string, ip string, union_imei string, p_date string, hour string",
    )
    return with_empty(df, [c for c in REQUEST_COLUMNS if c not in ("req_id", "ipc")])


def test_requests(request_log):
    got = logs.requests(request_log, DAY, HOUR, 2)
    assert got.columns == REQUEST_COLUMNS
    assert rows(got, "req_id", "ipc") == [("r1", "1.2.3"), ("r2", None), (None, "::1")]


def test_flagged_requests(spark, request_log):
    hits = spark.createDataFrame(
        [("r1", "7", DAY), ("r1", "8", DAY), ("r2", "0", DAY), ("r2", "900001", DAY), ("r2", None, DAY), (None, "7", DAY), ("r2", "7", "20240101")],
        "request_id string, hit_policy string, p_date string",
    )
    got = logs.requests_flagged(request_log, hits, DAY, HOUR, 2)
    assert rows(got, "req_id", "hit_black_device_flag") == [("r1", 1), ("r2", 0), (None, 0)]
    want = [c for c in REQUEST_COLUMNS if c not in UNFLAGGED_ONLY]
    assert [c for c in got.columns if c != "hit_black_device_flag"] == want
    assert len(got.columns) == 89


def test_day_requests(request_log):
    assert rows(logs.day_requests(request_log, "20240101"), "request_id", "ipc") == [("r4", "1.1.1")]


def test_convert_wide(spark):
    log = with_empty(
        spark.createDataFrame([("r1", DAY, "01"), ("r2", DAY, "02")], "req_id string, date string, hour string"),
        CONVERT_WIDE_COLUMNS,
    )
    got = logs.convert_wide(log, DAY, HOUR, 1)
    assert got.columns == CONVERT_WIDE_COLUMNS and rows(got, "req_id") == [("r1",)]


def app_tables(spark):
    money = spark.createDataFrame(
        [(1, "网赚应用", DAY), (1, "网赚应用", DAY), (2, "other", DAY), (3, "网赚应用", "20240101")],
        "site_id bigint, first_tag_name string, date string",
    )
    status = spark.createDataFrame(
        [
            (1, 12, "true", DAY, "01"),
            (4, 42, "true", DAY, "00"),
            (5, 10003, "true", DAY, "01"),
            (6, 12, "false", DAY, "01"),
            (7, 99, "true", DAY, "01"),
        ],
        "app_id bigint, disposal_tag int, is_effective string, p_date string, hour string",
    )
    return money, status


def test_risk_apps(spark):
    money, status = app_tables(spark)
    assert rows(logs.risk_apps(money, status, DAY, (12, 42))) == [("1", 12), ("1", 99999), ("4", 42)]
    got = logs.risk_apps(money, status, DAY, (12, 42, 10003), hour="01")
    assert rows(got) == [("1", 12), ("1", 99999), ("5", 10003)]


def test_risk_packages(spark):
    money, status = app_tables(spark)
    apps = logs.risk_apps(money, status, DAY, (12, 42)).union(
        spark.createDataFrame([("not a number", 1)], "app_id string, app_type int")
    )
    sites = spark.createDataFrame(
        [(1, "p", DAY), (4, "p", DAY), (4, "q", "20240101"), (9, "z", DAY)],
        "site_id bigint, package_name string, p_date string",
    )
    assert rows(logs.risk_packages(apps, sites, DAY)) == [("p",)]


def test_convert_events(spark):
    extra = json.dumps({"client_ip": "9.8.7.6", "device_model": "m", "room_id": 5, "click_at": "70"})
    stats = spark.createDataFrame(
        [
            ("d1", 1, "union", 800000001, "convert", 25000000.0, "100", "60", extra, DAY, "01"),
            ("d1", 9, "union", 800000001, "convert", None, "100", None, None, DAY, "00"),
            ("d1", 1, "union", 800000000, "convert", 1.0, "1", "1", extra, DAY, "01"),
            ("d1", 1, "feed", 800000001, "convert", 1.0, "1", "1", extra, DAY, "01"),
            ("d1", 1, "union", 800000001, "click", 1.0, "1", "1", extra, DAY, "01"),
            ("d2", 1, "union", 800000001, "convert", 1.0, "1", "1", extra, DAY, "01"),
        ],
        "union_uuid string, app_id bigint, biz_line string, rit bigint, label string, ecpm double, at string, ot string, external_json string, date string, hour string",
    )
    made = {"app_flag", "union_imei", "ip", "ipc", "ipb", "device_model", "room_id", "ecpm_rmb", "ecpm_bin"}
    made |= {c for c in CONVERT_EVENT_COLUMNS if c.endswith(("_timestamp", "_tdiff"))}
    stats = with_empty(stats, [c for c in CONVERT_EVENT_COLUMNS if c not in made])
    devices = spark.createDataFrame(
        [("d1", DAY, "01"), ("d1", DAY, "01"), ("d2", DAY, "00")], "union_imei string, p_date string, hour string"
    )
    got = logs.convert_events(stats, devices, *app_tables(spark), DAY, HOUR, 2)
    assert got.columns == CONVERT_EVENT_COLUMNS
    found = {r.app_id: r.asDict() for r in got.collect()}
    assert set(found) == {1, 9} and got.count() == 2  # a device listed twice counts once
    first = found[1]
    assert (first["app_flag"], found[9]["app_flag"]) == (12, 0)
    assert (first["ipc"], first["ipb"], first["room_id"]) == ("9.8.7", "9.8", "5")
    assert (first["click_send_tdiff"], first["convert_click_tdiff"], first["convert_send_tdiff"]) == (10, 30, 40)
    assert (first["ecpm_rmb"], first["ecpm_bin"]) == (250.0, 200)
    assert (found[9]["click_send_tdiff"], found[9]["ecpm_rmb"], found[9]["ip"]) == (None, 0.0, None)


def performance_table(spark, date_name, data):
    return spark.createDataFrame(
        [(json.dumps(f), json.dumps(e), d) for f, e, d in data],
        f"feature_json string, extra_json string, {date_name} string",
    )


def test_order_rows(spark):
    table = performance_table(
        spark,
        "p_date",
        [
            ({"create_order_amount": "35.5", "is_pay": 1}, {"rit": "800000000", "req_id": "r1", "order_id": "o"}, DAY),
            ({"create_order_amount": 1}, {"rit": "799999999", "req_id": "r2"}, DAY),
            ({"create_order_amount": 1}, {"rit": "x", "req_id": "r3"}, DAY),
            ({"create_order_amount": 1}, {"rit": "800000000", "req_id": "r4"}, "20240101"),
        ],
    )
    got = performance.order_rows(table, DAY)
    assert rows(got, "request_id", "create_order_amount", "is_pay", "is_fail") == [("r1", 35.5, 1.0, None)]


def test_user_growth_and_game_rows(spark):
    def row(app, name, package):
        extra = {"app_id": app, "ad_app_name": name, "ad_package_name": package, "req_id": f"{app}{name}{package}", "retention_day": "3"}
        return {"stay_time": "1900.5", "union_baseline_1800_ratio": 0.5}, extra, DAY

    table = performance_table(
        spark, "date", [row("1", "news", "p"), row("1", "game", "q"), row("2", "news", "q"), row("4", "video", None)]
    )
    money, status = app_tables(spark)
    got = performance.user_growth_rows(table, money, status, DAY, ("news", "video"))
    assert rows(got, "req_id", "retention_day", "stay_time") == [("1newsp", 3.0, 1900.5), ("4videoNone", 3.0, 1900.5)]
    sites = spark.createDataFrame([(1, "p", DAY)], "site_id bigint, package_name string, p_date string")
    got = performance.game_rows(table, money, status, sites, DAY)
    assert rows(got, "req_id") == [("1gameq",), ("2newsq",), ("4videoNone",)]


def test_lookup_joins(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "k int, v string")
    listed = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(flag_join(left, listed, "k", "f"), "v", "f") == [("a", 1), ("b", 0), ("c", 0), ("d", 1)]
    assert rows(keep_listed(left, listed, "k"), "v") == [("a",), ("d",)]
    assert rows(drop_listed(left, listed, "k"), "v") == [("b",), ("c",)]
    tags = spark.createDataFrame([(1, 9), (1, 4), (3, 1)], "k int, tag int")
    assert rows(tag_lookup(left, tags, "k", "tag", "t"), "v", "t") == [("a", 4), ("b", 0), ("c", 0), ("d", 4)]
    texts = spark.createDataFrame([("1",), ("01",), ("x",), (None,)], "t string")
    dim = spark.createDataFrame([(1, "one")], "id bigint, name string")
    assert rows(cast_lookup(texts, dim, "t", "id"), "t", "name") == [("01", "one"), ("1", "one")]
