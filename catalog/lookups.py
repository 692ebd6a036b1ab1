"""Sources, lookup joins, scalar functions."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.scalars import (
    clip_top,
    ip_prefix,
    json_number,
    json_texts,
    time_difference,
    transform,
)
from tallyward.operators.entity import entity_features
from tallyward.operators.joins import (
    cast_lookup,
    drop_listed,
    flag_join,
    keep_listed,
    tag_lookup,
)
from tallyward.plans.jobs import run_entity_features
from tallyward.plans.specs import DEVICE_CONVERT
from tallyward.sources.columns import CONVERT_WIDE_COLUMNS
from tallyward.sources.logs import (
    convert_events,
    convert_wide,
    requests,
    requests_flagged,
    risk_apps,
    risk_packages,
)

from .inputs import (
    ALL_HOURS,
    APPS_SQL,
    BLACK_SQL,
    DAY,
    LAST_DAY,
    LAST_HOUR,
    PACKAGES_SQL,
    REQUEST_SQL,
    app_status,
    black_hits,
    epoch,
    events,
    hourly,
    make_money_apps,
    request_log,
    sites,
    table,
    with_empty,
)
from .registry import ORACLE, SALTED, query, settle, settled, settled_sql


@query(
    "flag_join",
    """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN o.o_orderkey IS NOT NULL THEN 1 ELSE 0 END AS urgent_flag
FROM lineitem l LEFT JOIN
     (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') o
ON l.l_orderkey = o.o_orderkey
""",
)
def flagged_lines(spark: SparkSession, sf_dir: str, **skew: float | bool) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    keys = urgent.select(F.col("o_orderkey").alias("l_orderkey"))
    return flag_join(lines, keys, "l_orderkey", "urgent_flag", **skew)


@query(
    "min_tag_lookup",
    """
SELECT o_orderkey, o_custkey, coalesce(t.tag, 0) AS app_flag
FROM orders LEFT JOIN (
  SELECT key, min(tag) AS tag FROM (
    SELECT c_custkey AS key, 99999 AS tag FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION
    SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal > 5000 AND c_nationkey > 4
  ) GROUP BY key) t
ON o_custkey = t.key
""",
)
def min_tag(spark: SparkSession, sf_dir: str, **skew: float | bool) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").alias("o_custkey")
    tags = (
        customer.where(F.col("c_mktsegment") == "BUILDING")
        .select(key, F.lit(99999).alias("tag"))
        .union(
            customer.where((F.col("c_acctbal") > 5000) & (F.col("c_nationkey") > 4)).select(
                key, F.col("c_nationkey").alias("tag")
            )
        )
        .distinct()
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return tag_lookup(orders, tags, "o_custkey", "tag", "app_flag", **skew)


def _segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.where(F.col("c_mktsegment") == "MACHINERY").select(
        F.col("c_custkey").alias("o_custkey")
    )


_IN_SEGMENT = "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')"


@query(
    "semi_join_filter",
    f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN {_IN_SEGMENT}",
)
def semi(spark: SparkSession, sf_dir: str, **skew: float | bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return keep_listed(orders, _segment(spark, sf_dir), "o_custkey", **skew)


@query(
    "anti_join_filter",
    f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey NOT IN {_IN_SEGMENT}",
)
def anti(spark: SparkSession, sf_dir: str, **skew: float | bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return drop_listed(orders, _segment(spark, sf_dir), "o_custkey", **skew)


@query(
    "cast_lookup_join",
    """
SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'none' ELSE CAST(s_nationkey AS VARCHAR) END AS nation_text, n_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 0
""",
)
def cast_join(spark: SparkSession, sf_dir: str, **skew: float | bool) -> DataFrame:
    text = F.when(F.col("s_acctbal") < 0, "none").otherwise(F.col("s_nationkey").cast("string"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", text.alias("nation_text"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = cast_lookup(suppliers, nations, "nation_text", "n_nationkey", **skew)
    return joined.select("s_suppkey", "nation_text", "n_name")


# The same joins as they run beside lists too large to broadcast.
for _name, _plain, _function in (
    ("flag_join_salted", "flag_join", flagged_lines),
    ("tag_lookup_salted", "min_tag_lookup", min_tag),
    ("semi_join_salted", "semi_join_filter", semi),
    ("anti_join_salted", "anti_join_filter", anti),
    ("cast_lookup_salted", "cast_lookup_join", cast_join),
):
    query(_name, ORACLE[_plain])(partial(_function, **SALTED))


@query(
    "time_diffs",
    """
SELECT l_orderkey, l_linenumber,
       CAST(epoch(l_shipdate) - epoch(o_orderdate) AS BIGINT) AS ship_order_tdiff,
       CAST(trunc(l_extendedprice / 100000 / 0.1) AS BIGINT) AS tenth_bin
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
""",
)
def time_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        time_difference(epoch("l_shipdate"), epoch("o_orderdate")).alias("ship_order_tdiff"),
        (F.col("l_extendedprice") / 100000 / 0.1).cast("bigint").alias("tenth_bin"),
    )


@query(
    "ip_prefix",
    """
SELECT event_id, CASE WHEN event_type = 'view' THEN 'fe80::' || CAST(user_id AS VARCHAR)
                      WHEN event_type = 'click' THEN ''
                      WHEN event_type = 'error' THEN NULL
                      ELSE '10.' || CAST(user_id AS VARCHAR) || '.' || CAST(event_id AS VARCHAR) || '.1' END AS ip,
       CASE WHEN event_type = 'view' THEN 'fe80::' || CAST(user_id AS VARCHAR)
            WHEN event_type = 'click' THEN ''
            WHEN event_type = 'error' THEN NULL
            ELSE '10.' || CAST(user_id AS VARCHAR) || '.' || CAST(event_id AS VARCHAR) END AS ipc,
       CASE WHEN event_type = 'view' THEN 'fe80::' || CAST(user_id AS VARCHAR)
            WHEN event_type = 'click' THEN ''
            WHEN event_type = 'error' THEN NULL
            ELSE '10.' || CAST(user_id AS VARCHAR) END AS ipb
FROM events
""",
)
def ip_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    ip = (
        F.when(kind == "view", F.concat(F.lit("fe80::"), F.col("user_id")))
        .when(kind == "click", "")
        .when(kind == "error", F.lit(None))
        .otherwise(F.concat_ws(".", F.lit("10"), F.col("user_id"), F.col("event_id"), F.lit("1")))
    )
    rows = table(spark, sf_dir, "events").select("event_id", ip.alias("ip"))
    return rows.withColumns({"ipc": ip_prefix(F.col("ip"), 3), "ipb": ip_prefix(F.col("ip"), 2)})


@query(
    "json_extract",
    """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       CAST(NULL AS DOUBLE) AS absent
FROM events
""",
)
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = json_texts(F.col("props"), ("k", "absent"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        json_number(parsed, "k").alias("k"),
        json_number(parsed, "absent").alias("absent"),
    )


_WINDOW = (LAST_DAY, LAST_HOUR, ALL_HOURS)
_REQUEST_SHOWN = (
    "req_id",
    "union_imei",
    "site_id",
    "rit",
    "ip",
    "ipc",
    "union_imei_first_time_difference",
    "ad_source",
    "p_date",
    "hour",
)
_REQUEST_SHOWN_SQL = """request_id AS req_id, union_imei, site_id, rit, ip, ipc,
    union_imei_first_time_difference, ad_source, p_date, hour"""


@query("source_requests", f"SELECT {_REQUEST_SHOWN_SQL} FROM ({REQUEST_SQL})")
def source_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests(request_log(spark, sf_dir), *_WINDOW).select(*_REQUEST_SHOWN)


@query(
    "source_requests_flagged",
    f"""
SELECT {_REQUEST_SHOWN_SQL.replace("request_id", "r.request_id")},
       CASE WHEN b.request_id IS NOT NULL THEN 1 ELSE 0 END AS hit_black_device_flag
FROM ({REQUEST_SQL}) r LEFT JOIN ({BLACK_SQL}) b ON r.request_id = b.request_id
""",
)
def source_requests_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = black_hits(spark, sf_dir).withColumn("p_date", F.lit(LAST_DAY))
    rows = requests_flagged(request_log(spark, sf_dir), hits, *_WINDOW)
    return rows.select(*_REQUEST_SHOWN, "hit_black_device_flag")


@query(
    "source_convert_wide",
    """
SELECT CAST(event_id AS VARCHAR) AS req_id, 'u' || CAST(user_id AS VARCHAR) AS union_imei,
       event_type AS model, value AS battery_remaining_pct,
       strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour
FROM events
""",
)
def source_convert_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = hourly(table(spark, sf_dir, "events"), "date").withColumns(
        {
            "req_id": F.col("event_id").cast("string"),
            "union_imei": F.concat(F.lit("u"), F.col("user_id")),
            "model": F.col("event_type"),
            "battery_remaining_pct": F.col("value"),
        }
    )
    return convert_wide(with_empty(known, CONVERT_WIDE_COLUMNS), *_WINDOW).select(
        "req_id", "union_imei", "model", "battery_remaining_pct", "date", "hour"
    )


def _ad_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, sec = F.col("user_id"), F.col("sec")
    known = hourly(events(spark, sf_dir), "date").withColumns(
        {
            "advertiser_id": F.col("event_id"),
            "app_id": user,
            "union_uuid": F.concat(F.lit("u"), user % 60),
            "biz_line": F.when(F.col("value") > 2, "union").otherwise("feed"),
            "rit": F.lit(800000000) + user,
            "label": F.when(F.col("event_type") == "view", "click").otherwise("convert"),
            "ecpm": F.when(F.col("event_type") != "error", F.col("value") * 1000000),
            "at": sec.cast("string"),
            "ot": F.when(F.col("event_type") != "click", (sec - 90).cast("string")),
            "external_json": F.to_json(
                F.struct(
                    F.concat_ws(".", F.lit("10"), user % 256, user % 7, F.lit("9")).alias("client_ip"),
                    F.col("event_type").alias("device_model"),
                    F.col("event_id").alias("room_id"),
                    (sec - 30).alias("click_at"),
                )
            ),
        }
    )
    rest = (
        "app_name bill_type invalid_event req_id fraud_type external_action landing_type "
        "is_search is_reward_ads ac city_id pay_amount advertiser_first_industry_id "
        "advertiser_second_industry_id"
    ).split()
    return with_empty(known, rest)


_CONVERT_SQL = """
SELECT event_id AS advertiser_id, user_id AS app_id,
       'u' || CAST(user_id % 60 AS VARCHAR) AS union_imei,
       coalesce(t.app_type, 0) AS app_flag,
       '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(user_id % 7 AS VARCHAR) || '.9' AS ip,
       '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(user_id % 7 AS VARCHAR) AS ipc,
       '10.' || CAST(user_id % 256 AS VARCHAR) AS ipb,
       event_type AS device_model, CAST(event_id AS VARCHAR) AS room_id,
       sec - 30 AS click_time_timestamp, sec AS at_time_timestamp,
       CASE WHEN event_type <> 'click' THEN sec - 90 END AS send_time_timestamp,
       CASE WHEN event_type <> 'click' THEN CAST(60 AS BIGINT) END AS click_send_tdiff,
       CAST(30 AS BIGINT) AS convert_click_tdiff,
       CASE WHEN event_type <> 'click' THEN CAST(90 AS BIGINT) END AS convert_send_tdiff,
       ecpm / 100000 AS ecpm_rmb,
       CAST(trunc(ecpm / 100000 / 100) AS BIGINT) * 100 AS ecpm_bin,
       strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour
FROM (SELECT *, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS sec,
             CASE WHEN event_type <> 'error' THEN value * 1000000 ELSE 0 END AS ecpm FROM events) e
LEFT JOIN (
  SELECT app_id, min(app_type) AS app_type FROM (
    SELECT s_suppkey AS app_id, 99999 AS app_type FROM supplier WHERE s_acctbal > 8000
    UNION
    SELECT c_custkey, c_nationkey + 10 FROM customer
    WHERE c_acctbal > 0 AND c_nationkey + 10 IN (12, 42, 10003, 10004, 10005))
  GROUP BY app_id) t ON e.user_id = t.app_id
WHERE value > 2 AND user_id > 0 AND event_type <> 'view'
  AND user_id % 60 IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
"""


def _converts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    devices = customer.where(F.col("c_mktsegment") != "BUILDING").select(
        F.concat(F.lit("u"), F.col("c_custkey")).alias("union_imei"),
        F.lit(LAST_DAY).alias("p_date"),
        F.lit(LAST_HOUR).alias("hour"),
    )
    return convert_events(
        _ad_stats(spark, sf_dir),
        devices,
        make_money_apps(spark, sf_dir).withColumn("date", F.lit(LAST_DAY)),
        app_status(spark, sf_dir).withColumn("p_date", F.lit(LAST_DAY)),
        *_WINDOW,
    )


@query(
    "source_convert_events",
    f"SELECT * REPLACE ({settled_sql('ecpm_rmb')} AS ecpm_rmb) FROM ({_CONVERT_SQL})",
)
def source_convert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = _converts(spark, sf_dir).select(
        "advertiser_id", "app_id", "union_imei", "app_flag", "ip", "ipc", "ipb",
        "device_model", "room_id", "click_time_timestamp", "at_time_timestamp",
        "send_time_timestamp", "click_send_tdiff", "convert_click_tdiff",
        "convert_send_tdiff", "ecpm_rmb", "ecpm_bin", "date", "hour",
    )
    return settle(shown, "ecpm_rmb").withColumn("ecpm_bin", F.col("ecpm_bin").cast("bigint"))


def _device_sql() -> str:
    """All kinds of the device spec, the steps between events from a window."""
    known = "app_id <> 0 AND app_id <> -1"
    top = f"""
SELECT union_imei, sum(n) FILTER (WHERE rk = 1) / CAST(sum(n) AS DOUBLE) AS share FROM (
  SELECT union_imei, n, dense_rank() OVER (PARTITION BY union_imei ORDER BY n DESC, key DESC) AS rk
  FROM (SELECT union_imei, CAST(app_id AS VARCHAR) AS key, count(*) AS n
        FROM ({_CONVERT_SQL}) WHERE {known} GROUP BY union_imei, app_id))
GROUP BY union_imei
"""
    steps = f"""
SELECT union_imei, avg(iat) AS iat_avg, stddev_pop(iat) AS iat_std,
       count(*) FILTER (WHERE iat <= 30) / CAST(count(*) AS DOUBLE) AS iat_short
FROM (SELECT union_imei, least(3600, lead(at_time_timestamp) OVER (
        PARTITION BY union_imei ORDER BY at_time_timestamp) - at_time_timestamp) AS iat,
        lead(at_time_timestamp) OVER (PARTITION BY union_imei ORDER BY at_time_timestamp) AS following
      FROM ({_CONVERT_SQL})) WHERE following IS NOT NULL
GROUP BY union_imei
"""
    plain = f"""
SELECT union_imei, count(DISTINCT app_id) FILTER (WHERE {known}) AS apps, count(*) AS converts,
       count(*) FILTER (WHERE app_flag IN (12, 42)) / CAST(count(*) AS DOUBLE) AS risk,
       avg(least(ecpm_rmb, 5000)) FILTER (WHERE ecpm_rmb > 0) AS ecpm
FROM ({_CONVERT_SQL}) GROUP BY union_imei
"""
    features = (
        ("distinct_count", "device_all_app_distinct_cnt", "apps", plain),
        ("count", "device_all_convert_cnt", "converts", plain),
        ("ratio", "device_all_app_risk_ratio", "risk", plain),
        ("top_n_ratio", "device_all_app_top1_ratio", "share", top),
        ("stats", "device_all_ecpm_rmb_avg", "ecpm", plain),
        ("iat", "device_all_iat_avg", "iat_avg", steps),
        ("iat", "device_all_iat_std", "iat_std", steps),
        ("iat", "device_all_iat_le30s_ratio", "iat_short", steps),
    )
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS aggregator_type, 'union_imei' AS dkey, union_imei AS dval, "
        f"'{name}' AS fkey, {settled_sql(column)} AS fval FROM ({source})"
        for kind, name, column, source in features
    )


@query("device_convert_features", _device_sql())
def device_convert_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(entity_features(_converts(spark, sf_dir), DEVICE_CONVERT), "fval")


@query("job_entity_features", _device_sql())
def job_entity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same features by the job that users call."""
    long = run_entity_features(
        lambda *window: _converts(spark, sf_dir), DEVICE_CONVERT, LAST_DAY, LAST_HOUR, ALL_HOURS, "v1"
    )
    return settle(long, "fval")


@query("source_risk_apps", APPS_SQL)
def source_risk_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_apps(make_money_apps(spark, sf_dir), app_status(spark, sf_dir), DAY, (12, 42))


@query("source_risk_packages", PACKAGES_SQL)
def source_risk_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps = risk_apps(make_money_apps(spark, sf_dir), app_status(spark, sf_dir), DAY, (12, 42))
    return risk_packages(apps, sites(spark, sf_dir), DAY)


@query(
    "unary_transforms",
    f"""
SELECT event_id,
       {settled_sql("CASE WHEN value > 0 THEN ln(value) END")} AS value_log,
       {settled_sql("sqrt(value)")} AS value_sqrt,
       {settled_sql("CASE WHEN value >= 100 THEN 100 ELSE value END")} AS value_clipped
FROM events
""",
)
def unary_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        settled(transform("log", value)).alias("value_log"),
        settled(transform("sqrt", value)).alias("value_sqrt"),
        settled(clip_top(value, 100.0)).alias("value_clipped"),
    )
