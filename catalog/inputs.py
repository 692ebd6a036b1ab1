"""Logs and side tables shaped like the engine's inputs, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.constants import MAKE_MONEY_FIRST_TAG
from tallyward.functions.scalars import json_number, json_texts
from tallyward.operators.skew import skew_join
from tallyward.session import fit_session
from tallyward.sources.columns import REQUEST_COLUMNS
from tallyward.sources.tables import stored_bytes

# The label jobs work on one day; the derived tables carry this one throughout.
DAY = "20240131"
# The hour and length of a window that holds every event.
LAST_DAY, LAST_HOUR, ALL_HOURS = "20241231", "23", 24 * 400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; the session's tasks are fitted to its size."""
    path = f"{sf_dir}/{name}.parquet"
    fit_session(spark, stored_bytes(spark, path))
    return spark.read.parquet(path)


def epoch(name: str) -> Column:
    """Seconds since 1970 of a timestamp without zone, in any session zone."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {name})")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with epoch seconds."""
    return table(spark, sf_dir, "events").withColumn("sec", epoch("ts"))


def _k() -> Column:
    return json_number(json_texts(F.col("props"), ["k"]), "k").cast("bigint")


def hourly(df: DataFrame, date_name: str) -> DataFrame:
    return df.withColumns(
        {date_name: F.date_format("ts", "yyyyMMdd"), "hour": F.date_format("ts", "HH")}
    )


def with_empty(df: DataFrame, names: list[str]) -> DataFrame:
    """Add the named columns that are not there yet, all NULL."""
    rest = [n for n in names if n not in df.columns]
    return df.selectExpr("*", *[f"CAST(NULL AS STRING) AS {n}" for n in rest])


def request_log(spark: SparkSession, sf_dir: str, when: str = "true") -> DataFrame:
    """Events as raw requests: device, site, model, address and so on."""
    known = hourly(table(spark, sf_dir, "events").where(when), "p_date").withColumns(
        {
            "request_id": F.col("event_id").cast("string"),
            "union_imei": F.concat(F.lit("u"), F.col("user_id")),
            "site_id": _k(),
            "city_id": F.col("user_id") % 11,
            "device_model": F.col("event_type"),
            "os_type": F.concat(F.lit("os"), F.col("user_id") % 3),
            "ip": F.concat_ws(".", F.lit("10"), F.col("user_id") % 256, _k(), F.lit("9")),
            "rit": F.lit(800000000) + F.col("user_id"),
            "union_imei_first_time_difference": (F.col("value") * 10000).cast("bigint"),
            "ad_source": F.when(F.col("event_type") == "signup", 2).otherwise(1),
            "final_decision": F.when(F.col("value") > 60, 0).otherwise(1),
            "antispam_list_rules": F.when(
                F.col("event_type") == "error", "LIST_UIMEI"
            ).when(F.col("event_type") == "click", "OTHER"),
        }
    )
    return with_empty(known, [c for c in REQUEST_COLUMNS if c not in ("req_id", "ipc")])


REQUEST_SQL = """
SELECT CAST(event_id AS VARCHAR) AS request_id,
       'u' || CAST(user_id AS VARCHAR) AS union_imei,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS site_id,
       user_id % 11 AS city_id,
       event_type AS device_model,
       'os' || CAST(user_id % 3 AS VARCHAR) AS os_type,
       '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || json_extract_string(props, '$.k') || '.9' AS ip,
       '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || json_extract_string(props, '$.k') AS ipc,
       800000000 + user_id AS rit,
       CAST(trunc(value * 10000) AS BIGINT) AS union_imei_first_time_difference,
       CASE WHEN event_type = 'signup' THEN 2 ELSE 1 END AS ad_source,
       CASE WHEN value > 60 THEN 0 ELSE 1 END AS final_decision,
       CASE WHEN event_type = 'error' THEN 'LIST_UIMEI' WHEN event_type = 'click' THEN 'OTHER' END AS antispam_list_rules,
       strftime(ts, '%Y%m%d') AS p_date,
       strftime(ts, '%H') AS hour
FROM events
"""


def black_hits(spark: SparkSession, sf_dir: str, when: str = "true") -> DataFrame:
    """Policy hits: costly events, those of type view only by a passing policy."""
    return (
        table(spark, sf_dir, "events")
        .where(when)
        .where(F.col("value") > 100)
        .select(
            F.col("event_id").cast("string").alias("request_id"),
            F.when(F.col("event_type") == "view", "900001")
            .when(F.col("event_type") != "click", "1001")
            .alias("hit_policy"),
            F.lit(DAY).alias("p_date"),
        )
    )


BLACK_SQL = """
SELECT DISTINCT CAST(event_id AS VARCHAR) AS request_id FROM events
WHERE value > 100 AND event_type NOT IN ('view', 'click')
"""


def make_money_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("site_id"),
        F.when(F.col("s_acctbal") > 8000, MAKE_MONEY_FIRST_TAG)
        .otherwise("other")
        .alias("first_tag_name"),
        F.lit(DAY).alias("date"),
    )


def app_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("app_id"),
        (F.col("c_nationkey") + 10).alias("disposal_tag"),
        F.when(F.col("c_acctbal") > 0, "true").otherwise("false").alias("is_effective"),
        F.lit(DAY).alias("p_date"),
        F.lit("23").alias("hour"),
    )


APPS_SQL = """
SELECT CAST(s_suppkey AS VARCHAR) AS app_id, 99999 AS app_type FROM supplier WHERE s_acctbal > 8000
UNION
SELECT CAST(c_custkey AS VARCHAR), c_nationkey + 10 FROM customer
WHERE c_acctbal > 0 AND c_nationkey + 10 IN (12, 42)
"""


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("site_id"),
        F.concat(F.lit("pkg"), F.col("p_size")).alias("package_name"),
        F.lit(DAY).alias("p_date"),
    )


PACKAGES_SQL = f"""
SELECT DISTINCT 'pkg' || CAST(p.p_size AS VARCHAR) AS package_name
FROM part p JOIN (SELECT DISTINCT app_id FROM ({APPS_SQL})) a
ON CAST(a.app_id AS BIGINT) = p.p_partkey
"""


def activations(spark: SparkSession, sf_dir: str, when: str = "true") -> DataFrame:
    """Each event as an activation, retained since its user's first event."""
    rows = table(spark, sf_dir, "events").where(when)
    first = rows.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    user = F.col("user_id")
    active = F.when(user % 5 != 0, F.lit(0.5))
    baseline = F.when(user % 13 == 0, F.lit(0.0)).when(
        user % 7 != 0, F.lit(0.25) + (user % 3) * F.lit(0.125)
    )
    return skew_join(rows, first, ["user_id"], "inner").select(
        F.lit(DAY).alias("date"),
        F.to_json(
            F.struct(
                (F.col("value") * 100).alias("stay_time"),
                active.alias("union_baseline_active_ratio"),
                baseline.alias("union_baseline_1800_ratio"),
            )
        ).alias("feature_json"),
        F.to_json(
            F.struct(
                user.cast("string").alias("app_id"),
                F.col("event_type").alias("ad_app_name"),
                (F.lit(800000000) + user).alias("rit"),
                F.concat(F.lit("pkg"), _k()).alias("ad_package_name"),
                F.concat(F.lit("u"), user).alias("union_imei"),
                F.col("event_id").cast("string").alias("req_id"),
                F.datediff("ts", "first_ts").alias("retention_day"),
            )
        ).alias("extra_json"),
    )


ACTIVATIONS_SQL = """
SELECT CAST(e.event_id AS VARCHAR) AS req_id,
       CAST(e.user_id AS VARCHAR) AS app_id,
       e.event_type AS ad_app_name,
       'pkg' || json_extract_string(e.props, '$.k') AS ad_package_name,
       date_diff('day', f.first_ts, e.ts) AS retention_day,
       e.value * 100 AS stay_time,
       CASE WHEN e.user_id % 5 <> 0 THEN 0.5::DOUBLE END AS active_ratio,
       CASE WHEN e.user_id % 13 = 0 THEN 0.0::DOUBLE
            WHEN e.user_id % 7 <> 0 THEN 0.25::DOUBLE + (e.user_id % 3) * 0.125::DOUBLE END AS baseline
FROM events e JOIN (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY user_id) f
ON e.user_id = f.user_id
"""


def order_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.lit(DAY).alias("p_date"),
        F.to_json(
            F.struct(
                F.round(F.col("o_totalprice") / 10000, 2).alias("create_order_amount"),
                F.when(status == "O", 0).otherwise(1).alias("is_pay"),
                F.when(status == "F", 1).otherwise(0).alias("is_fail"),
                F.when(F.col("o_orderpriority") == "1-URGENT", "1")
                .otherwise("0")
                .alias("is_reliable"),
                F.lit(0).alias("is_refunded"),
                F.lit(0).alias("is_cancel"),
            )
        ).alias("feature_json"),
        F.to_json(
            F.struct(
                (F.lit(799999900) + F.col("o_custkey")).cast("string").alias("rit"),
                F.col("o_orderkey").cast("string").alias("req_id"),
                F.when(status != "P", F.col("o_orderkey").cast("string")).alias("order_id"),
                F.concat(F.lit("u"), F.col("o_custkey")).alias("union_imei"),
            )
        ).alias("extra_json"),
    )


ORDERS_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS request_id,
       round(o_totalprice / 10000, 2) AS amount,
       CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS is_pay,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_fail,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_reliable,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS order_id
FROM orders WHERE 799999900 + o_custkey >= 800000000
"""
