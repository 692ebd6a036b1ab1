"""The jobs from log to anomalous patterns, table to table over two periods.

Rules are mined from the first half of the log and matched with patterns of the second.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.plans import jobs
from tallyward.sources import tables as stored
from tallyward.sources.logs import day_requests, requests_flagged
from tallyward.sources.performance import game_rows, order_rows, user_growth_rows

from .groups import (
    APP_NAMES,
    ECOM_SQL,
    FEATURES_SQL,
    GAME_ROWS_SQL,
    MINED_SQL,
    REQUEST_GROUP,
    SCHEMAS,
    STRATEGIES,
    UG_ROWS_SQL,
    _retention_sql,
    _rules_sql,
)
from .inputs import (
    ALL_HOURS,
    DAY,
    LAST_DAY,
    LAST_HOUR,
    activations,
    app_status,
    black_hits,
    make_money_apps,
    order_performance,
    request_log,
    sites,
)
from .registry import query, settle, settled_sql
from .tables import folder

FIRST, SECOND = "20240115", "20240131"
EARLY = "ts < TIMESTAMP_NTZ'2024-01-16 00:00:00'"
LATE = f"NOT ({EARLY})"
GOOD = ("ord_cnt >= 15", "trust_fail_ratio >= 0.30", "game_activation_cnt >= 1")
VERSION = REQUEST_GROUP.name


def _early(sql: str) -> str:
    return re.sub(r"\bevents\b", "early", sql)


def _late(sql: str) -> str:
    return re.sub(r"\bevents\b", "late", sql)


def _halves(sql: str) -> str:
    return f"""WITH early AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16'),
    late AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16') {sql}"""


def _groups(spark: SparkSession, sf_dir: str, when: str, date: str, path: str) -> None:
    """Group features of one half, kept under a date of their own."""
    hits = black_hits(spark, sf_dir, when).withColumn("p_date", F.lit(LAST_DAY))
    log = requests_flagged(request_log(spark, sf_dir, when), hits, LAST_DAY, LAST_HOUR, ALL_HOURS)
    jobs.run_group_features(lambda *at: log, REQUEST_GROUP, date, stored.DAILY_HOUR, 24, path)


def _labels(spark: SparkSession, sf_dir: str, root: str) -> jobs.Performance:
    """Labels of the first half, written; returns the tables' paths."""
    moved = activations(spark, sf_dir, EARLY)
    money, status = make_money_apps(spark, sf_dir), app_status(spark, sf_dir)
    rows = jobs.Performance(
        game=game_rows(moved, money, status, sites(spark, sf_dir), DAY),
        ug=user_growth_rows(moved, money, status, DAY, APP_NAMES),
        ecom=order_rows(order_performance(spark, sf_dir), DAY),
    )
    log = day_requests(request_log(spark, sf_dir, EARLY).withColumn("p_date", F.lit(DAY)), DAY)
    paths = jobs.Performance(*[f"{root}/{kind}" for kind in ("game", "ug", "ecom")])
    jobs.run_performance_labels(rows, log, SCHEMAS, FIRST, VERSION, paths)
    return paths


def _rules(spark: SparkSession, sf_dir: str, root: str) -> None:
    labels = _labels(spark, sf_dir, root)
    _groups(spark, sf_dir, EARLY, FIRST, f"{root}/groups")
    jobs.run_mining(spark, f"{root}/groups", labels, STRATEGIES, FIRST, VERSION, f"{root}/rules")


def _number(column: str, name: str) -> F.Column:
    return F.get_json_object(column, f"$.{name}").cast("double").alias("number")


@query(
    "job_labels",
    _halves(
        " UNION ALL ".join(
            f"SELECT '{kind}' AS kind, group_schema, group_pattern, {settled_sql(column)} AS number FROM ({_early(sql)})"
            for kind, column, sql in (
                ("game", "game_day_3_10_scale", _retention_sql(GAME_ROWS_SQL, "game", False)),
                ("ug", "ug_activation_cnt", _retention_sql(UG_ROWS_SQL, "ug", False)),
                ("ecom", "trust_sum_order_amount", ECOM_SQL),
            )
        )
    ),
)
def job_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the first half as the three tables hold them."""
    paths = _labels(spark, sf_dir, folder(spark, "chain"))
    shown = {"game": "game_day_3_10_scale", "ug": "ug_activation_cnt", "ecom": "trust_sum_order_amount"}
    frames = [
        stored.read_performance(spark, getattr(paths, kind), FIRST, VERSION, SCHEMAS).select(
            F.lit(kind).alias("kind"), "group_schema", "group_pattern", _number("feature_json", name)
        )
        for kind, name in shown.items()
    ]
    return settle(frames[0].unionByName(frames[1]).unionByName(frames[2]), "number")


@query(
    "job_mining",
    _halves(
        f"""SELECT group_schema, rule_condition, {settled_sql("ord_cnt")} AS ord_cnt,
        {settled_sql("game_activation_cnt")} AS game_activation_cnt,
        {settled_sql("trust_fail_ratio")} AS trust_fail_ratio FROM ({_early(MINED_SQL)})"""
    ),
)
def job_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of the first half as the rule table holds them."""
    root = folder(spark, "chain")
    _rules(spark, sf_dir, root)
    names = ("ord_cnt", "game_activation_cnt", "trust_fail_ratio")
    rules = stored.read_strategies(spark, f"{root}/rules", FIRST, VERSION)
    shown = rules.select(
        "group_schema", "rule_condition", *[_number("ad_performance_json", n).alias(n) for n in names]
    )
    return settle(shown, *names)


@query(
    "job_match",
    _halves(
        f"""SELECT DISTINCT p.group_schema, p.group_pattern FROM ({_rules_sql(_late(FEATURES_SQL))}) p
        JOIN (SELECT * FROM ({_early(MINED_SQL)}) WHERE {" AND ".join(GOOD)}) s
        ON p.group_schema = s.group_schema AND p.rule_condition = s.rule_condition"""
    ),
)
def job_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns of the second half that meet a good rule of the first, read back."""
    root = folder(spark, "chain")
    _rules(spark, sf_dir, root)
    _groups(spark, sf_dir, LATE, SECOND, f"{root}/groups")
    jobs.run_match(
        spark, f"{root}/groups", f"{root}/rules", STRATEGIES, GOOD, SECOND, FIRST, VERSION, f"{root}/patterns"
    )
    found = stored.read_table(
        spark, f"{root}/patterns", stored.ANOMALY_PATTERNS, {"date": SECOND, "version": VERSION}
    )
    return found.select("group_schema", "group_pattern")
