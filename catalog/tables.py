"""Windows from stored parts, schema roll-ups, sketches, and tables written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.predicates import in_window
from tallyward.operators.entity import Entity, FeatureGroup, entity_features
from tallyward.operators.features import (
    ApproxDistinct,
    Count,
    DistinctCount,
    Ratio,
    SketchPercentile,
    Stat,
    TopNRatio,
)
from tallyward.operators.groups import group_features_rolled_up
from tallyward.plans import jobs
from tallyward.plans.specs import RESOURCE_V4
from tallyward.sources import tables as stored

from .entities import MERGED, _merge_input, _population_sql
from .groups import _flagged_requests
from .inputs import ALL_HOURS, LAST_DAY, LAST_HOUR, events, hourly, table
from .registry import ORACLE, long_sql, query, settle, settled_sql


def folder(spark: SparkSession, name: str) -> str:
    """A new folder in the one the cluster shares."""
    return f"{stored.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# A day that ends at noon, from parts kept per hour.
WINDOW = ("20240110", "12", 24)
WINDOWED = FeatureGroup(
    "types",
    (
        Entity(
            ("event_type",),
            (
                Count("event_cnt"),
                Ratio("costly_ratio", top="value > 50"),
                DistinctCount("user_cnt", "value > 10", ("user_id",)),
                TopNRatio("top_user_ratio", True, ("user_id",), 1),
                Stat("value_avg", True, "avg", "value", 100.0),
                Stat("value_max", "value < 90", "max", "value"),
                DistinctCount("props_cnt", columns=("props",)),
            ),
        ),
        Entity(("user_id",), (Count("user_event_cnt"), Stat("user_value_sum", True, "sum", "value"))),
    ),
    where="event_type != 'error'",
)
_WINDOW_ROWS = """SELECT * FROM events WHERE event_type <> 'error'
AND ts >= TIMESTAMP '2024-01-09 13:00:00' AND ts < TIMESTAMP '2024-01-10 13:00:00'"""
_WINDOW_SQL = (
    long_sql(
        f"""SELECT event_type AS dval, count(*) AS event_cnt,
        count(*) FILTER (WHERE value > 50) / CAST(count(*) AS DOUBLE) AS costly_ratio,
        count(DISTINCT user_id) FILTER (WHERE value > 10) AS user_cnt,
        max(n_user) / CAST(count(*) AS DOUBLE) AS top_user_ratio,
        avg(CASE WHEN value >= 100 THEN 100 ELSE value END) AS value_avg,
        max(value) FILTER (WHERE value < 90) AS value_max,
        count(DISTINCT props) AS props_cnt
        FROM (SELECT *, count(*) OVER (PARTITION BY event_type, user_id) AS n_user FROM ({_WINDOW_ROWS}))
        GROUP BY event_type""",
        "event_type",
        {
            "event_cnt": "count",
            "costly_ratio": "ratio",
            "user_cnt": "distinct_count",
            "top_user_ratio": "top_n_ratio",
            "value_avg": "stats",
            "value_max": "stats",
            "props_cnt": "distinct_count",
        },
    )
    + " UNION ALL "
    + long_sql(
        f"""SELECT CAST(user_id AS VARCHAR) AS dval, count(*) AS user_event_cnt, sum(value) AS user_value_sum
        FROM ({_WINDOW_ROWS}) GROUP BY user_id""",
        "user_id",
        {"user_event_cnt": "count", "user_value_sum": "stats"},
    )
)


@query("window_from_parts", _WINDOW_SQL)
def window_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of the window's hours, kept in one pass; the last hour again by its own job."""
    log, path = hourly(table(spark, sf_dir, "events"), "date"), folder(spark, "hour-parts")
    date, hour, hours = WINDOW
    jobs.backfill_hour_parts(in_window(log, date, hour, hours + 1), WINDOWED, "v1", path)
    last = log.where((F.col("date") == date) & (F.col("hour") == hour))
    jobs.run_hour_parts(lambda *at: last, WINDOWED, date, hour, "v1", path)
    long = jobs.run_window_features(
        log.limit(0), WINDOWED, path, date, hour, hours, "v1", missing_is_empty=True
    )
    return settle(long, "fval")


# Sets that several schemas can be derived from.
FINER = (
    "device_vendor,device_model,os_type,os_version,rom_version,ad_slot_type",
    "device_vendor,device_model,os_type,ip,ipc",
)


@query("group_request_rolled_up", ORACLE["group_request_all_schemas"])
def group_request_rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seventeen schemas from ten column sets folded once from the log."""
    wide = group_features_rolled_up(_flagged_requests(spark, sf_dir), RESOURCE_V4, FINER)
    return settle(wide, *[f.name for f in RESOURCE_V4.features if f.kind == "distinct_ratio"])


# At most so far off may a sketch be: six standard errors, and the rank error.
DISTINCT_ERROR, RANK_ERROR = 6 * 1.04 / 2**7, 1.65 / 400


@query(
    "sketch_features",
    """
SELECT event_type, true AS users_close, true AS rank_close, true AS merged_alike, count(*) AS event_cnt,
       count(DISTINCT user_id) AS user_cnt
FROM events GROUP BY event_type
""",
)
def sketch_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketched distinct counts and percentiles against exact ones, in one pass and by days.

    A flag says whether the estimate lies within the stated error of the exact value.
    """
    features = (
        Count("event_cnt"),
        DistinctCount("user_cnt", columns=("user_id",)),
        ApproxDistinct("users", columns=("user_id",)),
        SketchPercentile("p90", True, 0.9, "value"),
    )
    group = FeatureGroup("types", (Entity(("event_type",), features),))
    log, path = hourly(table(spark, sf_dir, "events"), "date"), folder(spark, "sketches")
    log = log.withColumn("hour", F.lit("00"))
    once = entity_features(log, group)
    jobs.backfill_hour_parts(log, group, "v1", path)
    window = (LAST_DAY, LAST_HOUR, ALL_HOURS)
    again = jobs.run_window_features(log.limit(0), group, path, *window, "v1", missing_is_empty=True)

    def pivoted(long: DataFrame, prefix: str) -> DataFrame:
        names = [F.max(F.when(F.col("fkey") == f.name, F.col("fval"))).alias(prefix + f.name) for f in features]
        return long.groupBy(F.col("dval").alias("event_type")).agg(*names)

    exact = pivoted(once, "").join(pivoted(again, "h_"), "event_type")
    below = (
        log.join(exact.select("event_type", "p90", "h_p90"), "event_type")
        .groupBy("event_type")
        .agg(*[
            F.count_if(F.col("value") < F.col(p)).alias(f"{p}_below") for p in ("p90", "h_p90")
        ], *[F.count_if(F.col("value") <= F.col(p)).alias(f"{p}_upto") for p in ("p90", "h_p90")])
    )
    n = F.col("event_cnt")

    def near(p: str) -> F.Column:
        low, high = (0.9 - 2 * RANK_ERROR) * n, (0.9 + 2 * RANK_ERROR) * n
        return (F.col(f"{p}_below") <= high) & (F.col(f"{p}_upto") >= low)

    return exact.join(below, "event_type").select(
        "event_type",
        (F.abs(F.col("users") / F.col("user_cnt") - 1) <= DISTINCT_ERROR).alias("users_close"),
        (near("p90") & near("h_p90")).alias("rank_close"),
        (F.col("users") == F.col("h_users")).alias("merged_alike"),
        n.cast("bigint").alias("event_cnt"),
        F.col("user_cnt").cast("bigint").alias("user_cnt"),
    )


_KINDS = ("count", "ratio", "stats", "top_n_ratio")


@query(
    "tables_long_features",
    f"SELECT * FROM ({ORACLE['entity_count']}) WHERE fkey <> 'costly_cnt'",
)
def tables_long_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, the second time with one kind gone empty, and read by kind and entity."""
    features = (Count("event_cnt"), Count("error_cnt", "event_type = 'error'"))
    path, at = folder(spark, "long"), {"date": "20240102", "hour": "08", "group": "users", "version": "v1"}
    both = FeatureGroup("users", (Entity(("user_id",), (*features, Ratio("gone"))),))
    one = FeatureGroup("users", (Entity(("user_id",), features),))
    rows = events(spark, sf_dir)
    for group in (both, one):
        long = entity_features(rows, group)
        stored.overwrite_kinds(long, path, at, "aggregator_type", both.kinds)
    other = {**at, "date": "20240103"}
    stored.overwrite_kinds(entity_features(rows, both), path, other, "aggregator_type", both.kinds)
    long = stored.read_features(spark, path, at["date"], at["hour"], "user_id", both.kinds, "v1", "users")
    return settle(long, "fval").select("aggregator_type", "dkey", "dval", "fkey", "fval")


_GROUP_SQL = """
SELECT 'l_returnflag' AS group_schema, l_returnflag AS group_pattern, count(*) AS line_cnt
FROM lineitem GROUP BY l_returnflag
"""


@query(
    "tables_groups_labels_rules",
    " UNION ALL ".join(
        f"SELECT '{kind}' AS source, * FROM ({_GROUP_SQL})"
        for kind in ("groups", "labels", "rules", "patterns")
    ),
)
def tables_groups_labels_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partition of each table replaced twice, others beside it, read by its own reader."""
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.groupBy(F.col("l_returnflag").alias("group_pattern")).agg(F.count(F.lit(1)).alias("line_cnt"))
    rows = rows.select(
        F.lit("l_returnflag").alias("group_schema"),
        "group_pattern",
        F.to_json(F.struct("line_cnt")).alias("feature_json"),
    )
    rules = rows.withColumnsRenamed({"group_pattern": "rule_condition", "feature_json": "ad_performance_json"})
    root, day, schemas = folder(spark, "tables"), "20240102", ["l_returnflag"]
    paths = {name: f"{root}/{name}" for name in ("groups", "labels", "rules", "patterns")}
    at = {"date": day, "version": "REQ"}
    hour = {"date": day, "hour": stored.DAILY_HOUR, "version": "REQ"}
    for written in (rows.limit(1), rows):
        stored.overwrite_partition(written, paths["groups"], hour)
        stored.overwrite_partition(written, paths["labels"], at)
        stored.overwrite_partition(written, paths["patterns"], at)
    stored.overwrite_partition(rules, paths["rules"], at)
    for name in ("labels", "rules", "patterns"):
        stored.overwrite_partition(rules if name == "rules" else rows, paths[name], {**at, "date": "20240103"})
    stored.overwrite_partition(rows, paths["groups"], {**hour, "hour": "08"})
    found = {
        "groups": stored.read_group_features(spark, paths["groups"], day, "REQ", schemas),
        "labels": stored.read_performance(spark, paths["labels"], day, "REQ", schemas),
        "rules": stored.read_strategies(spark, paths["rules"], day, "REQ").toDF(*rows.columns),
        "patterns": stored.read_table(spark, paths["patterns"], stored.ANOMALY_PATTERNS, at).select(*rows.columns),
    }
    count = F.get_json_object("feature_json", "$.line_cnt").cast("bigint").alias("line_cnt")
    frames = [
        rows.select(F.lit(name).alias("source"), "group_schema", "group_pattern", count)
        for name, rows in found.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@query(
    "job_merge",
    f"""SELECT 'wide' AS source, user_id AS name, event_cnt AS first_value, value_max AS second_value FROM ({ORACLE["merge_wide"]})
    UNION ALL SELECT 'population_stats', fkey, avg_value, {settled_sql("std_value")} FROM ({_population_sql()})""",
)
def job_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge job from a stored long table, its table and its texts read back."""
    path, wide_path, text = (folder(spark, n) for n in ("long", "wide", "text"))
    date, hour = "20240102", "08"
    at = {"date": date, "hour": hour, "group": "users", "version": "v1"}
    stored.overwrite_kinds(_merge_input(spark, sf_dir), path, at, "aggregator_type", _KINDS)
    spec = jobs.MergeSpec("users", "user_id", _KINDS, "v1", MERGED, population=True)
    jobs.run_merge(spark, path, spec, date, hour, wide_path, text)
    names = ", ".join(["user_id string", *[f"{f.name} double" for f in MERGED]])
    wide = stored.read_table(
        spark, wide_path, stored.Table(names, ("date", "hour")), {"date": date, "hour": hour}
    )
    written = stored.merge_output_path(text, "population_stats", "users", "v1", date, hour)
    stats = spark.read.schema("fkey string, avg_value double, std_value double").csv(written)
    return settle(wide, "event_cnt").select(
        F.lit("wide").alias("source"), F.col("user_id").alias("name"),
        F.col("event_cnt").alias("first_value"), F.col("value_max").alias("second_value"),
    ).unionByName(
        settle(stats, "std_value").select(
            F.lit("population_stats").alias("source"), F.col("fkey").alias("name"),
            F.col("avg_value").alias("first_value"), F.col("std_value").alias("second_value"),
        )
    )
