"""Per-entity features, merging, population statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.predicates import trailing_window
from tallyward.operators.entity import Entity, FeatureGroup, entity_features, wide_to_long
from tallyward.operators.features import (
    Count,
    DistinctCount,
    Percentile,
    Ratio,
    Stat,
    TopNRatio,
)
from tallyward.operators.iat import (
    IatKey,
    IatRankRatio,
    IatRatio,
    IatStat,
    IatStep,
    InterArrival,
    inter_arrival,
)
from tallyward.operators.merge import MergedFeature, merge_wide, population_stats

from .inputs import events, hourly, table
from .registry import ORACLE, long_sql, query, settle, settled_sql


def _users(spark: SparkSession, sf_dir: str, *features, arrivals=()) -> DataFrame:
    group = FeatureGroup("users", (Entity(("user_id",), features, arrivals),))
    return settle(entity_features(events(spark, sf_dir), group), "fval")


def _user_sql(**kinds_and_columns) -> str:
    """SQL of user features: name=(kind, expression)."""
    columns = ", ".join(f"{e} AS {n}" for n, (_, e) in kinds_and_columns.items())
    wide = f"SELECT CAST(user_id AS VARCHAR) AS dval, {columns} FROM events GROUP BY user_id"
    return long_sql(wide, "user_id", {n: k for n, (k, _) in kinds_and_columns.items()})


@query(
    "entity_count",
    _user_sql(
        event_cnt=("count", "count(*)"),
        error_cnt=("count", "count(*) FILTER (WHERE event_type = 'error')"),
        costly_cnt=("count", "count(*) FILTER (WHERE event_type = 'purchase' AND value > 50)"),
    ),
)
def entity_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(
        spark,
        sf_dir,
        Count("event_cnt"),
        Count("error_cnt", F.col("event_type") == "error"),
        Count("costly_cnt", "event_type = 'purchase' AND value > 50"),
    )


@query(
    "entity_distinct_count",
    _user_sql(
        type_distinct_cnt=("distinct_count", "count(DISTINCT event_type) FILTER (WHERE value > 50)"),
        all_type_distinct_cnt=("distinct_count", "count(DISTINCT event_type)"),
        type_props_distinct_cnt=("distinct_count", "count(DISTINCT event_type || '|' || props) FILTER (WHERE value > 50)"),
    ),
)
def entity_distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(
        spark,
        sf_dir,
        DistinctCount("type_distinct_cnt", "value > 50", ("event_type",)),
        DistinctCount("all_type_distinct_cnt", columns=("event_type",)),
        DistinctCount("type_props_distinct_cnt", "value > 50", ("event_type", "props")),
    )


@query(
    "entity_ratio",
    _user_sql(
        error_ratio=(
            "ratio",
            "count(*) FILTER (WHERE value > 10 AND event_type = 'error')"
            " / CAST(nullif(count(*) FILTER (WHERE value > 10), 0) AS DOUBLE)",
        ),
        empty_ratio=(
            "ratio",
            "count(*) FILTER (WHERE value > 1000000)"
            " / CAST(nullif(count(*) FILTER (WHERE value > 1000000), 0) AS DOUBLE)",
        ),
    ),
)
def entity_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(
        spark,
        sf_dir,
        Ratio("error_ratio", "value > 10", top="event_type = 'error'"),
        Ratio("empty_ratio", bottom="value > 1000000"),
    )


_CLIPPED = "CASE WHEN value >= 100 THEN 100 ELSE value END"


@query(
    "entity_stats_clip",
    _user_sql(
        value_avg=("stats", f"avg({_CLIPPED}) FILTER (WHERE value > 5)"),
        value_sum=("stats", f"sum({_CLIPPED}) FILTER (WHERE value > 5)"),
        value_max=("stats", f"max({_CLIPPED})"),
        value_std=("stats", f"stddev_pop({_CLIPPED})"),
        raw_min=("stats", "min(value)"),
    ),
)
def entity_stats_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(
        spark,
        sf_dir,
        Stat("value_avg", "value > 5", "avg", "value", 100.0),
        Stat("value_sum", "value > 5", "sum", "value", 100.0),
        Stat("value_max", True, "max", "value", 100.0),
        Stat("value_std", True, "stddev_pop", "value", 100.0),
        Stat("raw_min", True, "min", "value"),
    )


@query(
    "entity_pct",
    _user_sql(
        value_p90=("stats", "quantile_disc(value, 0.9)"),
        clipped_p50=("stats", f"quantile_disc({_CLIPPED}, 0.5) FILTER (WHERE event_type <> 'view')"),
    ),
)
def entity_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(
        spark,
        sf_dir,
        Percentile("value_p90", True, 0.9, "value"),
        Percentile("clipped_p50", "event_type <> 'view'", 0.5, "value", 100.0),
    )


def _top_sql(rows: str, dkey: str, name: str, n: int) -> str:
    """Rows of (dval, key, hit): hit says whether the row meets the condition."""
    return f"""
SELECT 'top_n_ratio' AS aggregator_type, '{dkey}' AS dkey, dval, '{name}' AS fkey,
       {settled_sql("sum(CASE WHEN hits > 0 AND rk <= " + str(n) + " THEN n_rows ELSE 0 END)"
                    " / CAST(nullif(sum(CASE WHEN hits > 0 THEN n_rows ELSE 0 END), 0) AS DOUBLE)")} AS fval
FROM (SELECT dval, n_rows, hits,
             dense_rank() OVER (PARTITION BY dval ORDER BY hits DESC, key DESC) AS rk
      FROM (SELECT dval, key, count(*) AS n_rows, count(*) FILTER (WHERE hit) AS hits
            FROM ({rows}) GROUP BY dval, key))
GROUP BY dval
"""


@query(
    "entity_top_n_ratio",
    _top_sql(
        "SELECT CAST(user_id AS VARCHAR) AS dval, event_type AS key, value > 10 AS hit FROM events",
        "user_id", "type_top1_ratio", 1,
    )
    + " UNION ALL "
    + _top_sql(
        "SELECT CAST(l_partkey AS VARCHAR) AS dval, CAST(l_suppkey AS VARCHAR) AS key, true AS hit FROM lineitem",
        "l_partkey", "supplier_top2_ratio", 2,
    )
    + " UNION ALL "
    + _top_sql(
        "SELECT CAST(l_partkey AS VARCHAR) AS dval, l_returnflag || '|' || l_linestatus AS key, l_quantity > 25 AS hit FROM lineitem",
        "l_partkey", "flags_top3_ratio", 3,
    ),
)
def entity_top_n_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _users(
        spark, sf_dir, TopNRatio("type_top1_ratio", "value > 10", ("event_type",), 1)
    )
    features = (
        TopNRatio("supplier_top2_ratio", True, ("l_suppkey",), 2),
        TopNRatio("flags_top3_ratio", "l_quantity > 25", ("l_returnflag", "l_linestatus"), 3),
    )
    group = FeatureGroup("parts", (Entity(("l_partkey",), features),))
    parts = entity_features(table(spark, sf_dir, "lineitem"), group)
    return users.unionByName(settle(parts, "fval"))


_SECONDS = "CAST(epoch_us(ts) // 1000000 AS BIGINT)"
_PAIRS = f"""
SELECT user_id, {_SECONDS} AS sec, value,
       lead({_SECONDS}) OVER w AS next_sec, lead(value) OVER w AS next_value,
       row_number() OVER w AS rank_num
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY {_SECONDS}, event_id)
"""


def _pair_sql(step: str, **features: str) -> str:
    """Features over `iat`, an expression of a pair."""
    columns = ", ".join(f"{e} AS {n}" for n, e in features.items())
    wide = f"""
SELECT CAST(user_id AS VARCHAR) AS dval, {columns}
FROM (SELECT *, {step} AS iat FROM ({_PAIRS}) WHERE next_sec IS NOT NULL) GROUP BY user_id
"""
    return long_sql(wide, "user_id", {n: "iat" for n in features})


def _arrivals(column: str, *steps: IatStep) -> InterArrival:
    return InterArrival(("sec",), (IatKey(column, steps),), ("event_id",))


@query(
    "entity_iat_stats",
    _pair_sql(
        "CASE WHEN next_sec - sec >= 86400 THEN 86400 ELSE next_sec - sec END",
        iat_avg="avg(iat)",
        iat_std="stddev_pop(iat)",
        iat_max="max(iat) FILTER (WHERE iat > 60)",
    ),
)
def entity_iat_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = IatStep(
        "minus",
        (
            IatStat("iat_avg", "avg"),
            IatStat("iat_std", "stddev_pop"),
            IatStat("iat_max", "max", "iat > 60"),
        ),
        where="sec IS NOT NULL",
        clip=86400.0,
    )
    return _users(spark, sf_dir, arrivals=(_arrivals("sec", step),))


@query(
    "entity_iat_ratio",
    _pair_sql(
        "next_sec - sec",
        iat_short_ratio="count(*) FILTER (WHERE iat <= 3600)"
        " / CAST(nullif(count(*) FILTER (WHERE iat <= 86400), 0) AS DOUBLE)",
    ),
)
def entity_iat_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature = IatRatio("iat_short_ratio", "iat <= 3600", F.col("iat") <= 86400)
    return _users(
        spark, sf_dir, arrivals=(_arrivals("sec", IatStep("minus", (feature,))),)
    )


@query(
    "entity_iat_rank_ratio",
    _pair_sql(
        "next_sec - sec",
        iat_rank_ratio="min(rank_num) FILTER (WHERE iat > 0 AND iat <= 3600)"
        " / CAST(max(rank_num) FILTER (WHERE iat > 0) AS DOUBLE)",
    ),
)
def entity_iat_rank_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    feature = IatRankRatio("iat_rank_ratio", "iat <= 3600", where="iat > 0")
    return _users(
        spark, sf_dir, arrivals=(_arrivals("sec", IatStep("minus", (feature,))),)
    )


@query("entity_iat_hot", ORACLE["entity_iat_rank_ratio"])
def entity_iat_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every entity cut into chunks, as in a log of billions of rows."""
    feature = IatRankRatio("iat_rank_ratio", "iat <= 3600", where="iat > 0")
    arrivals = _arrivals("sec", IatStep("minus", (feature,)))
    wide = inter_arrival(events(spark, sf_dir), ("user_id",), arrivals, 1 / 1_000, 0)
    return settle(wide_to_long(wide, "user_id", [("iat_rank_ratio", "iat")]), "fval")


_RATIOS = {
    "div": "next_value / nullif(value, 0)",
    "div_max": "CASE WHEN next_value > value THEN next_value / nullif(value, 0) ELSE value / nullif(next_value, 0) END",
    "div_min": "CASE WHEN next_value < value THEN next_value / nullif(value, 0) ELSE value / nullif(next_value, 0) END",
    "minus_abs": "abs(next_value - value)",
}


@query(
    "entity_iat_div",
    " UNION ALL ".join(
        _pair_sql(sql, **{f"{func}_max": "max(iat)", f"{func}_avg": "avg(iat)"})
        for func, sql in _RATIOS.items()
    ),
)
def entity_iat_div(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [
        IatStep(func, (IatStat(f"{func}_max", "max"), IatStat(f"{func}_avg", "avg")))
        for func in _RATIOS
    ]
    return _users(spark, sf_dir, arrivals=(_arrivals("value", *steps),))


def _line_sql(dkey: str, dval: str, by: str, prefix: str) -> str:
    return long_sql(
        f"""SELECT {dval} AS dval, count(*) AS {prefix}_cnt,
                   count(DISTINCT l_partkey) AS {prefix}_parts,
                   avg(l_quantity) AS {prefix}_quantity FROM lineitem GROUP BY {by}""",
        dkey,
        {
            f"{prefix}_cnt": "count",
            f"{prefix}_parts": "distinct_count",
            f"{prefix}_quantity": "stats",
        },
    )


@query(
    "entity_multi_dkey",
    _line_sql("l_suppkey", "CAST(l_suppkey AS VARCHAR)", "l_suppkey", "supplier")
    + " UNION ALL "
    + _line_sql(
        "l_suppkey_l_returnflag",
        "CAST(l_suppkey AS VARCHAR) || '|' || l_returnflag",
        "l_suppkey, l_returnflag",
        "flagged",
    ),
)
def entity_multi_dkey(spark: SparkSession, sf_dir: str) -> DataFrame:
    def entity(prefix: str, *dkey: str) -> Entity:
        return Entity(
            dkey,
            (
                Count(f"{prefix}_cnt"),
                DistinctCount(f"{prefix}_parts", columns=("l_partkey",)),
                Stat(f"{prefix}_quantity", True, "avg", "l_quantity"),
            ),
        )

    group = FeatureGroup(
        "lines",
        (entity("supplier", "l_suppkey"), entity("flagged", "l_suppkey", "l_returnflag")),
    )
    return settle(entity_features(table(spark, sf_dir, "lineitem"), group), "fval")


@query(
    "trailing_window",
    """
SELECT event_type, strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour,
       count(*) AS event_cnt, max(value) AS value_max
FROM events
WHERE ts >= TIMESTAMP '2024-01-09 13:00:00' AND ts < TIMESTAMP '2024-01-10 13:00:00'
GROUP BY ALL
""",
)
def trailing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        hourly(table(spark, sf_dir, "events"), "date")
        .where(trailing_window("20240110", "12", 24))
        .groupBy("event_type", "date", "hour")
        .agg(F.count(F.lit(1)).alias("event_cnt"), F.max("value").alias("value_max"))
    )


MERGED = (
    MergedFeature("event_cnt", clip=70.0, func="log"),
    MergedFeature("error_ratio", fill=0.0),
    MergedFeature("costly_ratio"),
    MergedFeature("value_max", clip=100.0),
    MergedFeature("type_top1_ratio"),
    MergedFeature("never_seen", fill=-7.0),
)


def _merge_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = (
        Count("event_cnt"),
        Ratio("error_ratio", top="event_type = 'error'"),
        Ratio("costly_ratio", top="event_type = 'view'", bottom="value > 300"),
        Stat("value_max", True, "max", "value"),
        TopNRatio("type_top1_ratio", True, ("event_type",), 1),
    )
    group = FeatureGroup("users", (Entity(("user_id",), features),))
    return entity_features(events(spark, sf_dir), group)


_MERGE_SQL = """
SELECT user_id, CAST(count(*) AS DOUBLE) AS event_cnt,
       count(*) FILTER (WHERE event_type = 'error') / CAST(count(*) AS DOUBLE) AS error_ratio,
       count(*) FILTER (WHERE value > 300 AND event_type = 'view')
         / CAST(nullif(count(*) FILTER (WHERE value > 300), 0) AS DOUBLE) AS costly_ratio,
       max(value) AS value_max,
       max(n_type) / CAST(count(*) AS DOUBLE) AS type_top1_ratio
FROM (SELECT *, count(*) OVER (PARTITION BY user_id, event_type) AS n_type FROM events)
GROUP BY user_id
"""


@query(
    "merge_wide",
    f"""
SELECT CAST(user_id AS VARCHAR) AS user_id,
       {settled_sql("CASE WHEN event_cnt >= 70 THEN ln(70) ELSE round(ln(event_cnt), 4) END")} AS event_cnt,
       round(error_ratio, 4) AS error_ratio,
       coalesce(round(costly_ratio, 4), -1.0::DOUBLE) AS costly_ratio,
       CASE WHEN value_max >= 100 THEN 100.0::DOUBLE ELSE round(value_max, 4) END AS value_max,
       round(type_top1_ratio, 4) AS type_top1_ratio,
       -7.0::DOUBLE AS never_seen
FROM ({_MERGE_SQL})
""",
)
def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = merge_wide(_merge_input(spark, sf_dir), MERGED, "user_id")
    return settle(wide, "event_cnt")


def _population_sql() -> str:
    values = {
        "event_cnt": "ln(least(event_cnt, 70))",
        "error_ratio": "error_ratio",
        "costly_ratio": "costly_ratio",
        "value_max": "least(value_max, 100.0)",
        "type_top1_ratio": "type_top1_ratio",
        "never_seen": "CAST(NULL AS DOUBLE)",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS fkey, round(avg({v}), 4) AS avg_value, "
        f"round(stddev_pop({v}), 4) AS std_value FROM ({_MERGE_SQL})"
        for name, v in values.items()
    )


@query("population_stats", _population_sql())
def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population_stats(_merge_input(spark, sf_dir), MERGED)
