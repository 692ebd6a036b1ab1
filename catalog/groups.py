"""Group patterns, labels, rules."""

from __future__ import annotations

from collections.abc import Sequence

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.constants import RETENTION_BUCKETS
from tallyward.functions.scalars import json_number, json_texts
from tallyward.operators.features import (
    Count,
    DistinctCount,
    DistinctRatio,
    Percentile,
    Ratio,
    Stat,
)
from tallyward.operators.groups import GroupSpec, group_features, to_feature_json
from tallyward.operators.labels import all_labels, order_labels, retention_labels
from tallyward.operators.rules import (
    GridDim,
    Strategy,
    expand_rules,
    good_rules,
    match_patterns,
    metric_names,
    mine_strategies,
    with_labels,
    strategies_json,
)
from tallyward.plans.specs import (
    BLOCKED,
    ON_BLACK_LIST,
    RESOURCE_V4,
    SEVEN_DAYS,
    THREE_DAYS,
)
from tallyward.sources.logs import day_requests, requests_flagged
from tallyward.sources.performance import game_rows, order_rows, user_growth_rows

from .inputs import (
    ACTIVATIONS_SQL,
    ALL_HOURS,
    APPS_SQL,
    BLACK_SQL,
    DAY,
    LAST_DAY,
    LAST_HOUR,
    ORDERS_SQL,
    PACKAGES_SQL,
    REQUEST_SQL,
    activations,
    app_status,
    black_hits,
    make_money_apps,
    order_performance,
    request_log,
    sites,
    table,
)
from .registry import ORACLE, SALTED, query, settle, settled_sql

LINE_SCHEMAS = ("l_returnflag,p_brand", "p_brand,o_orderpriority", "l_linestatus")
LINES_SQL = """
SELECT l.*, o.o_custkey, o.o_orderpriority, o.o_totalprice, p.p_brand FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )


def _patterns_sql(rows: str, schemas: Sequence[str], columns: str) -> str:
    """One SELECT per schema; DuckDB's concat_ws skips NULLs as well."""
    return " UNION ALL ".join(
        f"SELECT '{s}' AS group_schema, concat_ws('|', {s}) AS group_pattern, {columns} "
        f"FROM ({rows}) GROUP BY concat_ws('|', {s})"
        for s in schemas
    )


@query(
    "group_patterns",
    _patterns_sql(
        LINES_SQL,
        LINE_SCHEMAS,
        f"""count(*) AS line_cnt,
        count(*) FILTER (WHERE l_quantity > 25) AS big_cnt,
        count(DISTINCT o_custkey) FILTER (WHERE l_quantity > 25) AS big_customers,
        {settled_sql("count(*) FILTER (WHERE l_discount > 0.05) / CAST(count(*) AS DOUBLE)")} AS discount_ratio,
        {settled_sql("avg(CASE WHEN l_quantity >= 40 THEN 40 ELSE l_quantity END)")} AS quantity_avg,
        {settled_sql("sum(l_quantity)")} AS quantity_sum""",
    ),
)
def group_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = GroupSpec(
        "lines",
        LINE_SCHEMAS,
        (
            Count("line_cnt"),
            Count("big_cnt", "l_quantity > 25"),
            DistinctCount("big_customers", "l_quantity > 25", ("o_custkey",)),
            Ratio("discount_ratio", top="l_discount > 0.05"),
            Stat("quantity_avg", True, "avg", "l_quantity", 40.0),
            Stat("quantity_sum", True, "sum", "l_quantity"),
        ),
    )
    wide = group_features(_lines(spark, sf_dir), spec)
    return settle(wide, "discount_ratio", "quantity_avg", "quantity_sum")


@query(
    "group_distinct_ratio",
    _patterns_sql(
        LINES_SQL,
        LINE_SCHEMAS,
        ", ".join(
            settled_sql(
                f"count(DISTINCT o_custkey) FILTER (WHERE {top}) / "
                f"CAST(nullif(count(DISTINCT o_custkey) FILTER (WHERE {bottom}), 0) AS DOUBLE)"
            )
            + f" AS {name}"
            for name, top, bottom in (
                ("rich_ratio", "o_totalprice > 400000", "true"),
                ("big_ratio", "l_quantity > 48 AND l_tax < 0.05", "l_tax < 0.05"),
                ("none_ratio", "l_quantity > 999", "l_quantity > 999"),
            )
        ),
    ),
)
def group_distinct_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ("o_custkey",)
    features = (
        DistinctRatio("rich_ratio", columns=key, top="o_totalprice > 400000"),
        DistinctRatio("big_ratio", "l_tax < 0.05", key, top="l_quantity > 48"),
        DistinctRatio("none_ratio", columns=key, bottom="l_quantity > 999"),
    )
    wide = group_features(_lines(spark, sf_dir), GroupSpec("lines", LINE_SCHEMAS, features))
    return settle(wide, *[f.name for f in features])


@query(
    "group_stats",
    _patterns_sql(
        LINES_SQL,
        LINE_SCHEMAS,
        f"""{settled_sql("avg(l_discount) FILTER (WHERE l_tax > 0.02)")} AS discount_avg,
        {settled_sql("stddev_pop(l_quantity)")} AS quantity_std,
        quantile_disc(l_quantity, 0.9) AS quantity_p90,
        count(DISTINCT l_suppkey) AS suppliers""",
    ),
)
def group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = (
        Stat("discount_avg", "l_tax > 0.02", "avg", "l_discount"),
        Stat("quantity_std", True, "stddev_pop", "l_quantity"),
        Percentile("quantity_p90", True, 0.9, "l_quantity"),
        DistinctCount("suppliers", columns=("l_suppkey",)),
    )
    wide = group_features(_lines(spark, sf_dir), GroupSpec("lines", LINE_SCHEMAS, features))
    return settle(wide, "discount_avg", "quantity_std")


ORDER_METRICS = (
    "ord_cnt unpay_cnt fail_cnt unpay_ratio fail_ratio re_cnt sum_order_amount trust_ord_cnt "
    "trust_sum_order_amount trust_unpay_cnt trust_fail_cnt trust_unpay_ratio trust_fail_ratio"
).split()


def _order_columns_sql() -> str:
    trust = "amount > 20"
    trust_unpaid = f"sum(CASE WHEN {trust} THEN 1 - is_pay ELSE 0 END)"
    trust_failed = f"sum(CASE WHEN {trust} THEN is_fail ELSE 0 END)"
    trusted = f"count(CASE WHEN {trust} THEN order_id END)"
    columns = {
        "ord_cnt": "count(*)",
        "unpay_cnt": "sum(1 - is_pay)",
        "fail_cnt": "sum(is_fail)",
        "unpay_ratio": "sum(1 - is_pay) / CAST(count(*) AS DOUBLE)",
        "fail_ratio": "sum(is_fail) / CAST(count(*) AS DOUBLE)",
        "re_cnt": "sum(is_reliable)",
        "sum_order_amount": "sum(amount)",
        "trust_ord_cnt": trusted,
        "trust_sum_order_amount": f"sum(CASE WHEN {trust} THEN amount ELSE 0 END)",
        "trust_unpay_cnt": trust_unpaid,
        "trust_fail_cnt": trust_failed,
        "trust_unpay_ratio": f"{trust_unpaid} / CAST(nullif({trusted}, 0) AS DOUBLE)",
        "trust_fail_ratio": f"{trust_failed} / CAST(nullif({trusted}, 0) AS DOUBLE)",
    }
    return ", ".join(f"{settled_sql(e)} AS {n}" for n, e in columns.items())


ORDER_SCHEMAS = ("l_returnflag,l_suppkey", "l_linestatus", "l_returnflag,l_linenumber")


@query(
    "label_orders",
    _patterns_sql(
        f"SELECT r.*, p.* FROM lineitem r JOIN ({ORDERS_SQL}) p ON CAST(r.l_orderkey AS VARCHAR) = p.request_id",
        ORDER_SCHEMAS,
        _order_columns_sql(),
    ),
)
def label_orders(spark: SparkSession, sf_dir: str, **skew: float | bool) -> DataFrame:
    orders = order_rows(order_performance(spark, sf_dir), DAY)
    requests = table(spark, sf_dir, "lineitem").withColumn(
        "request_id", F.col("l_orderkey").cast("string")
    )
    return settle(order_labels(orders, requests, ORDER_SCHEMAS, **skew), *ORDER_METRICS)


query("label_orders_salted", ORACLE["label_orders"])(partial(label_orders, **SALTED))


SCHEMAS = ("site_id", "city_id,device_model", "site_id,os_type,device_model")
APP_NAMES = ("purchase", "signup", "error")


def _retention_sql(rows: str, prefix: str, shown: bool = True) -> str:
    """Labels of activations `rows` joined to requests, one SELECT per schema."""

    def show(expression: str) -> str:
        return settled_sql(expression) if shown else expression

    columns = [
        f"count(DISTINCT union_imei) AS {prefix}_uimei_cnt",
        f"count(*) FILTER (WHERE retention_day = 0 AND active_ratio IS NOT NULL) AS {prefix}_activation_cnt",
    ]
    for name, first, last in RETENTION_BUCKETS:
        inside = f"retention_day >= {first}"
        if last is not None:
            inside += f" AND retention_day <= {last}"
        scale = (
            f"sum(CASE WHEN {inside} AND stay_time > 1800 THEN 1 / nullif(baseline, 0) ELSE 0 END)"
            f" / CAST(nullif(count(*) FILTER (WHERE {inside} AND baseline IS NOT NULL), 0) AS DOUBLE)"
        )
        columns.append(f"{show(scale)} AS {prefix}_{name}_scale")
    joined = f"SELECT r.*, a.* FROM ({REQUEST_SQL}) r JOIN ({rows}) a ON r.request_id = a.req_id"
    return _patterns_sql(joined, SCHEMAS, ", ".join(columns))


UG_ROWS_SQL = f"""
SELECT * FROM ({ACTIVATIONS_SQL}) WHERE ad_app_name IN ('purchase', 'signup', 'error')
AND app_id IN (SELECT app_id FROM ({APPS_SQL}))
"""
GAME_ROWS_SQL = f"""
SELECT * FROM ({ACTIVATIONS_SQL}) WHERE ad_package_name NOT IN ({PACKAGES_SQL})
"""


def _day_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return day_requests(request_log(spark, sf_dir).withColumn("p_date", F.lit(DAY)), DAY)


def _ug_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_growth_rows(
        activations(spark, sf_dir),
        make_money_apps(spark, sf_dir),
        app_status(spark, sf_dir),
        DAY,
        APP_NAMES,
    )


def _game_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_rows(
        activations(spark, sf_dir),
        make_money_apps(spark, sf_dir),
        app_status(spark, sf_dir),
        sites(spark, sf_dir),
        DAY,
    )


def _order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_rows(order_performance(spark, sf_dir), DAY)


def _settle_scales(df: DataFrame) -> DataFrame:
    return settle(df, *[c for c in df.columns if c.endswith("_scale")])


@query("label_retention", _retention_sql(UG_ROWS_SQL, "ug"))
def label_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, requests = _ug_rows(spark, sf_dir), _day_requests(spark, sf_dir)
    return _settle_scales(retention_labels(rows, requests, SCHEMAS, "ug"))


@query("label_retention_anti", _retention_sql(GAME_ROWS_SQL, "game"))
def label_retention_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, requests = _game_rows(spark, sf_dir), _day_requests(spark, sf_dir)
    return _settle_scales(retention_labels(rows, requests, SCHEMAS, "game"))


_LISTED = "antispam_list_rules LIKE '%UIMEI%' OR antispam_list_rules LIKE '%DID%'"
_BLOCKED = f"ad_source = 1 AND final_decision = 0 AND ({_LISTED})"
REQUEST_GROUP = GroupSpec(
    "requests",
    SCHEMAS,
    (
        DistinctCount("uimei_distinct_cnt", "union_imei != ''", ("union_imei",)),
        Count("req_cnt", "req_id != ''"),
        DistinctRatio("3d_new_uimei_ratio", columns=("union_imei",), top="union_imei_first_time_difference <= 259200"),
        DistinctRatio("black_uimei_ratio", columns=("union_imei",), top="hit_black_device_flag = 1"),
        DistinctRatio("block_uimei_ratio", columns=("union_imei",), top=_BLOCKED),
    ),
    where="req_id != '' AND req_id IS NOT NULL AND ad_source = 1",
)


def _distinct_share(top: str) -> str:
    return (
        f"count(DISTINCT union_imei) FILTER (WHERE {top}) / CAST(count(DISTINCT union_imei) AS DOUBLE)"
    )


_FLAGGED_SQL = f"""SELECT r.*, CASE WHEN b.request_id IS NOT NULL THEN 1 ELSE 0 END AS hit_black_device_flag
    FROM ({REQUEST_SQL}) r LEFT JOIN ({BLACK_SQL}) b ON r.request_id = b.request_id
    WHERE ad_source = 1"""
_FEATURE_COLUMNS = f"""count(DISTINCT union_imei) AS uimei_distinct_cnt, count(*) AS req_cnt,
    {_distinct_share("union_imei_first_time_difference <= 259200")} AS "3d_new_uimei_ratio",
    {_distinct_share("hit_black_device_flag = 1")} AS black_uimei_ratio,
    {_distinct_share(_BLOCKED)} AS block_uimei_ratio"""
FEATURES_SQL = _patterns_sql(_FLAGGED_SQL, SCHEMAS, _FEATURE_COLUMNS)


def _flagged_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = black_hits(spark, sf_dir).withColumn("p_date", F.lit(LAST_DAY))
    log = request_log(spark, sf_dir)
    return requests_flagged(log, hits, LAST_DAY, LAST_HOUR, ALL_HOURS)


def _request_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_features(_flagged_requests(spark, sf_dir), REQUEST_GROUP)


@query(
    "group_request_features",
    f"""
SELECT group_schema, group_pattern, uimei_distinct_cnt, req_cnt,
       {settled_sql('"3d_new_uimei_ratio"')} AS "3d_new_uimei_ratio",
       {settled_sql("black_uimei_ratio")} AS black_uimei_ratio,
       {settled_sql("block_uimei_ratio")} AS block_uimei_ratio
FROM ({FEATURES_SQL})
""",
)
def group_request_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f.name for f in REQUEST_GROUP.features if f.kind == "distinct_ratio"]
    return settle(_request_groups(spark, sf_dir), *names)


_REQUEST_KNOWN = "site_id city_id device_model os_type ip ipc rit".split()


def _all_schemas_sql() -> str:
    columns = {c for s in RESOURCE_V4.schemas for c in s.split(",")}
    empty = ", ".join(
        f"CAST(NULL AS VARCHAR) AS {c}" for c in sorted(columns - set(_REQUEST_KNOWN))
    )
    rows = f"""SELECT r.*, {empty},
    CASE WHEN b.request_id IS NOT NULL THEN 1 ELSE 0 END AS hit_black_device_flag
    FROM ({REQUEST_SQL}) r LEFT JOIN ({BLACK_SQL}) b ON r.request_id = b.request_id
    WHERE ad_source = 1"""
    shares = {
        "3d_new_uimei_ratio": THREE_DAYS,
        "7d_new_uimei_ratio": SEVEN_DAYS,
        "black_uimei_ratio": ON_BLACK_LIST,
        "block_uimei_ratio": BLOCKED,
    }
    shown = ", ".join(f'{settled_sql(_distinct_share(t))} AS "{n}"' for n, t in shares.items())
    counts = "count(DISTINCT union_imei) AS uimei_distinct_cnt, count(*) AS req_cnt"
    return _patterns_sql(rows, RESOURCE_V4.schemas, f"{counts}, {shown}")


@query("group_request_all_schemas", _all_schemas_sql())
def group_request_all_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ready-made spec with seventeen schemas."""
    wide = group_features(_flagged_requests(spark, sf_dir), RESOURCE_V4)
    return settle(wide, *[f.name for f in RESOURCE_V4.features if f.kind == "distinct_ratio"])


def _performance(
    spark: SparkSession, sf_dir: str, groups: DataFrame | None = None
) -> DataFrame:
    if groups is None:
        groups = to_feature_json(_request_groups(spark, sf_dir))
    rows = (_game_rows(spark, sf_dir), _ug_rows(spark, sf_dir), _order_rows(spark, sf_dir))
    return with_labels(groups, all_labels(*rows, _day_requests(spark, sf_dir), SCHEMAS))


_ECOM_ROWS = f"SELECT r.*, p.* EXCLUDE (request_id) FROM ({REQUEST_SQL}) r JOIN ({ORDERS_SQL}) p ON r.request_id = p.request_id"
ECOM_SQL = _patterns_sql(
    _ECOM_ROWS,
    SCHEMAS,
    """CAST(count(*) AS DOUBLE) AS ord_cnt, CAST(sum(1 - is_pay) AS DOUBLE) AS unpay_cnt,
    CAST(sum(is_fail) AS DOUBLE) AS fail_cnt, CAST(sum(is_reliable) AS DOUBLE) AS re_cnt,
    sum(amount) AS sum_order_amount,
    CAST(count(CASE WHEN amount > 20 THEN order_id END) AS DOUBLE) AS trust_ord_cnt,
    sum(CASE WHEN amount > 20 THEN amount ELSE 0 END) AS trust_sum_order_amount,
    CAST(sum(CASE WHEN amount > 20 THEN 1 - is_pay ELSE 0 END) AS DOUBLE) AS trust_unpay_cnt,
    CAST(sum(CASE WHEN amount > 20 THEN is_fail ELSE 0 END) AS DOUBLE) AS trust_fail_cnt""",
)
PERFORMANCE_SQL = f"""
SELECT g.*, ga.* EXCLUDE (group_schema, group_pattern), ug.* EXCLUDE (group_schema, group_pattern),
       ec.* EXCLUDE (group_schema, group_pattern),
       ga.group_schema IS NOT NULL AS has_game, ug.group_schema IS NOT NULL AS has_ug,
       ec.group_schema IS NOT NULL AS has_ecom
FROM ({FEATURES_SQL}) g
LEFT JOIN ({_retention_sql(GAME_ROWS_SQL, "game", False)}) ga
  ON g.group_schema = ga.group_schema AND g.group_pattern = ga.group_pattern
LEFT JOIN ({_retention_sql(UG_ROWS_SQL, "ug", False)}) ug
  ON g.group_schema = ug.group_schema AND g.group_pattern = ug.group_pattern
LEFT JOIN ({ECOM_SQL}) ec
  ON g.group_schema = ec.group_schema AND g.group_pattern = ec.group_pattern
"""


@query(
    "perf_join",
    f"""
SELECT group_schema, group_pattern, CAST(uimei_distinct_cnt AS DOUBLE) AS uimei_distinct_cnt,
       CAST(game_activation_cnt AS DOUBLE) AS game_activation_cnt,
       {settled_sql("game_day_3_10_scale")} AS game_day_3_10_scale,
       CAST(ug_activation_cnt AS DOUBLE) AS ug_activation_cnt,
       {settled_sql("ug_day_3_10_scale")} AS ug_day_3_10_scale,
       ord_cnt, {settled_sql("sum_order_amount")} AS sum_order_amount
FROM ({PERFORMANCE_SQL})
""",
)
def perf_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {
        "feature_json": ("uimei_distinct_cnt",),
        "game_json": ("game_activation_cnt", "game_day_3_10_scale"),
        "ug_json": ("ug_activation_cnt", "ug_day_3_10_scale"),
        "ecom_json": ("ord_cnt", "sum_order_amount"),
    }
    columns = [
        json_number(json_texts(F.col(column), names), name).alias(name)
        for column, names in fields.items()
        for name in names
    ]
    shown = _performance(spark, sf_dir).select("group_schema", "group_pattern", *columns)
    return settle(shown, "game_day_3_10_scale", "ug_day_3_10_scale", "sum_order_amount")


STRATEGIES = (
    Strategy(
        "site_id",
        (
            GridDim("black_uimei_ratio", 0.02, 0.2, 0.05),
            GridDim("uimei_distinct_cnt", 5, 60, 10),
        ),
    ),
    Strategy(
        "city_id,device_model",
        (
            GridDim("block_uimei_ratio", 0.2, 0.9, 0.1),
            GridDim("3d_new_uimei_ratio", 0.2, 0.9, 0.1),
            GridDim("req_cnt", 10, 200, 30),
        ),
    ),
    Strategy("site_id,os_type,device_model", (GridDim("uimei_distinct_cnt", 2, 20, 3),)),
)
TARGETS = (
    "ord_cnt >= 30",
    "trust_fail_ratio >= 0.30",
    "game_activation_cnt >= 1",
    "game_day_3_10_scale <= 5.0",
)


def _steps_sql(value: str, dim: GridDim) -> str:
    grid = (
        f"list_transform(range(0, CAST(floor(({dim.high}::DOUBLE - {dim.low}::DOUBLE) / {dim.step}::DOUBLE) AS BIGINT) + 1), "
        f"lambda i: round({dim.low}::DOUBLE + i * {dim.step}::DOUBLE, 3))"
    )
    full = f"CASE WHEN list_max({grid}) < {dim.high}::DOUBLE THEN list_append({grid}, {dim.high}::DOUBLE) ELSE {grid} END"
    reached = f"list_filter({full}, lambda t: t <= coalesce(CAST({value} AS DOUBLE), -1.0))"
    return f"unnest(CASE WHEN len({reached}) > 0 THEN {reached} ELSE [-1.0::DOUBLE] END)"


def _rules_sql(rows: str, strategies: Sequence[Strategy] = STRATEGIES) -> str:
    """Every (row, rule) pair of the naive expansion."""
    parts = []
    for strategy in strategies:
        inner = f"SELECT * FROM ({rows}) WHERE group_schema = '{strategy.schema}'"
        for i, dim in enumerate(strategy.grid):
            inner = f"""SELECT *, {_steps_sql(f'"{dim.feature}"', dim)} AS t{i} FROM ({inner})"""
        text = " || ' and ' || ".join(
            f"'{d.feature} >= ' || CAST(t{i} AS VARCHAR)" for i, d in enumerate(strategy.grid)
        )
        drop = ", ".join(f"t{i}" for i in range(len(strategy.grid)))
        parts.append(f"SELECT * EXCLUDE ({drop}), {text} AS rule_condition FROM ({inner})")
    return " UNION ALL ".join(parts)


@query(
    "rule_expand",
    f"""SELECT group_schema, rule_condition, count(*) AS groups, sum(req_cnt)::BIGINT AS requests
    FROM ({_rules_sql(FEATURES_SQL)}) GROUP BY ALL""",
)
def rule_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = to_feature_json(_request_groups(spark, sf_dir))
    requests = json_number(json_texts(F.col("feature_json"), ("req_cnt",)), "req_cnt")
    measures = {
        "groups": F.count(F.lit(1)),
        "requests": F.sum(requests.cast("bigint")),
    }
    return expand_rules(groups, STRATEGIES, measures).drop("rule")


def _metrics_sql() -> dict[str, str]:
    def total(name: str) -> str:
        return f"sum({name})"

    def over(top: str, bottom: str) -> str:
        return f"sum({top}) / nullif(sum({bottom}), 0)"

    metrics = {
        "ord_cnt": total("ord_cnt"),
        "unpay_cnt": total("unpay_cnt"),
        "fail_cnt": total("fail_cnt"),
        "reliable_cnt": total("re_cnt"),
        "unpay_ratio": over("unpay_cnt", "ord_cnt"),
        "fail_ratio": over("fail_cnt", "ord_cnt"),
        "sum_order_amount": total("sum_order_amount"),
        "order_amount_avg": over("sum_order_amount", "ord_cnt"),
        "trust_ord_cnt": total("trust_ord_cnt"),
        "trust_sum_order_amount": total("trust_sum_order_amount"),
        "trust_unpay_cnt": total("trust_unpay_cnt"),
        "trust_fail_cnt": total("trust_fail_cnt"),
        "trust_unpay_ratio": over("trust_unpay_cnt", "trust_ord_cnt"),
        "trust_fail_ratio": over("trust_fail_cnt", "trust_ord_cnt"),
        "trust_order_amount_avg": over("trust_sum_order_amount", "trust_ord_cnt"),
    }
    for prefix in ("ug", "game"):
        count = f"CAST({prefix}_activation_cnt AS DOUBLE)"
        metrics[f"{prefix}_activation_cnt"] = f"sum({count})"
        for bucket in ("day_0", "day_1", "day_2", "day_3_10", "day_3_30"):
            scale = f"{prefix}_{bucket}_scale"
            known = f"sum(CASE WHEN {scale} IS NOT NULL THEN {count} END)"
            metrics[f"{prefix}_{bucket}_activation_cnt"] = known
            metrics[scale] = f"sum({scale} * {count}) / nullif({known}, 0)"
    return metrics


MINED_SQL = f"""
SELECT group_schema, rule_condition, {", ".join(f"{e} AS {n}" for n, e in _metrics_sql().items())}
FROM ({_rules_sql(PERFORMANCE_SQL)}) WHERE has_game OR has_ug OR has_ecom
GROUP BY group_schema, rule_condition
"""


@query(
    "strategy_mining",
    f"""SELECT group_schema, rule_condition, {", ".join(f"{settled_sql(n)} AS {n}" for n in _metrics_sql())}
    FROM ({MINED_SQL})""",
)
def strategy_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    mined = mine_strategies(_performance(spark, sf_dir), STRATEGIES).drop("rule")
    return settle(mined, *metric_names())


@query(
    "pattern_match",
    f"""
SELECT DISTINCT p.group_schema, p.group_pattern FROM ({_rules_sql(FEATURES_SQL)}) p
JOIN (SELECT * FROM ({MINED_SQL}) WHERE {" AND ".join(TARGETS)}) s
ON p.group_schema = s.group_schema AND p.rule_condition = s.rule_condition
""",
)
def pattern_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = to_feature_json(_request_groups(spark, sf_dir))
    table_form = strategies_json(
        mine_strategies(_performance(spark, sf_dir, groups), STRATEGIES)
    )
    matched = match_patterns(groups, good_rules(table_form, TARGETS), STRATEGIES)
    return matched.select("group_schema", "group_pattern")


# One grid over six features, as the heaviest spec has, on few points each.
WIDE_SCHEMAS = ("site_id,os_type,device_model", "city_id,device_model")
WIDE_GROUP = GroupSpec(
    "wide",
    WIDE_SCHEMAS,
    (
        *REQUEST_GROUP.features,
        DistinctRatio("7d_new_uimei_ratio", columns=("union_imei",), top=SEVEN_DAYS),
    ),
    where=REQUEST_GROUP.where,
)
WIDE_STRATEGIES = tuple(
    Strategy(
        schema,
        (
            GridDim("black_uimei_ratio", 0.1, 0.7, 0.3),
            GridDim("block_uimei_ratio", 0.2, 0.6, 0.4),
            GridDim("3d_new_uimei_ratio", 0.3, 0.9, 0.3),
            GridDim("7d_new_uimei_ratio", 0.3, 0.9, 0.3),
            GridDim("uimei_distinct_cnt", 2, 10, 4),
            GridDim("req_cnt", 2, 22, 10),
        ),
    )
    for schema in WIDE_SCHEMAS
)
_WIDE_SQL = _patterns_sql(
    _FLAGGED_SQL,
    WIDE_SCHEMAS,
    f"""{_FEATURE_COLUMNS}, {_distinct_share(SEVEN_DAYS)} AS "7d_new_uimei_ratio\"""",
)
_WIDE_EXPANDED_SQL = f"""SELECT group_schema, rule_condition, count(*) AS groups, sum(req_cnt)::BIGINT AS requests
    FROM ({_rules_sql(_WIDE_SQL, WIDE_STRATEGIES)}) GROUP BY ALL"""
# Rules that so many groups meet count as good.
_WIDE_GROUPS = 20


def _wide_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_feature_json(group_features(_flagged_requests(spark, sf_dir), WIDE_GROUP))


def _wide_rules(groups: DataFrame) -> DataFrame:
    requests = json_number(json_texts(F.col("feature_json"), ("req_cnt",)), "req_cnt")
    measures = {"groups": F.count(F.lit(1)), "requests": F.sum(requests.cast("bigint"))}
    return expand_rules(groups, WIDE_STRATEGIES, measures).drop("rule")


@query("strategy_mining_wide", _WIDE_EXPANDED_SQL)
def strategy_mining_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of a six-feature grid with the groups and requests that meet it."""
    return _wide_rules(_wide_groups(spark, sf_dir))


@query(
    "pattern_match_wide",
    f"""
SELECT DISTINCT p.group_schema, p.group_pattern FROM ({_rules_sql(_WIDE_SQL, WIDE_STRATEGIES)}) p
JOIN (SELECT * FROM ({_WIDE_EXPANDED_SQL}) WHERE groups >= {_WIDE_GROUPS} AND rule_condition LIKE '%ratio >= 0.%req_cnt >= 2.0%') s
ON p.group_schema = s.group_schema AND p.rule_condition = s.rule_condition
""",
)
def pattern_match_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups that meet a good rule of the six-feature grid, cells joined by shuffling."""
    groups = _wide_groups(spark, sf_dir)
    good = (F.col("groups") >= _WIDE_GROUPS) & F.col("rule_condition").like("%ratio >= 0.%req_cnt >= 2.0%")
    rules = _wide_rules(groups).where(good).select("group_schema", "rule_condition")
    matched = match_patterns(groups, rules, WIDE_STRATEGIES, 0, share=1 / 100, floor=0)
    return matched.select("group_schema", "group_pattern")
