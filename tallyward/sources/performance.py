"""Ad-performance tables: JSON columns to typed rows, one parse per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import LABEL_DISPOSAL_TAGS, PLACEMENT_FLOOR
from ..functions.scalars import unpack_json
from ..operators.joins import drop_listed, keep_listed
from .logs import risk_apps, risk_packages

ORDER_NUMBERS = (
    "create_order_amount",
    "is_pay",
    "is_fail",
    "is_reliable",
    "is_refunded",
    "is_cancel",
)
ORDER_TEXTS = ("rit", "req_id", "order_id", "union_imei")
ACTIVATION_NUMBERS = (
    "stay_time",
    "union_baseline_active_ratio",
    "union_baseline_1800_ratio",
)
GAME_TEXTS = ("rit", "ad_package_name", "union_imei", "req_id")
USER_GROWTH_TEXTS = ("app_id", "ad_app_name", *GAME_TEXTS)


def _unpacked(table: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> DataFrame:
    """The date column, `numbers` of feature_json as doubles, `texts` of extra_json."""
    rows = unpack_json(table, "feature_json", numbers)
    rows = unpack_json(rows, "extra_json", texts)
    return rows.withColumns({n: F.col(n).try_cast("double") for n in numbers})


def order_rows(table: DataFrame, date: str) -> DataFrame:
    """Orders of a day on placements from the floor upwards."""
    day = table.where(F.col("p_date") == date)
    rows = _unpacked(
        day.select("p_date", "feature_json", "extra_json"), ORDER_NUMBERS, ORDER_TEXTS
    )
    return rows.where(F.col("rit").try_cast("bigint") >= PLACEMENT_FLOOR).select(
        *ORDER_NUMBERS,
        "rit",
        F.col("req_id").alias("request_id"),
        "order_id",
        F.col("union_imei").alias("uimei"),
        "p_date",
    )


def activation_rows(table: DataFrame, date: str, texts: Sequence[str]) -> DataFrame:
    """Activations of a day with stay time, baselines and retention day."""
    day = table.where(F.col("date") == date)
    rows = _unpacked(
        day.select("date", "feature_json", "extra_json"),
        ACTIVATION_NUMBERS,
        (*texts, "retention_day"),
    )
    return rows.withColumn("retention_day", F.col("retention_day").try_cast("double"))


def user_growth_rows(
    table: DataFrame,
    make_money: DataFrame,
    app_status: DataFrame,
    date: str,
    app_names: Sequence[str],
) -> DataFrame:
    """Activations of the named advertised apps that came from risk apps."""
    rows = activation_rows(table, date, USER_GROWTH_TEXTS)
    risky = risk_apps(make_money, app_status, date, LABEL_DISPOSAL_TAGS)
    return keep_listed(rows.where(F.col("ad_app_name").isin(*app_names)), risky, "app_id")


def game_rows(
    table: DataFrame,
    make_money: DataFrame,
    app_status: DataFrame,
    sites: DataFrame,
    date: str,
) -> DataFrame:
    """Game activations except those of risk packages."""
    rows = activation_rows(table, date, GAME_TEXTS)
    apps = risk_apps(make_money, app_status, date, LABEL_DISPOSAL_TAGS)
    packages = risk_packages(apps, sites, date).withColumnRenamed(
        "package_name", "ad_package_name"
    )
    return drop_listed(rows, packages, "ad_package_name")
