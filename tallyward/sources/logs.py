"""Logs as DataFrames: convert events, wide converts, requests.

Each function takes the raw tables and the window and stays lazy, so column
pruning and partition pruning reach the scans.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CONVERT_BUSINESS_LINE,
    CONVERT_DISPOSAL_TAGS,
    CONVERT_LABEL,
    MAKE_MONEY_FIRST_TAG,
    MAKE_MONEY_TAG,
    PASSING_POLICIES,
    PLACEMENT_FLOOR,
)
from ..functions.predicates import in_window
from ..functions.scalars import (
    ecpm_bin,
    ecpm_price,
    ip_prefix,
    json_texts,
    time_difference,
)
from ..operators.joins import flag_join, keep_listed, tag_lookup
from .columns import (
    BLACK_FLAG,
    CONVERT_EVENT_COLUMNS,
    CONVERT_WIDE_COLUMNS,
    REQUEST_COLUMNS,
    UNFLAGGED_ONLY,
)


def risk_apps(
    make_money: DataFrame,
    app_status: DataFrame,
    date: str,
    tags: Iterable[int],
    hour: str | None = None,
) -> DataFrame:
    """Distinct (app_id, app_type): make-money apps and apps under disposal.

    App ids are texts, so both lists and their users compare alike.
    """
    money = make_money.where(
        (F.col("date") == date) & (F.col("first_tag_name") == MAKE_MONEY_FIRST_TAG)
    ).select(
        F.col("site_id").cast("string").alias("app_id"),
        F.lit(MAKE_MONEY_TAG).alias("app_type"),
    )
    disposed = app_status.where(
        (F.col("p_date") == date)
        & F.col("disposal_tag").isin(*tags)
        & (F.col("is_effective") == "true")
    )
    if hour is not None:
        disposed = disposed.where(F.col("hour") == hour)
    status = disposed.select(
        F.col("app_id").cast("string").alias("app_id"),
        F.col("disposal_tag").cast("int").alias("app_type"),
    )
    return money.union(status).distinct()


def risk_packages(apps: DataFrame, sites: DataFrame, date: str) -> DataFrame:
    """Distinct package names of risk apps, whose text ids are cast to site ids."""
    ids = apps.select(F.col("app_id").try_cast("bigint").alias("site_id"))
    listed = sites.where(F.col("p_date") == date)
    return listed.join(ids, "site_id", "left_semi").select("package_name").distinct()


def black_requests(hits: DataFrame, date: str) -> DataFrame:
    """Distinct request ids hit by a policy that counts; a NULL policy does not."""
    return (
        hits.where(
            (F.col("p_date") == date) & ~F.col("hit_policy").isin(*PASSING_POLICIES)
        )
        .select("request_id")
        .distinct()
    )


def device_list(devices: DataFrame, date: str, hour: str) -> DataFrame:
    """Device ids of one hour; users join it as a semi join."""
    return devices.where((F.col("p_date") == date) & (F.col("hour") == hour)).select(
        "union_imei"
    )


def convert_events(
    ad_stats: DataFrame,
    devices: DataFrame,
    make_money: DataFrame,
    app_status: DataFrame,
    date: str,
    hour: str,
    hours: int,
) -> DataFrame:
    """Converts of listed devices with app flag, IP prefixes, delays and price bin."""
    fields = json_texts(
        F.col("external_json"), ("client_ip", "device_model", "room_id", "click_at")
    )
    raw = in_window(ad_stats, date, hour, hours).where(
        (F.col("biz_line") == CONVERT_BUSINESS_LINE)
        & (F.col("rit") > PLACEMENT_FLOOR)
        & (F.col("label") == CONVERT_LABEL)
    )
    listed = keep_listed(
        raw.withColumn("union_imei", F.col("union_uuid")),
        device_list(devices, date, hour),
        "union_imei",
    )
    click, at, sent = (
        F.col(f"{n}_time_timestamp") for n in ("click", "at", "send")
    )
    events = (
        listed.withColumn("_json", fields)
        .withColumns(
            {
                "ip": F.col("_json.client_ip"),
                "device_model": F.col("_json.device_model"),
                "room_id": F.col("_json.room_id"),
                "ecpm_rmb": ecpm_price(F.col("ecpm")),
                "ecpm_bin": ecpm_bin(F.col("ecpm")),
                "click_time_timestamp": F.col("_json.click_at").try_cast("bigint"),
                "at_time_timestamp": F.col("at").try_cast("bigint"),
                "send_time_timestamp": F.col("ot").try_cast("bigint"),
                "app_key": F.col("app_id").cast("string"),
            }
        )
        .withColumns(
            {
                "ipc": ip_prefix(F.col("ip"), 3),
                "ipb": ip_prefix(F.col("ip"), 2),
                "click_send_tdiff": time_difference(click, sent),
                "convert_click_tdiff": time_difference(at, click),
                "convert_send_tdiff": time_difference(at, sent),
            }
        )
    )
    apps = risk_apps(make_money, app_status, date, CONVERT_DISPOSAL_TAGS, hour)
    tags = apps.withColumnRenamed("app_id", "app_key")
    flagged = tag_lookup(events, tags, "app_key", "app_type", "app_flag")
    return flagged.select(*CONVERT_EVENT_COLUMNS)


def convert_wide(log: DataFrame, date: str, hour: str, hours: int) -> DataFrame:
    """The wide convert log of a trailing window."""
    return in_window(log, date, hour, hours).select(*CONVERT_WIDE_COLUMNS)


def requests(log: DataFrame, date: str, hour: str, hours: int) -> DataFrame:
    """The request log of a trailing window, with `req_id` and `ipc`."""
    raw = in_window(log, date, hour, hours, date_col="p_date")
    return raw.withColumns(
        {"req_id": F.col("request_id"), "ipc": ip_prefix(F.col("ip"), 3)}
    ).select(*REQUEST_COLUMNS)


def requests_flagged(
    log: DataFrame, hits: DataFrame, date: str, hour: str, hours: int
) -> DataFrame:
    """The request log with a 0/1 flag for requests on the day's black list."""
    kept = [c for c in REQUEST_COLUMNS if c not in UNFLAGGED_ONLY]
    listed = black_requests(hits, date).withColumnRenamed("request_id", "req_id")
    rows = requests(log, date, hour, hours).select(*kept)
    flagged = flag_join(rows, listed, "req_id", BLACK_FLAG)
    at = kept.index("p_date")
    return flagged.select(*kept[:at], BLACK_FLAG, *kept[at:])


def day_requests(log: DataFrame, date: str) -> DataFrame:
    """All requests of a day, for labels, under their raw id name."""
    return log.where(F.col("p_date") == date).withColumn(
        "ipc", ip_prefix(F.col("ip"), 3)
    )
