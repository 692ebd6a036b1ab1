"""Ready-made specs for the logs of `sources.logs`.

Fixed values: feature names, conditions, schemas and grids are what downstream
tables and models know these features by.
"""

from __future__ import annotations

from ..operators.entity import Entity, FeatureGroup
from ..operators.features import (
    Count,
    DistinctCount,
    DistinctRatio,
    Feature,
    Percentile,
    Ratio,
    Stat,
    TopNRatio,
)
from ..operators.groups import GroupSpec
from ..operators.iat import IatKey, IatRatio, IatStat, IatStep, InterArrival
from ..operators.merge import MergedFeature
from ..operators.rules import GridDim, Strategy
from .jobs import MergeSpec

DEVICE = ("union_imei",)
THREE_DAYS = "union_imei_first_time_difference <= 259200"
SEVEN_DAYS = "union_imei_first_time_difference <= 604800"
ON_BLACK_LIST = "hit_black_device_flag = 1"
BLOCKED = (
    "ad_source = 1 AND final_decision = 0 AND (antispam_list_rules LIKE '%UIMEI%'"
    " OR antispam_list_rules LIKE '%DID%' OR antispam_list_rules LIKE '%SEC_DID%')"
)

# Devices over convert events.
DEVICE_CONVERT = FeatureGroup(
    "DEVICE_CONVERT_FEATURE",
    (
        Entity(
            DEVICE,
            (
                DistinctCount(
                    "device_all_app_distinct_cnt", "app_id != 0 AND app_id != -1", ("app_id",)
                ),
                Count("device_all_convert_cnt"),
                Ratio("device_all_app_risk_ratio", top="app_flag IN (12, 42)"),
                TopNRatio(
                    "device_all_app_top1_ratio", "app_id != 0 AND app_id != -1", ("app_id",), 1
                ),
                Stat("device_all_ecpm_rmb_avg", "ecpm_rmb > 0.0", "avg", "ecpm_rmb", 5000.0),
            ),
            (
                InterArrival(
                    ("at_time_timestamp",),
                    (
                        IatKey(
                            "at_time_timestamp",
                            (
                                IatStep(
                                    "minus",
                                    (
                                        IatStat("device_all_iat_avg", "avg"),
                                        IatStat("device_all_iat_std", "stddev_pop"),
                                        IatRatio(
                                            "device_all_iat_le30s_ratio",
                                            top="iat <= 30",
                                            where="iat IS NOT NULL",
                                        ),
                                    ),
                                    where="at_time_timestamp IS NOT NULL",
                                    clip=3600.0,
                                ),
                            ),
                        ),
                    ),
                ),
            ),
        ),
    ),
    where="union_imei IS NOT NULL AND union_imei != ''",
)


def device_convert_merge(version: str) -> MergeSpec:
    """The wide form of DEVICE_CONVERT."""
    return MergeSpec(
        DEVICE_CONVERT.name,
        "union_imei",
        DEVICE_CONVERT.kinds,
        version,
        (
            MergedFeature("device_all_app_distinct_cnt", clip=1000.0),
            MergedFeature("device_all_convert_cnt", clip=5000.0, func="log"),
            MergedFeature("device_all_app_risk_ratio"),
            MergedFeature("device_all_app_top1_ratio"),
            MergedFeature("device_all_ecpm_rmb_avg"),
            MergedFeature("device_all_iat_avg"),
            MergedFeature("device_all_iat_std"),
            MergedFeature("device_all_iat_le30s_ratio"),
        ),
        population=True,
    )


def _battery() -> tuple[Feature, ...]:
    known, column = "battery_remaining_pct IS NOT NULL", "battery_remaining_pct"
    return (
        Stat("battery_remaining_avg", known, "avg", column, 1000.0),
        Stat("battery_remaining_sum", known, "sum", column, 1000.0),
        Percentile("battery_remaining_pt90", known, 0.9, column, 1000.0),
    )


def _devices() -> Feature:
    return DistinctCount("uimei_distinct_cnt", "union_imei != ''", DEVICE)


def _device_share(name: str, top: str, where: str | bool = "req_id != ''") -> Feature:
    return DistinctRatio(name, where, DEVICE, top)


def convert_groups(name: str) -> GroupSpec:
    """Patterns of the wide convert log."""
    return GroupSpec(
        name,
        ("site_id,city_id,model", "site_id,city_id,district_id,rom_version"),
        (
            _devices(),
            Count("convert_cnt", "req_id != ''"),
            Ratio("new_uimei_convert_ratio", "req_id != ''", THREE_DAYS),
            _device_share("new_uimei_ratio", THREE_DAYS),
            *_battery(),
        ),
        where="req_id != ''",
    )


REQUESTS = "req_id != '' AND req_id IS NOT NULL AND ad_source = 1"
PLACES = ("site_id,city_id,device_model", "site_id,city_id,district_id,rom_version")


def request_groups(name: str) -> GroupSpec:
    """Patterns of the request log, without rules."""
    return GroupSpec(
        name,
        PLACES,
        (
            _devices(),
            Count("req_cnt", "req_id != ''"),
            Ratio("new_uimei_req_ratio", "req_id != ''", THREE_DAYS),
            _device_share("new_uimei_ratio", THREE_DAYS),
            *_battery(),
        ),
        where=REQUESTS,
    )


def _resource_features() -> tuple[Feature, ...]:
    return (
        _devices(),
        Count("req_cnt", "req_id != ''"),
        _device_share("new_uimei_ratio", THREE_DAYS),
        _device_share("block_uimei_ratio", ON_BLACK_LIST),
        _device_share("black_uimei_ratio", BLOCKED),
    )


def _strategy(schema: str, *dims: tuple[str, float, float, float]) -> Strategy:
    return Strategy(schema, tuple(GridDim(*d) for d in dims))


_COARSE = ("uimei_distinct_cnt", 10, 100, 20)
_FINE = ("uimei_distinct_cnt", 5, 100, 10)

# Two schemas of the flagged request log.
RESOURCE = GroupSpec(
    "REQ_GROUP_DEVICE_RESOURCE", PLACES, _resource_features(), where=REQUESTS
)
RESOURCE_STRATEGIES = (
    _strategy(
        PLACES[0], ("black_uimei_ratio", 0.2, 0.9, 0.1), ("block_uimei_ratio", 0.3, 0.9, 0.1), _FINE
    ),
    _strategy(
        PLACES[1], ("block_uimei_ratio", 0.2, 0.9, 0.1), ("black_uimei_ratio", 0.3, 0.9, 0.1), _COARSE
    ),
)

# Eleven schemas; two of them only have features, no rules.
MODEL_SCHEMAS = (
    "site_id,ipc,device_model,rom_version",
    "site_id,city_id,device_model",
    "site_id,ad_slot_type,device_model",
    "wifi_mac",
    "ipc,device_model",
    "device_model,rom_version,os_version",
    "device_vendor,device_model,os_type,os_version",
    "device_vendor,device_model,rom_version",
    "device_vendor,device_model,mac",
    "device_vendor,device_model,wifi_mac",
    "ad_slot_type,device_vendor,device_model,rom_version",
)
_RULED = (
    "site_id,ipc,device_model,rom_version",
    "site_id,city_id,device_model",
    "site_id,ad_slot_type,device_model",
    "wifi_mac",
    "ipc,device_model",
    "device_model,rom_version,os_version",
    "device_vendor,device_model,rom_version",
    "device_vendor,device_model,mac",
    "ad_slot_type,device_vendor,device_model,rom_version",
)
RESOURCE_V1 = GroupSpec(
    "REQ_GROUP_DEVICE_RESOURCE_V1", MODEL_SCHEMAS, _resource_features(), where=REQUESTS
)
RESOURCE_V1_STRATEGIES = (
    _strategy(
        _RULED[0], ("black_uimei_ratio", 0.2, 0.9, 0.1), ("block_uimei_ratio", 0.3, 0.9, 0.1), _FINE
    ),
    *[
        _strategy(
            s, ("block_uimei_ratio", 0.2, 0.9, 0.1), ("black_uimei_ratio", 0.3, 0.9, 0.1), _COARSE
        )
        for s in _RULED[1:]
    ],
)

# The same schemas over the final decision alone.
RESOURCE_V3 = GroupSpec(
    "REQ_GROUP_DEVICE_RESOURCE_V3",
    MODEL_SCHEMAS,
    (
        *_resource_features()[:3],
        _device_share("black_uimei_ratio", "final_decision = 0"),
    ),
    where=REQUESTS,
)
RESOURCE_V3_STRATEGIES = (
    _strategy(_RULED[0], ("black_uimei_ratio", 0.2, 0.9, 0.1), _FINE),
    *[_strategy(s, ("black_uimei_ratio", 0.3, 0.9, 0.1), _COARSE) for s in _RULED[1:]],
)

# Seventeen schemas with one grid over six features, and targets for good rules.
RESOURCE_V4 = GroupSpec(
    "REQ_GROUP_DEVICE_RESOURCE_V4",
    (
        "mac",
        "wifi_mac",
        "device_vendor,device_model,os_type",
        "device_vendor,device_model,os_type,os_version",
        "device_vendor,device_model,os_type,rom_version",
        "device_vendor,device_model,os_type,screen_width,screen_height",
        "device_vendor,device_model,os_type,os_version,rom_version",
        "device_vendor,device_model,os_type,ipc",
        "device_vendor,device_model,os_type,city_id",
        "device_vendor,device_model,os_type,district_id",
        "device_vendor,device_model,os_type,ip",
        "device_vendor,device_model,os_type,site_id",
        "device_vendor,device_model,os_type,media_id",
        "device_vendor,device_model,os_type,rit",
        "device_vendor,device_model,os_type,os_version,ad_slot_type",
        "device_vendor,device_model,os_type,rom_version,ad_slot_type",
        "device_vendor,device_model,os_type,screen_width,screen_height,ad_slot_type",
    ),
    (
        _devices(),
        Count("req_cnt", "req_id != ''"),
        _device_share("3d_new_uimei_ratio", THREE_DAYS, True),
        _device_share("7d_new_uimei_ratio", SEVEN_DAYS, True),
        _device_share("black_uimei_ratio", ON_BLACK_LIST, True),
        _device_share("block_uimei_ratio", BLOCKED, True),
    ),
    where=f"{REQUESTS} AND union_imei IS NOT NULL AND union_imei != ''",
)
RESOURCE_V4_STRATEGIES = tuple(
    _strategy(
        s,
        ("black_uimei_ratio", 0.2, 0.9, 0.1),
        ("block_uimei_ratio", 0.2, 0.9, 0.1),
        ("3d_new_uimei_ratio", 0.2, 0.9, 0.1),
        ("7d_new_uimei_ratio", 0.2, 0.9, 0.1),
        ("uimei_distinct_cnt", 5, 100, 5),
        ("req_cnt", 10, 200, 10),
    )
    for s in RESOURCE_V4.schemas
)
RESOURCE_V4_TARGETS = (
    "ug_activation_cnt >= 30",
    "ug_day_3_10_scale <= 0.1",
    "game_activation_cnt >= 30",
    "game_day_3_10_scale <= 0.1",
    "ord_cnt >= 30",
    "trust_fail_ratio >= 0.8",
)
