"""Ad-performance labels per group pattern: retention and orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import RETENTION_BUCKETS, STAY_SECONDS, TRUSTED_AMOUNT
from .groups import check_schemas, explode_schemas, name_schemas, schema_columns
from .skew import skew_join

REQUEST = "request_id"
DEVICE = "union_imei"


def _tallies(sums: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in sums.items()]


def _labelled_requests(
    tallies: DataFrame,
    requests: DataFrame,
    schemas: Sequence[str],
    names: Sequence[str],
    device: str | None,
    skew: Mapping[str, float | bool],
) -> DataFrame:
    """Requests with the tallies of their id, once per schema.

    `tallies` has one row per request id, so the join never multiplies rows,
    however often an id repeats on either side.
    """
    needed = {c for s in schemas for c in schema_columns(s)} - {REQUEST}
    if device:
        needed.add(device)
    needed = sorted(c for c in needed if c not in names)
    joined = skew_join(requests.select(REQUEST, *needed), tallies, [REQUEST], "inner", **skew)
    carried = {n: F.col(n) for n in names}
    if device:
        carried["_device"] = F.col(device)
    return explode_schemas(joined, schemas, carried)


def retention_labels(
    activations: DataFrame,
    requests: DataFrame,
    schemas: Sequence[str],
    prefix: str,
    **skew: float | bool,
) -> DataFrame:
    """Devices, activations and retention against the baseline, per pattern.

    `activations` has req_id, retention_day, stay_time and the two baselines.
    A bucket's scale is the sum of 1 / baseline over retained rows divided by
    the rows with a baseline; every part is a sum, so activations are reduced
    to one row per request id before the join and per device after it.
    """
    check_schemas(schemas)
    tallies, names = _retention_tallies(activations)
    rows = _labelled_requests(tallies, requests, schemas, names, DEVICE, skew)

    by = ("_schema", "group_pattern")
    again = {n: F.sum(n) for n in names}
    totals = (
        rows.groupBy(*by, "_device")
        .agg(*_tallies(again))
        .groupBy(*by)
        .agg(F.count("_device").alias("_devices"), *_tallies(again))
    )
    return name_schemas(totals.select(*by, *_retention_columns(prefix)), schemas)


def _retention_tallies(activations: DataFrame) -> tuple[DataFrame, list[str]]:
    """Sums per request id, and their names."""
    day = F.col("retention_day")
    baseline = F.col("union_baseline_1800_ratio")
    retained = F.col("stay_time") > STAY_SECONDS
    active = F.col("union_baseline_active_ratio").isNotNull()
    sums = {"_activations": F.count_if((day == 0) & active)}
    for name, first, last in RETENTION_BUCKETS:
        inside = day >= first
        if last is not None:
            inside &= day <= last
        expected = F.try_divide(F.lit(1.0), baseline)
        in_bucket = F.coalesce(inside & retained, F.lit(False))
        sums[f"_expect_{name}"] = F.sum(
            F.when(in_bucket, expected).otherwise(F.lit(0.0))
        )
        sums[f"_based_{name}"] = F.count_if(inside & baseline.isNotNull())
    tallies = activations.groupBy(F.col("req_id").alias(REQUEST)).agg(*_tallies(sums))
    return tallies, list(sums)


def _retention_columns(prefix: str, at: str = "") -> list[Column]:
    """Labels from sums per pattern whose names begin with `at`."""
    return [
        F.col(f"{at}_devices").alias(f"{prefix}_uimei_cnt"),
        F.col(f"{at}_activations").alias(f"{prefix}_activation_cnt"),
        *[
            F.try_divide(f"{at}_expect_{name}", f"{at}_based_{name}").alias(
                f"{prefix}_{name}_scale"
            )
            for name, _, _ in RETENTION_BUCKETS
        ],
    ]


def order_labels(
    orders: DataFrame, requests: DataFrame, schemas: Sequence[str], **skew: float | bool
) -> DataFrame:
    """Order counts, failures and amounts per pattern, also for trusted orders.

    `orders` has request_id, order_id, create_order_amount, is_pay, is_fail and
    is_reliable.
    """
    check_schemas(schemas)
    tallies, names = _order_tallies(orders)
    rows = _labelled_requests(tallies, requests, schemas, names, None, skew)
    by = ("_schema", "group_pattern")
    totals = rows.groupBy(*by).agg(*_tallies({n: F.sum(n) for n in names}))
    return name_schemas(totals.select(*by, *_order_columns()), schemas)


def _order_tallies(orders: DataFrame) -> tuple[DataFrame, list[str]]:
    """Sums per request id, and their names."""
    amount, unpaid = F.col("create_order_amount"), 1 - F.col("is_pay")
    failed = F.col("is_fail")
    trusted = F.coalesce(amount > TRUSTED_AMOUNT, F.lit(False))
    zero = F.lit(0.0)
    sums = {
        "_ord": F.count(F.lit(1)),
        "_unpaid": F.sum(unpaid),
        "_failed": F.sum(failed),
        "_reliable": F.sum("is_reliable"),
        "_amount": F.sum(amount),
        "_trust_ord": F.count(F.when(trusted, F.col("order_id"))),
        "_trust_amount": F.sum(F.when(trusted, amount).otherwise(zero)),
        "_trust_unpaid": F.sum(F.when(trusted, unpaid).otherwise(zero)),
        "_trust_failed": F.sum(F.when(trusted, failed).otherwise(zero)),
    }
    return orders.groupBy(REQUEST).agg(*_tallies(sums)), list(sums)


def _order_columns(at: str = "") -> list[Column]:
    """Labels from sums per pattern whose names begin with `at`."""
    labels = {
        "ord_cnt": F.col(f"{at}_ord"),
        "unpay_cnt": F.col(f"{at}_unpaid"),
        "fail_cnt": F.col(f"{at}_failed"),
        "unpay_ratio": F.try_divide(f"{at}_unpaid", f"{at}_ord"),
        "fail_ratio": F.try_divide(f"{at}_failed", f"{at}_ord"),
        "re_cnt": F.col(f"{at}_reliable"),
        "sum_order_amount": F.col(f"{at}_amount"),
        "trust_ord_cnt": F.col(f"{at}_trust_ord"),
        "trust_sum_order_amount": F.col(f"{at}_trust_amount"),
        "trust_unpay_cnt": F.col(f"{at}_trust_unpaid"),
        "trust_fail_cnt": F.col(f"{at}_trust_failed"),
        "trust_unpay_ratio": F.try_divide(f"{at}_trust_unpaid", f"{at}_trust_ord"),
        "trust_fail_ratio": F.try_divide(f"{at}_trust_failed", f"{at}_trust_ord"),
    }
    return _tallies(labels)


def all_labels(
    game: DataFrame,
    ug: DataFrame,
    orders: DataFrame,
    requests: DataFrame,
    schemas: Sequence[str],
    **skew: float | bool,
) -> DataFrame:
    """The three kinds of labels per pattern as game_json, ug_json and ecom_json.

    The kinds are brought together per request id before the log is joined, so the
    log is read, joined and multiplied over schemas once. A kind's JSON is NULL
    where the pattern has no row of that kind.
    """
    check_schemas(schemas)
    kinds = {
        "g": _retention_tallies(game),
        "u": _retention_tallies(ug),
        "o": _order_tallies(orders),
    }
    names: list[str] = []
    frames = []
    for at, (tallies, own) in kinds.items():
        frames.append(
            tallies.select(
                REQUEST, *[F.col(n).alias(f"{at}{n}") for n in own], F.lit(1).alias(f"{at}_rows")
            )
        )
        names += [*[f"{at}{n}" for n in own], f"{at}_rows"]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    # A kind has one row per request id at most, so its maximum is its value.
    tallies = together.groupBy(REQUEST).agg(*[F.max(n).alias(n) for n in names])
    rows = _labelled_requests(tallies, requests, schemas, names, DEVICE, skew)
    by = ("_schema", "group_pattern")
    again = {n: F.sum(n) for n in names}
    devices = [
        F.count(F.when(F.col(f"{at}_rows") > 0, F.col("_device"))).alias(f"{at}_devices")
        for at in ("g", "u")
    ]
    totals = (
        rows.groupBy(*by, "_device")
        .agg(*_tallies(again))
        .groupBy(*by)
        .agg(*devices, *_tallies(again))
    )

    def packed(at: str, columns: list[Column], name: str) -> Column:
        return F.when(F.col(f"{at}_rows") > 0, F.to_json(F.struct(*columns))).alias(name)

    shown = totals.select(
        *by,
        packed("g", _retention_columns("game", "g"), "game_json"),
        packed("u", _retention_columns("ug", "u"), "ug_json"),
        packed("o", _order_columns("o"), "ecom_json"),
    )
    return name_schemas(shown, schemas)
