"""Scalar building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import ECPM_BIN_WIDTH, ECPM_SCALE, SEPARATOR

TRANSFORMS = {
    "log": F.log,
    "log1p": F.log1p,
    "log2": F.log2,
    "log10": F.log10,
    "sqrt": F.sqrt,
    "cbrt": F.cbrt,
    "exp": F.exp,
    "expm1": F.expm1,
    "abs": F.abs,
    "floor": F.floor,
    "ceil": F.ceil,
    "signum": F.signum,
    "tanh": F.tanh,
}


def joined(columns: Sequence[str | Column]) -> Column:
    """Key text of several columns; NULL parts are skipped, all NULL gives ''."""
    return F.concat_ws(SEPARATOR, *columns)


def clip_top(column: Column, limit: float | None) -> Column:
    """`limit` where the value reaches it; NULL stays NULL."""
    if limit is None:
        return column
    return F.when(column >= F.lit(limit), F.lit(limit)).otherwise(column)


def transform(name: str | None, column: Column) -> Column:
    """A named unary function; no name leaves the column as it is."""
    if not name:
        return column
    if name not in TRANSFORMS:
        raise ValueError(f"unknown transform {name!r}; known: {sorted(TRANSFORMS)}")
    return TRANSFORMS[name](column)


def ip_prefix(ip: Column, parts: int) -> Column:
    """First `parts` numbers of a dotted IPv4 address; anything else unchanged."""
    pieces = F.split(ip, r"\.")
    prefix = F.array_join(F.slice(pieces, 1, parts), ".")
    return F.when(F.size(pieces) == 4, prefix).otherwise(ip)


def time_difference(later: Column, earlier: Column) -> Column:
    """Seconds between two epoch columns, NULL if either is NULL."""
    return later - earlier


def ecpm_price(ecpm: Column) -> Column:
    return F.coalesce(ecpm, F.lit(0.0)) / F.lit(ECPM_SCALE)


def ecpm_bin(ecpm: Column) -> Column:
    """Lower edge of the price's bin."""
    bins = (ecpm_price(ecpm) / F.lit(ECPM_BIN_WIDTH)).try_cast("int")
    return bins * F.lit(ECPM_BIN_WIDTH)


def json_texts(column: Column, fields: Iterable[str]) -> Column:
    """One parse of a JSON object into a struct of texts, NULL where absent."""
    return F.from_json(
        column, T.StructType([T.StructField(f, T.StringType()) for f in fields])
    )


def unpack_json(df: DataFrame, column: str, fields: Sequence[str]) -> DataFrame:
    """Replace a JSON column by its fields as texts.

    All fields come from one parse, and since a generator makes them, filters on
    them stay above it; as plain columns they would be parsed again per filter.
    """
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.json_tuple(column, *fields).alias(*fields))


def json_number(parsed: Column, field: str) -> Column:
    """A field of `json_texts` as a double; quoted numbers count as numbers."""
    return parsed.getField(field).try_cast("double")


def steps_between(function: str, current: Column, following: Column) -> Column:
    """How a value moves from one event to the next."""
    ratio = F.try_divide(following, current)
    inverse = F.try_divide(current, following)
    if function == "minus":
        return following - current
    if function == "minus_abs":
        return F.abs(following - current)
    if function == "div":
        return ratio
    if function == "div_max":
        return F.when(following > current, ratio).otherwise(inverse)
    if function == "div_min":
        return F.when(following < current, ratio).otherwise(inverse)
    raise ValueError(f"unknown inter-arrival function {function!r}")
