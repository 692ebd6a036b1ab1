"""Session settings the operators rely on."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Adaptive execution resizes shuffles, splits skewed join partitions and turns
# joins into broadcasts only after the size of a side has been measured.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Plans here have hundreds of columns; recording a Python call site for each
    # takes longer than planning them.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


# Compressed input per shuffle partition. Jobs read few columns, so what is
# shuffled is less; many more partitions would burden the driver.
PARTITION_BYTES = 1024**3


def shuffle_settings(input_bytes: int, cores: int = 1) -> dict[str, str]:
    """Shuffle partitions for jobs over so many bytes of compressed input.

    Adaptive execution merges partitions that turn out small.
    """
    partitions = max(200, 2 * cores, -(-input_bytes // PARTITION_BYTES))
    return {"spark.sql.shuffle.partitions": str(partitions)}


def build_session(
    app_name: str = "tallyward",
    extra: Mapping[str, str] | None = None,
    input_bytes: int | None = None,
    schemas: int = 1,
) -> SparkSession:
    """A session with SETTINGS and, over them, `extra`.

    Give the compressed input of the largest job and, for group jobs, into how many
    schemas its rows multiply; shuffles are sized by them.
    """
    sized = {} if input_bytes is None else shuffle_settings(input_bytes * schemas)
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **sized, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# What one task gets, however large the input: stored bytes of a file it scans,
# stored bytes of the largest table per shuffle partition, and compressed shuffled
# bytes up to which adaptive execution merges partitions. Sorts and hash tables take
# some fifty times what was shuffled, as rows multiply over schemas in the same task.
SCAN_BYTES = 32 * 1024**2
FITTED_BYTES = 1024**2
MERGED_BYTES = 8 * 1024**2
# More partitions would burden the driver; beyond them, PARTITION_BYTES counts.
MANY_PARTITIONS = 20_000


def byte_size(text: str) -> int:
    """Bytes of a setting such as 64MB, 16k or 134217728b."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", text.strip().lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def fit_session(spark: SparkSession, input_bytes: int) -> None:
    """Tasks of a running session made small enough for a table of so many stored bytes.

    For sessions that were not sized by `build_session`. Settings only move towards
    smaller tasks, so the largest table of a query decides.
    """
    needed = max(
        min(-(-input_bytes // FITTED_BYTES), MANY_PARTITIONS), -(-input_bytes // PARTITION_BYTES)
    )
    if needed > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    for key, most in (
        ("spark.sql.files.maxPartitionBytes", SCAN_BYTES),
        ("spark.sql.adaptive.advisoryPartitionSizeInBytes", MERGED_BYTES),
    ):
        if byte_size(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
