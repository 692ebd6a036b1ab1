"""Partitioned parquet tables of the engine: layouts, readers and writers.

Partition values are texts, so readers give the schema instead of having
Spark guess it ("08" stays "08").
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import DAILY_HOUR


@dataclass(frozen=True)
class Table:
    columns: str
    partitions: tuple[str, ...]

    @property
    def schema(self) -> str:
        parts = [f"`{p}` string" for p in self.partitions]
        return ", ".join([self.columns, *parts])


LONG_FEATURES = Table(
    "dkey string, dval string, fkey string, fval double",
    ("date", "hour", "aggregator_type", "group", "version"),
)
GROUP_FEATURES = Table(
    "group_schema string, group_pattern string, feature_json string",
    ("date", "hour", "version"),
)
PERFORMANCE = Table(
    "group_schema string, group_pattern string, feature_json string",
    ("date", "version"),
)
STRATEGIES = Table(
    "group_schema string, rule_condition string, ad_performance_json string",
    ("date", "version"),
)
ANOMALY_PATTERNS = PERFORMANCE


def _partition_filter(values: Mapping[str, str | Sequence[str]]) -> Column:
    conditions = [
        F.col(f"`{k}`") == v if isinstance(v, str) else F.col(f"`{k}`").isin(*v)
        for k, v in values.items()
    ]
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path of any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(place).getLength()


def _existing(spark: SparkSession, root: str, paths: Sequence[str]) -> list[str]:
    """Those of the folders below `root` that exist, asked for level by level, none listed."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(root).getFileSystem(spark._jsc.hadoopConfiguration())
    known = {root.rstrip("/"): True}

    def there(path: str) -> bool:
        if path not in known:
            known[path] = there(path.rsplit("/", 1)[0]) and files.exists(place(path))
        return known[path]

    return [p for p in paths if there(p)]


def partition_folders(
    path: str, table: Table, partitions: Mapping[str, str | Sequence[str]]
) -> list[str]:
    """Folders of the given values, as deep as values are given from the outermost level on."""
    folders = [path.rstrip("/")]
    for name in table.partitions:
        if name not in partitions:
            break
        given = partitions[name]
        texts = [given] if isinstance(given, str) else list(dict.fromkeys(given))
        folders = [partition_path(f, {name: t}) for f in folders for t in texts]
    return folders


def read_table(
    spark: SparkSession,
    path: str,
    table: Table,
    partitions: Mapping[str, str | Sequence[str]] | Sequence[Mapping[str, str]],
    skip_corrupt_files: bool = False,
    all_there: bool = False,
) -> DataFrame:
    """A table's rows in the given partitions; or in those of several sets of values.

    Only their folders are listed: from the outermost level on, values make up paths as
    far as they are given, and levels below the first one left out are filtered as
    Spark lists them. Partitions that were never written have no rows, or are an error
    if all of them have to be there.
    """
    several = [partitions] if isinstance(partitions, Mapping) else list(partitions)
    wanted = [f for values in several for f in partition_folders(path, table, values)]
    folders = _existing(spark, path, wanted)
    if all_there and len(folders) < len(wanted):
        gone = sorted(set(wanted) - set(folders))
        raise ValueError(f"{len(gone)} partitions were never written, the first is {gone[0]}")
    if not folders:
        return spark.createDataFrame([], table.schema)
    reader = spark.read.schema(table.schema).option("basePath", path)
    if skip_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    rows = reader.parquet(*folders)
    return rows.where(_partition_filter(partitions)) if isinstance(partitions, Mapping) else rows


def hours_before(date: str, hour: str, hours: int) -> list[tuple[str, str]]:
    """(date, hour) of the `hours` hours that end with the given one, oldest first."""
    if hours < 1:
        raise ValueError("a trailing window has at least one hour")
    end = datetime.strptime(f"{date} {str(hour).zfill(2)}", "%Y%m%d %H")
    each = [end - timedelta(hours=back) for back in reversed(range(hours))]
    return [(t.strftime("%Y%m%d"), t.strftime("%H")) for t in each]


def overwrite_hours(df: DataFrame, path: str) -> None:
    """Replace the (date, hour) partitions that have rows, and no others, in one write."""
    (
        df.hint("rebalance", F.col("date"), F.col("hour"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "hour")
        .parquet(path)
    )


def read_features(
    spark: SparkSession,
    path: str,
    date: str,
    hour: str,
    dkey: str,
    kinds: Sequence[str],
    version: str,
    group: str | None = None,
) -> DataFrame:
    """Long features of one entity kind; `group` narrows to one feature group."""
    wanted = {"date": date, "hour": hour, "aggregator_type": kinds, "version": version}
    if group is not None:
        wanted["group"] = group
    return read_table(spark, path, LONG_FEATURES, wanted).where(F.col("dkey") == dkey)


def read_group_features(
    spark: SparkSession, path: str, date: str, version: str, schemas: Sequence[str]
) -> DataFrame:
    wanted = {"date": date, "hour": DAILY_HOUR, "version": version}
    rows = read_table(spark, path, GROUP_FEATURES, wanted)
    return rows.where(F.col("group_schema").isin(*schemas)).select(
        "group_schema", "group_pattern", "feature_json"
    )


def read_performance(
    spark: SparkSession, path: str, date: str, version: str, schemas: Sequence[str]
) -> DataFrame:
    rows = read_table(spark, path, PERFORMANCE, {"date": date, "version": version})
    return rows.where(F.col("group_schema").isin(*schemas)).select(
        "group_schema", "group_pattern", "feature_json"
    )


def read_strategies(
    spark: SparkSession, path: str, date: str, version: str
) -> DataFrame:
    rows = read_table(spark, path, STRATEGIES, {"date": date, "version": version})
    return rows.select("group_schema", "rule_condition", "ad_performance_json")


_PLAIN = re.compile(r"[A-Za-z0-9_.\-]+")


def partition_path(path: str, values: Mapping[str, str]) -> str:
    for key, text in values.items():
        if not _PLAIN.fullmatch(text):
            raise ValueError(f"partition value {key}={text!r} is not a plain word")
    return "/".join([path.rstrip("/"), *[f"{k}={v}" for k, v in values.items()]])


def overwrite_partition(df: DataFrame, path: str, values: Mapping[str, str]) -> None:
    """Replace exactly one partition, also when `df` is empty."""
    df.write.mode("overwrite").parquet(partition_path(path, values))


def overwrite_kinds(
    df: DataFrame,
    path: str,
    values: Mapping[str, str],
    kind_column: str,
    kinds: Sequence[str],
    table: Table = LONG_FEATURES,
) -> None:
    """Replace one partition per kind in a single write.

    Kinds that came out empty are counted during the write and their old
    partitions are replaced by empty ones.
    """
    partition_path(path, values)
    seen = Observation()
    counted = df.observe(
        seen,
        *[
            F.count_if(F.col(kind_column) == kind).alias(f"n{i}")
            for i, kind in enumerate(kinds)
        ],
    )
    full = counted.withColumns({k: F.lit(v) for k, v in values.items()})
    order = list(table.partitions)
    # Adaptive execution cuts a rebalanced kind into files of its advisory size, be it
    # large or small, instead of one file of every kind from every task.
    full = full.hint("rebalance", F.col(kind_column))
    (
        full.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*order)
        .parquet(path)
    )
    for i, kind in enumerate(kinds):
        if not seen.get[f"n{i}"]:
            empty = df.sparkSession.createDataFrame([], table.columns)
            at = {**values, kind_column: kind}
            overwrite_partition(empty, path, {k: at[k] for k in order})


_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints.

    Where none is named, a temporary folder serves a session that runs in one process;
    for any other master that is an error, as its executors would not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if not _own_folder:
        _own_folder.append("file://" + tempfile.mkdtemp(prefix="tallyward-"))
    return _own_folder[0]


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """`df` written once as a columnar table, for jobs that read it several times.

    The table lies in the cluster's shared folder, so what was computed survives
    lost executors; it is dropped at the end.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        files.delete(place, True)


def write_delimited(df: DataFrame, path: str) -> None:
    """Comma-separated text without a header."""
    df.write.mode("overwrite").csv(path, sep=",", header=False)


def merge_output_path(
    root: str, name: str, group: str, version: str, date: str, hour: str
) -> str:
    """Directory of a delimited output, `name` being feature or population_stats."""
    return "/".join([root.rstrip("/"), name, group, version, date, hour])
