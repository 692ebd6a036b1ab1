"""What several operators share: the shared folder, cut lineage, components, words."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators.skew import skew_join
from tallyward.session import byte_size

# A word is a longest run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# Graphs from this size on are looked over for nodes with many edges.
MANY_EDGES = 1_000_000

# Makes Spark remove a query's shuffle files as soon as it has ended.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Bytes of rows that a Python worker gets at a time.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 * 1024**2

_own_folder: list[str] = []


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Where that is unset, a temporary folder serves a session that runs in one
    process; any other master is an error, as its executors would not see it.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        folder = given
    else:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _own_folder:
            _own_folder.append("file://" + tempfile.mkdtemp(prefix="tallyward-"))
        folder = _own_folder[0]
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Python workers of the session get texts in batches of BATCH_BYTES, not in larger ones."""
    if byte_size(spark.conf.get(ARROW_BYTES)) > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside leave no shuffle files, which else stay until the driver collects garbage."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint."""
    shared_folder(df.sparkSession)
    with tidied(df.sparkSession):
        # A query of its own: df's own may have been made before.
        return df.select("*").checkpoint()


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The same rows, written once as a table in the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with tidied(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of `staged` that nothing will read any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def word_count(text: Column | str) -> Column:
    """Number of words, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def _lows(edges: DataFrame, key: str, join: Callable) -> DataFrame:
    """Edges with `_low`, the smallest neighbour below the node in column `key`."""
    least = edges.groupBy(F.col("a").alias("_node")).agg(F.min("b").alias("_low"))
    return join(edges.withColumn("_node", F.col(key)), least)


def _star(edges: DataFrame, join: Callable) -> DataFrame:
    """One large-star and one small-star step on distinct edges (a, b) with a > b.

    Large-star hangs every node on the smallest neighbour of the nodes below it,
    small-star all nodes below a node on the smallest of them. Only minima per node
    are aggregated, so no node's neighbours ever meet in one row.
    """
    large = cut(_lows(edges, "b", join).select("a", F.coalesce("_low", "b").alias("b")).distinct())
    lows = _lows(large, "a", join)
    both = lows.select(F.col("b").alias("a"), F.col("_low").alias("b")).unionByName(
        lows.select("a", F.col("_low").alias("b"))
    )
    return both.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the graph with edges (a, b): rows (id, component_id).

    component_id is the smallest id of the component. Ids without an edge to
    another id have no row. Alternates large-star and small-star until the edges
    are one star per component; every round is checkpointed. From MANY_EDGES on,
    nodes that many edges hang on are dealt out.
    """
    now = cut(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state[0] == 0 or state == seen:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
        seen, many = state, state[0] >= MANY_EDGES

        def join(left: DataFrame, least: DataFrame) -> DataFrame:
            if many:
                return skew_join(left, least, ["_node"], "left", floor=MANY_EDGES // 100, salted=True)
            return left.join(least, "_node", "left")

        now = cut(_star(now, join))


def permuted(x: Column, n: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0 … n - 1 picked by `key`, applied to x.

    A four-round Feistel network on pairs below m = ceil(sqrt(n)) permutes
    0 … m*m - 1; results of n or more are permuted again until one is below n.
    """
    m = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")

    def once(value: Column) -> Column:
        left, right = F.floor(value / m).cast("bigint"), value % m
        for turn in range(4):
            mixed = (left + F.pmod(F.xxhash64(right, key, F.lit(turn)), m)) % m
            left, right = right, mixed
        return left * m + right

    first = once(x)
    # At most 2 m - 1 values lie outside; 64 further steps cover them all for
    # n up to a thousand, and leave one in 16 ** 64 beyond.
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(64)), first, lambda at, _: F.when(at < n, at).otherwise(once(at))
    )
    return F.when(first < n, first).otherwise(walked)
