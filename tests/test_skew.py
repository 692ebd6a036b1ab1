import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from tallyward.operators import skew


@pytest.fixture(scope="module")
def log(spark):
    """A third of the rows have no key, a third the empty one."""
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "")
    return spark.range(3000).select("id", key.otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"))


@pytest.fixture(scope="module")
def listed(spark):
    keys = [("",), (None,), *[(f"k{i}",) for i in range(0, 500, 4)]]
    return spark.createDataFrame(keys, "k string").withColumn("tag", F.length("k"))


def test_hot_keys_are_found(log):
    found = skew.hot_keys(log, ["k"], 0.1, 0)
    want = log.where("k IS NULL OR k = ''").select(F.xxhash64("k").alias("h")).distinct()
    assert found == {r["h"]: 1000 / 3000 for r in want.collect()}
    assert skew.hot_keys(log, ["k"], 0.5, 0) == {} == skew.hot_keys(log, ["k"])
    assert skew.hot_keys(log.limit(0), ["k"], 0.1, 0) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salting_does_not_change_the_result(log, listed, how):
    salted = skew.skew_join(log, listed, ["k"], how, 0.1, 0, salted=True)
    plain = log.join(listed, "k", how)
    assert sorted(salted.columns) == sorted(plain.columns)
    assert rows(salted, *plain.columns) == rows(plain)


def test_hot_rows_are_spread(log, listed):
    spread = skew.skew_join(log, listed.distinct(), ["k"], "left", 0.1, 0, salted=True)
    salts = spread.sparkSession.conf.get("spark.sql.shuffle.partitions")
    parts = spread.where("k = ''").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > int(salts) // 2 or parts == 1  # one if adaptive execution broadcast the list


def test_small_lists_are_left_to_spark(log, spark):
    few = spark.range(100).select(F.concat(F.lit("k"), F.col("id")).alias("k"))
    assert skew.estimated_small(few)
    assert "_salt" not in plan_of(skew.skew_join(log, few, ["k"], "left"))
    wide = spark.range(10**9).select(F.col("id").cast("string").alias("k"))
    assert not skew.estimated_small(wide)
    assert "_salt" in plan_of(skew.skew_join(log, wide, ["k"], "left_semi", 0.1, 0))


def test_salts_follow_partitions_and_share(log, listed, spark):
    def dealt():
        plan = plan_of(skew.skew_join(log, listed, ["k"], "left", 0.1, 0, salted=True))
        return plan.count("_salt") > 0

    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        joined = skew.skew_join(log, listed, ["k"], "left_semi", 0.1, 0, salted=True)
        assert dealt() and joined.count() == log.join(listed, "k", "left_semi").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_nothing_hangs_on_exchange_reuse(log, listed, how, spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        salted = skew.skew_join(log, listed, ["k"], how, 0.1, 0, salted=True)
        assert rows(salted, "k") == rows(log.join(listed, "k", how), "k")
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


@pytest.mark.parametrize("salted", [False, True, None])
def test_key_types_are_treated_alike_at_any_size(log, spark, salted):
    numbers = spark.range(100).select((F.col("id") % 7).cast("int").alias("n"), "id")
    wide = spark.range(3).select(F.col("id").alias("n"))
    for mine, theirs in ((numbers, wide), (numbers.withColumn("n", F.col("n").cast("bigint")), wide)):
        kept = skew.skew_join(mine, theirs, ["n"], "left_semi", 0.01, 0, salted=salted)
        assert sorted(r["id"] for r in kept.collect()) == [k for k in range(100) if k % 7 < 3]
    with pytest.raises(ValueError):
        skew.skew_join(log, wide.withColumnRenamed("n", "k"), ["k"], "left", salted=salted)
