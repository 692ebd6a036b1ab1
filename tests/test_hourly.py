"""Hourly parts, schema roll-ups and sketches against plain passes over the rows."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import close, rows
from tallyward.operators.entity import Entity, FeatureGroup, entity_features
from tallyward.operators.features import (
    ApproxDistinct,
    Branch,
    Count,
    DistinctCount,
    DistinctRatio,
    Percentile,
    Ratio,
    SketchPercentile,
    Stat,
    TopNRatio,
    branch_inputs,
    plan_branches,
)
from tallyward.operators.groups import (
    GroupSpec,
    explode_schemas,
    group_features,
    group_features_rolled_up,
    roll_up_plan,
    root_partials,
)
from tallyward.operators.hourly import kept_tables
from tallyward.plans import jobs
from tallyward.sources import tables as S

SCHEMA = "d string, s string, v double, m string, date string, hour string"
GROUP = FeatureGroup(
    "g",
    (
        Entity(
            ("d", "m"),
            (
                Count("n"),
                Ratio("high", top="v > 5"),
                DistinctCount("sites", "v > 2", ("s",)),
                TopNRatio("top", "v > 3", ("s",), 1),
                Stat("avg", True, "avg", "v", 8.0),
                Stat("least", True, "min", "v"),
                ApproxDistinct("about", columns=("s", "m")),
                SketchPercentile("p50", True, 0.5, "v"),
                SketchPercentile("none", "v > 99", 0.5, "v"),
            ),
        ),
    ),
    where="v >= 0",
)


def log_of(spark, n=900, hours=30):
    rng = random.Random(5)
    data = []
    for _ in range(n):
        date, hour = S.hours_before("20240102", "05", hours)[rng.randrange(hours)]
        site = rng.choice([None, "", "a", "b", "c"])
        data.append((f"d{rng.randrange(7)}", site, float(rng.randrange(-1, 10)), rng.choice(["x", None]), date, hour))
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def log(spark):
    return log_of(spark).cache()


def window(log, hours):
    at = S.hours_before("20240102", "05", hours)
    return log.where(F.struct("date", "hour").isin([F.struct(F.lit(d), F.lit(h)) for d, h in at]))


@pytest.mark.parametrize("hours", [1, 5, 24])
def test_window_from_parts_equals_window_from_rows(spark, log, tmp_path, hours):
    path = str(tmp_path)
    jobs.backfill_hour_parts(log, GROUP, "v1", path)
    got = jobs.run_window_features(
        log.limit(0), GROUP, path, "20240102", "05", hours, "v1", missing_is_empty=True
    )
    want = entity_features(window(log, hours), GROUP)
    close(rows(got), rows(want))


def test_only_the_new_hour_is_read(spark, log, tmp_path):
    source_path, path = str(tmp_path / "log"), str(tmp_path / "parts")
    log.write.partitionBy("date", "hour").parquet(source_path)
    read = []

    def source(date, hour, hours):
        assert hours == 1
        table = S.Table("d string, s string, v double, m string", ("date", "hour"))
        rows = S.read_table(spark, source_path, table, {"date": date, "hour": hour})
        read.extend(rows.inputFiles())
        return rows

    for date, hour in S.hours_before("20240102", "05", 4):
        jobs.run_hour_parts(source, GROUP, date, hour, "v1", path)
    newest = [f for f in read if "date=20240102/hour=05" in f]
    assert newest and len({f.split("/part-")[0] for f in read}) == 4
    got = jobs.run_window_features(log.limit(0), GROUP, path, "20240102", "05", 3, "v1")
    close(rows(got), rows(entity_features(window(log, 3), GROUP)))
    kept = {f.split("/part-")[0].split("date=")[1] for f in got.inputFiles()}
    assert kept == {f"20240102/hour={h}" for h in ("03", "04", "05")}
    with pytest.raises(ValueError, match="never written"):
        jobs.run_window_features(log.limit(0), GROUP, path, "20240102", "05", 9, "v1")


def test_an_hour_without_rows_is_kept_and_hours_are_replaced(spark, log, tmp_path):
    path = str(tmp_path)
    one = log.where("date = '20240102' and hour = '05'")
    jobs.run_hour_parts(lambda *at: one, GROUP, "20240102", "05", "v1", path)
    jobs.run_hour_parts(lambda *at: one.limit(0), GROUP, "20240102", "04", "v1", path)
    for _ in range(2):
        jobs.run_hour_parts(lambda *at: one, GROUP, "20240102", "05", "v1", path)
    got = jobs.run_window_features(one.limit(0), GROUP, path, "20240102", "05", 2, "v1")
    close(rows(got), rows(entity_features(one, GROUP)))
    none = jobs.run_window_features(one.limit(0), GROUP, path, "20240102", "04", 1, "v1")
    assert none.count() == 0


def test_what_cannot_be_merged_is_an_error(spark, log):
    for feature in (Stat("x", True, "stddev_pop", "v"), Percentile("x", True, 0.5, "v")):
        group = FeatureGroup("g", (Entity(("d",), (feature,)),))
        (kept,) = kept_tables(group)
        with pytest.raises(ValueError, match="cannot be merged"):
            kept.inputs(log)
    with pytest.raises(ValueError, match="no hourly parts"):
        kept_tables(FeatureGroup("g", (Entity(("d",), (TopNRatio("x", True, ("s",), 2),)),)))


def test_sketch_percentiles_take_no_pass_of_their_own():
    keyed = DistinctCount("k", columns=("s",))
    assert len(plan_branches((keyed, SketchPercentile("p", True, 0.9, "v")))) == 1
    assert len(plan_branches((keyed, Percentile("p", True, 0.9, "v")))) == 2


def test_sketch_errors(spark):
    many = spark.range(200_000).select(
        F.lit("e").alias("d"), F.pmod(F.xxhash64("id"), F.lit(60_000)).alias("k"), F.col("id").cast("double").alias("v")
    )
    features = (ApproxDistinct("about", columns=("k",)), DistinctCount("exact", columns=("k",)), SketchPercentile("p", True, 0.9, "v"))
    found = {r.fkey: r.fval for r in entity_features(many, FeatureGroup("g", (Entity(("d",), features),))).collect()}
    assert abs(found["about"] / found["exact"] - 1) < 6 * 1.04 / 2**7
    assert abs(found["p"] / 200_000 - 0.9) < 2 * 1.65 / 400


def test_sketched_distinct_counts_do_not_depend_on_how_they_were_merged(spark):
    (part,) = ApproxDistinct("about", columns=("k",)).parts()
    estimate = ApproxDistinct("about", columns=("k",)).finish
    for n in (5, 900, 1_500, 1_600, 9_000, 60_000):
        keys = spark.range(n).select(F.col("id").cast("string").alias("k"))
        found = set()
        for dealt, parts in ((1, 1), (1, 7), (5, 3), (8, 40), (3, 2000)):
            kept = keys.repartition(dealt).groupBy(F.pmod(F.hash("k"), F.lit(parts)).alias("part"))
            whole = kept.agg(part.first(F.col("k")).alias("s")).agg(part.merge(F.col("s")).alias("s"))
            found.add(whole.select(estimate(F.col("s"))).first()[0])
        found.add(keys.coalesce(1).agg(part.first(F.col("k")).alias("s")).select(estimate(F.col("s"))).first()[0])
        assert len(found) == 1, (n, found)
        assert abs(found.pop() / n - 1) < 6 * 1.04 / 2**7


SCHEMAS = ("d,m,s", "d,m", "d", "m,hour")
SPEC = GroupSpec(
    "G",
    SCHEMAS,
    (
        Count("n"),
        DistinctCount("users", "v > 2", ("s",)),
        DistinctRatio("share", columns=("s",), top="v > 6"),
        Stat("avg", True, "avg", "v"),
        Ratio("high", top="v > 5"),
    ),
)


def test_rolled_up_groups_equal_plain_ones(log):
    want = rows(group_features(log, SPEC))
    close(rows(group_features_rolled_up(log, SPEC)), want)
    close(rows(group_features_rolled_up(log, SPEC, ("d,m,s,hour",))), want)


def test_roots():
    assert roll_up_plan(SCHEMAS) == [(["d", "m", "s"], [0, 1, 2]), (["m", "hour"], [3])]
    assert roll_up_plan(SCHEMAS, ("d,m,s,hour", "z")) == [(["d", "m", "s", "hour"], [0, 1, 2, 3])]


def test_the_first_shuffle_carries_fewer_rows(log):
    branch = Branch(SPEC.features, ("s",))
    inputs = branch_inputs(log, branch)
    roots = [root for root, _ in roll_up_plan(SCHEMAS)]
    folded = root_partials(log, roots, inputs).count()
    carried = {**inputs.columns, "_key": inputs.key}
    plain = explode_schemas(log, SCHEMAS, carried).groupBy("_schema", "group_pattern", "_key").count().count()
    assert folded < plain and len(roots) < len(SCHEMAS)


def test_unmergeable_features_cannot_be_rolled_up(log):
    with pytest.raises(ValueError):
        group_features_rolled_up(log, GroupSpec("G", SCHEMAS, (Stat("x", True, "variance", "v"),)))
