import random

import pytest
from pyspark.sql import functions as F

from helpers import close, rows
from tallyward.operators.iat import (
    IatKey,
    IatRankRatio,
    IatRatio,
    IatStat,
    IatStep,
    InterArrival,
    inter_arrival,
)


def spec(*features, func="minus", column="t", order=("t",), tie=("id",), **step):
    keys = (IatKey(column, (IatStep(func, features, **step),)),)
    return InterArrival(order, keys, tie)


def one(df):
    (row,) = df.collect()
    return row.asDict()


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(
        [("a", 1, 100), ("a", 2, 110), ("a", 3, 110), ("a", 4, 170), ("b", 5, 7)],
        "d string, id int, t bigint",
    )


def test_single_events_give_no_row(log):
    got = one(inter_arrival(log, ("d",), spec(IatStat("avg", "avg"), IatStat("n", "count"))))
    assert got == {"dval": "a", "avg": pytest.approx(70 / 3), "n": 3}


def test_ratio_and_rank_ratio(log):
    got = one(
        inter_arrival(
            log,
            ("d",),
            spec(
                IatRatio("short", top="iat <= 10", bottom="iat > 0"),
                IatRankRatio("first_long", top="iat > 20"),
                IatRankRatio("never", top="iat > 1000"),
            ),
        )
    )
    assert got["short"] == 0.5
    assert got["first_long"] == 1.0
    assert got["never"] is None


def test_clip_keeps_null_and_caps(spark):
    log = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, None), ("a", 3, 100), ("a", 4, 120)],
        "d string, id int, v int",
    )
    got = one(
        inter_arrival(
            log,
            ("d",),
            spec(IatStat("n", "count"), IatStat("m", "max"), column="v", order=("id",), clip=10.0),
        )
    )
    assert (got["n"], got["m"]) == (1, 10.0)


def test_key_is_masked_and_clipped_before_it_is_compared(spark):
    log = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, None), ("a", 3, 900), ("a", 4, 60)], "d string, id int, v int"
    )
    keys = (
        IatKey(
            "v",
            (IatStep("minus", (IatStat("s", "sum"), IatStat("n", "count"))),),
            where="v != 5",
            clip=100.0,
        ),
    )
    got = one(inter_arrival(log, ("d",), InterArrival(("id",), keys)))
    # 5 is masked, NULL stays NULL, 900 becomes 100: only 60 - 100 is left.
    assert (got["n"], got["s"]) == (1, -40.0)


def test_step_condition_must_hold_for_both_events(log):
    got = one(
        inter_arrival(log, ("d",), spec(IatStat("n", "count"), where="t > 100 AND t < 170"))
    )
    assert got["n"] == 1


@pytest.mark.parametrize(
    "func, want",
    [
        ("minus", -2.0 + 2.0),
        ("minus_abs", 4.0),
        ("div", 0.5 + 2.0),
        ("div_max", 4.0),
        ("div_min", 1.0),
    ],
)
def test_functions(spark, func, want):
    log = spark.createDataFrame([("a", 1, 4.0), ("a", 2, 2.0), ("a", 3, 4.0)], "d string, id int, v double")
    got = one(
        inter_arrival(log, ("d",), spec(IatStat("s", "sum"), func=func, column="v", order=("id",)))
    )
    assert got["s"] == want


def test_division_by_zero_is_null(spark):
    log = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 2.0)], "d string, id int, v double")
    for func in ("div", "div_max"):
        got = one(
            inter_arrival(
                log, ("d",), spec(IatStat("s", "sum"), func=func, column="v", order=("id",))
            )
        )
        assert got["s"] is None


def test_unknown_function(log):
    with pytest.raises(ValueError):
        inter_arrival(log, ("d",), spec(IatStat("s"), func="times"))


def self_join(log, keys):
    """Rank the events and join each with the next one."""
    ranked = log.selectExpr(
        "concat_ws('|', " + ", ".join(keys) + ") AS dval",
        "t",
        f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY t, id) AS r",
    )
    a, b = ranked.alias("a"), ranked.alias("b")
    pairs = a.join(b, F.expr("a.dval = b.dval AND a.r = b.r - 1")).selectExpr(
        "a.dval", "b.t - a.t AS iat", "a.r AS r"
    )
    return pairs.groupBy("dval").agg(
        F.avg("iat").alias("avg"),
        F.count("iat").alias("n"),
        F.expr("min(IF(iat > 30, r, NULL)) / max(r)").alias("rank"),
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """One entity with most events, NULL sort keys, an entity that is NULL."""
    rng = random.Random(5)
    events = []
    for i in range(3000):
        d = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        t = None if rng.random() < 0.01 else rng.randrange(1000)
        events.append((d, i, t))
    return spark.createDataFrame(events, "d string, id int, t bigint")


FEATURES = (
    IatStat("avg", "avg"),
    IatStat("n", "count"),
    IatRankRatio("rank", top="iat > 30"),
)


@pytest.mark.parametrize("share, floor", [(1.0, 10**9), (0.05, 0)])
def test_chunks_do_not_change_the_result(skewed, share, floor):
    log = skewed.where("d IS NOT NULL")
    got = inter_arrival(log, ("d",), spec(*FEATURES), share, floor)
    want = self_join(log, ["d"])
    close(rows(got, "dval", "avg", "n", "rank"), rows(want, "dval", "avg", "n", "rank"))


@pytest.mark.parametrize(
    "kind",
    [
        "timestamp_seconds(t)",
        "date_add(DATE'2024-01-01', CAST(t AS INT))",
        "CAST(timestamp_seconds(1700000000 + t * 37) AS STRING)",
        "CAST(t AS STRING)",
    ],
)
def test_chunks_for_any_sort_key(skewed, kind):
    log = skewed.withColumn("o", F.expr(kind)).withColumn("d", F.coalesce("d", F.lit("")))
    order = spec(*FEATURES, order=("o",))
    whole = inter_arrival(log, ("d",), order, 1.0, 10**9)
    cut = inter_arrival(log, ("d",), order, 0.002, 0)
    names = ("dval", "avg", "n", "rank")
    close(rows(cut, *names), rows(whole, *names))


def test_hot_entity_is_really_cut(skewed):
    from tallyward.operators import iat
    from tallyward.operators.skew import hot_keys

    arrival = spec(*FEATURES)
    events = iat._events(skewed, ("d",), arrival)
    hot = list(hot_keys(events, ["_e0"], 0.5, 0))
    names = ["_o0", "_t0"]
    chunked = iat._chunks(events, ["_e0"], hot, names, 0.5, 0)
    assert chunked.where("_chunk[0] > -2").select("_e0").distinct().collect() == [("hot",)]
    sizes = chunked.where("_e0 = 'hot'").groupBy("_chunk").count().collect()
    assert len(sizes) > 500
    assert max(r["count"] for r in sizes) < 30
    text = skewed.withColumn("t", F.expr("CAST(timestamp_seconds(t) AS STRING)"))
    events = iat._events(text, ("d",), arrival)
    sizes = iat._chunks(events, ["_e0"], hot, names, 0.5, 0).where("_e0 = 'hot'").groupBy("_chunk").count()
    assert sizes.count() > 500


@pytest.fixture(scope="module")
def level(spark):
    """A hot entity with one timestamp but for a few events, and a boolean between."""
    rng = random.Random(6)
    events = [("hot", 7, rng.random() < 0.5, i) for i in range(4000)]
    events += [("hot", rng.choice([None, 3, 9]), True, i) for i in range(4000, 4060)]
    events += [(rng.choice(["a", "b"]), rng.randrange(50), False, i) for i in range(4060, 4500)]
    rng.shuffle(events)
    return spark.createDataFrame(events, "d string, t bigint, flag boolean, id int")


LEVEL = InterArrival(("t", "flag"), (IatKey("id", (IatStep("minus", FEATURES),)),), ("id",))


def test_an_entity_with_one_timestamp_is_cut_by_the_next_keys(level):
    from tallyward.operators import iat
    from tallyward.operators.skew import hot_keys

    events = iat._events(level, ("d",), LEVEL)
    hot = list(hot_keys(events, ["_e0"], 0.5, 0))
    chunked = iat._chunks(events, ["_e0"], hot, ["_o0", "_o1", "_t0"], 0.02, 0)
    sizes = [r["count"] for r in chunked.where("_e0 = 'hot'").groupBy("_chunk").count().collect()]
    assert max(sizes) < 0.02 * 4500
    shape = {len(r["_chunk"]) for r in chunked.select("_chunk").distinct().collect()}
    assert shape == {3}


@pytest.mark.parametrize("share", [0.3, 0.02])
def test_cuts_by_later_keys_do_not_change_the_result(level, share):
    got = inter_arrival(level, ("d",), LEVEL, share, 0)
    want = inter_arrival(level, ("d",), LEVEL, 1.0, 10**9)
    names = ("dval", "avg", "n", "rank")
    close(rows(got, *names), rows(want, *names))
