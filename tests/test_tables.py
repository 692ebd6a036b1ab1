from pathlib import Path

import pytest

from helpers import plan_of, rows
from tallyward.sources import tables as S

AT = {"date": "20240102", "hour": "08", "version": "v1"}


def groups(spark, *patterns):
    return spark.createDataFrame(
        [("s", p, "{}") for p in patterns], "group_schema string, group_pattern string, feature_json string"
    )


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    S.overwrite_partition(groups(spark, "a", "b"), path, AT)
    S.overwrite_partition(groups(spark, "c"), path, {**AT, "hour": "09"})
    for _ in range(2):
        S.overwrite_partition(groups(spark, "d"), path, AT)
    everything = S.read_table(spark, path, S.GROUP_FEATURES, {})
    assert rows(everything, "group_pattern", "date", "hour") == [
        ("c", "20240102", "09"),
        ("d", "20240102", "08"),
    ]
    S.overwrite_partition(groups(spark, "x").limit(0), path, AT)
    assert rows(S.read_table(spark, path, S.GROUP_FEATURES, {}), "group_pattern") == [("c",)]


def test_partition_values_must_be_plain():
    with pytest.raises(ValueError):
        S.partition_path("/x", {"date": "2024/01"})


def long(spark, *data):
    return spark.createDataFrame(
        data, "aggregator_type string, dkey string, dval string, fkey string, fval double"
    )


LONG_AT = {"date": "20240102", "hour": "08", "group": "g", "version": "v1"}


def test_kinds_are_written_at_once_and_emptied_when_gone(spark, tmp_path):
    path = str(tmp_path / "t")
    kinds = ("count", "iat")
    write = lambda df, at=LONG_AT: S.overwrite_kinds(df, path, at, "aggregator_type", kinds)
    write(long(spark, ("count", "d", "a", "f", 1.0), ("iat", "d", "a", "g", 2.0)))
    write(long(spark, ("count", "d", "z", "f", 9.0)), {**LONG_AT, "group": "other"})
    read = lambda kinds=kinds, **more: S.read_features(spark, path, "20240102", "08", "d", kinds, "v1", **more)
    assert rows(read(), "dval", "fkey", "fval") == [("a", "f", 1.0), ("a", "g", 2.0), ("z", "f", 9.0)]
    assert rows(read(group="g"), "fval") == [(1.0,), (2.0,)]
    assert rows(read(("iat",)), "fval") == [(2.0,)]
    write(long(spark, ("count", "d", "a", "f", 5.0)))
    assert rows(read(group="g"), "fkey", "fval") == [("f", 5.0)]
    assert "PartitionFilters: [isnotnull" in plan_of(read())


def test_readers_filter_schemas_and_hour(spark, tmp_path):
    path = str(tmp_path / "g")
    S.overwrite_partition(groups(spark, "a"), path, {**AT, "hour": "23"})
    S.overwrite_partition(groups(spark, "b"), path, AT)
    got = S.read_group_features(spark, path, "20240102", "v1", ["s"])
    assert rows(got, "group_pattern") == [("a",)]
    assert S.read_group_features(spark, path, "20240102", "v1", ["t"]).count() == 0
    assert S.read_group_features(spark, path, "20240102", "v2", ["s"]).count() == 0


def test_corrupt_files_can_be_skipped(spark, tmp_path):
    path = tmp_path / "t"
    S.overwrite_partition(groups(spark, "a"), str(path), AT)
    (path / "date=20240102" / "hour=08" / "version=v1" / "part-x.parquet").write_bytes(b"broken")
    got = S.read_table(spark, str(path), S.GROUP_FEATURES, AT, skip_corrupt_files=True)
    assert rows(got, "group_pattern") == [("a",)]


def test_delimited_output(spark, tmp_path):
    path = S.merge_output_path(str(tmp_path), "feature", "g", "v1", "20240102", "08")
    assert path.endswith("/feature/g/v1/20240102/08")
    df = spark.createDataFrame([("a", 1.0, -1.0)], "d string, x double, y double")
    for _ in range(2):
        S.write_delimited(df, path)
    assert [r[0] for r in spark.read.text(path).collect()] == ["a,1.0,-1.0"]


def test_staged_tables_lie_in_the_shared_folder_and_go_away(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    df = spark.range(5).selectExpr("id", "CAST(NULL AS STRING) AS t")
    with S.staged(df) as kept:
        assert len(set(folder.iterdir()) - before) == 1
        assert rows(kept) == rows(df) and kept.columns == df.columns
    assert set(folder.iterdir()) == before


def test_only_the_folders_asked_for_are_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in range(10):
        S.overwrite_partition(groups(spark, f"p{day}"), path, {**AT, "date": f"202401{day:02d}"})
    wanted = {"date": "20240103", "hour": "08"}
    one = S.read_table(spark, path, S.GROUP_FEATURES, wanted)
    assert rows(one, "group_pattern", "date", "hour", "version") == [("p3", "20240103", "08", "v1")]
    listed = one._jdf.queryExecution().analyzed().toString()
    files = one.inputFiles()
    assert files and all("date=20240103/hour=08" in f for f in files)
    # The relation itself knows no other file, whatever the filter.
    everything = S.read_table(spark, path, S.GROUP_FEATURES, {}).inputFiles()
    assert len(everything) > len(files) and "Relation" in listed
    two = S.read_table(spark, path, S.GROUP_FEATURES, {"date": ["20240103", "20240105", "20240199"]})
    assert rows(two, "group_pattern") == [("p3",), ("p5",)]
    assert S.read_table(spark, path, S.GROUP_FEATURES, {"date": "20240199"}).columns == one.columns


def test_hours_before():
    assert S.hours_before("20240301", "1", 3) == [("20240229", "23"), ("20240301", "00"), ("20240301", "01")]
    with pytest.raises(ValueError):
        S.hours_before("20240301", "01", 0)
