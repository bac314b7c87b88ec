"""Stored tables survive writes that die, keep their versions and forget what nothing names."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from quantloom.operators import upsert as U
from quantloom.sources import writers as W

SCHEMA = "k int, v string, year int, part string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def held(spark, path, version=None):
    return {tuple(r) for r in U.read_table(spark, path, version).select("k", "v", "year", "part").collect()}


def data_folders(path):
    return sorted(os.listdir(f"{path}/{U.DATA}"))


FIRST = [(1, "a", 2023, "x"), (2, "b", 2024, "x"), (3, "c", 2024, "odd +%/ name"), (4, "d", None, None)]


def test_a_write_that_dies_leaves_the_old_table(spark, monkeypatch):
    path = W.new_path(spark, "table")
    U.upsert_partitions(rows(spark, *FIRST), path, ["k"], ["year", "part"])
    assert held(spark, path) == set(FIRST)
    change = rows(spark, (2, "new", 2024, "x"), (5, "e", 2025, "x"))
    dying = change.withColumn("v", F.when(F.col("k") == 5, F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        U.upsert_partitions(dying, path, ["k"], ["year", "part"])
    assert held(spark, path) == set(FIRST)
    with monkeypatch.context() as m:  # the data is there, the manifest is not
        m.setattr(DataFrameWriter, "json", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            U.upsert_partitions(change, path, ["k"], ["year", "part"])
    assert held(spark, path) == set(FIRST) and len(data_folders(path)) >= 2
    U.upsert_partitions(change, path, ["k"], ["year", "part"])
    assert held(spark, path) == {FIRST[0], FIRST[2], FIRST[3], (2, "new", 2024, "x"), (5, "e", 2025, "x")}
    assert held(spark, path, 1) == set(FIRST)
    assert U.vacuum(spark, path, 2) >= 1 and len(data_folders(path)) == 2 and held(spark, path, 1) == set(FIRST)
    assert U.vacuum(spark, path, 1) >= 1 and len(held(spark, path)) == 5 and len(data_folders(path)) == 2  # untouched partitions stay where they were
    with pytest.raises(ValueError):
        U.read_table(spark, path, 1)


def test_only_touched_partitions_are_written(spark):
    path = W.new_path(spark, "table")
    U.upsert_partitions(rows(spark, *FIRST), path, ["k"], ["year", "part"])
    U.upsert_partitions(rows(spark, (3, "z", 2024, "odd +%/ name"), (4, "y", None, None)), path, ["k"], ["year", "part"])
    live = {r.folder: r.version for r in U.live_partitions(spark, path)}
    assert len(live) == 4 and set(live.values()) == {2}
    assert sorted(int(r.write.split("-")[0]) for r in U.live_partitions(spark, path)) == [1, 1, 2, 2]
    assert held(spark, path) == {FIRST[0], FIRST[1], (3, "z", 2024, "odd +%/ name"), (4, "y", None, None)}


def test_keys_that_move_new_columns_and_empty_batches(spark):
    path = W.new_path(spark, "table")
    U.upsert_partitions(rows(spark, (1, "a", 2023, "x"), (2, "b", 2024, "x")), path, ["k"], ["year"])
    U.upsert_partitions(rows(spark, (1, "moved", 2024, "x"), (3, "c", 2023, "x")), path, ["k"], ["year"])  # 2023 and 2024 are touched
    assert held(spark, path) == {(1, "moved", 2024, "x"), (2, "b", 2024, "x"), (3, "c", 2023, "x")}
    U.upsert_partitions(rows(spark, FIRST[0]).limit(0), path, ["k"], ["year"])
    assert len(held(spark, path)) == 3 and U.live_partitions(spark, path)[0].version == 3
    U.upsert_partitions(spark.createDataFrame([(2, "w", 2024, 1.5)], "k int, v string, year int, extra double"), path, ["k"], ["year"])
    got = {r.k: (r.v, r.part, r.extra) for r in U.read_table(spark, path).collect()}
    assert got == {1: ("moved", "x", None), 2: ("w", None, 1.5), 3: ("c", "x", None)}
    whole = W.new_path(spark, "table")
    for batch in (rows(spark, (1, "a", 1, "x"), (2, "b", 1, "x")), rows(spark, (2, "c", 1, "x"))):
        U.upsert_partitions(batch, whole, ["k"], [])
    assert held(spark, whole) == {(1, "a", 1, "x"), (2, "c", 1, "x")}
    nothing = W.new_path(spark, "table")
    U.upsert_partitions(rows(spark, (1, "a", 1, "x")).limit(0), nothing, ["k"], ["year"])
    assert held(spark, nothing) == set() and U.vacuum(spark, W.new_path(spark, "absent")) == 0
    with pytest.raises(ValueError):
        U.read_table(spark, W.new_path(spark, "absent"))
