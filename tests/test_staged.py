"""Staged tables have an end of life."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from marketlake.operators.keys import distributed_key
from marketlake.session import StagedTables, release, stage, staged_tables, work_dir
from marketlake.sources.writers import write_silver


def held(spark) -> set:
    root = f"{work_dir(spark)}/marketlake"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def new(spark, before) -> list:
    return sorted(name.rsplit("-", 1)[0] for name in held(spark) - before)


def test_a_table_goes_with_its_last_reader(spark):
    before = held(spark)
    first = stage(spark.range(100), "first")
    second = stage(first.where("id > 9"), "second", done=[first])
    assert new(spark, before) == ["second"] and second.count() == 90
    release(second)
    release(second)
    assert new(spark, before) == []


def test_scopes_own_what_is_staged_inside(spark):
    before = held(spark)
    with staged_tables(spark):
        with StagedTables(spark) as inner:
            a = stage(spark.range(5), "a")
        b = stage(a, "b")
        inner.delete()
        assert new(spark, before) == ["b"] and b.count() == 5
        with StagedTables(spark):
            stage(b, "c")
    assert new(spark, before) == []
    try:
        with staged_tables(spark):
            stage(spark.range(5), "broken")
            raise KeyError
    except KeyError:
        assert new(spark, before) == []


def test_keys_and_sorted_writes_leave_no_copy_of_their_input(spark, tmp_path):
    before = held(spark)
    keyed = distributed_key(spark.range(1000).withColumn("g", F.col("id") % 3), ["id"], "key", by=["g"])
    assert new(spark, before) == ["key-key", "offsets"] and keyed.count() == 1000
    written = write_silver(spark.range(50), str(tmp_path / "out"), partition=None, order=["id"])
    assert new(spark, before) == ["key-key", "offsets"] and written.count() == 50


def test_a_staged_write_leaves_no_shuffle_files(spark):
    own = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    tracked = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()

    def shuffles():
        return set(tracked.keys().toSeq().mkString(",").split(",")) - {""}

    before, setting = shuffles(), spark.conf.get(own)
    out = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffles() <= before
    assert out.count() == 7 and spark.conf.get(own) == setting
