"""What the plans must look like on a large cluster."""

from __future__ import annotations

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from marketlake.operators import keys as K
from marketlake.plans import gold
from marketlake.verification import QUERIES
from marketlake.verification.fixtures import Tables

SF = "/root/testdata/sf0.001"
ROOT = pathlib.Path(__file__).resolve().parent.parent


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_forbidden_calls():
    banned = ["localCheckpoint", "crossJoin", "toPandas", ".rdd", "collect_set", "coalesce(1)", "repartition(1)"]
    for path in (ROOT / "marketlake").rglob("*.py"):
        source = path.read_text()
        for word in banned:
            assert word not in source, f"{word} in {path}"


def test_scan_is_pruned_and_filtered(spark):
    from marketlake.operators.project import cap_filter

    df = cap_filter(Tables(spark, SF).lineitem, "l_extendedprice", 20000).select("l_orderkey")
    text = plan(df)
    assert "LessThan(l_extendedprice,20000" in text
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>", text)


def test_null_rejecting_filter_becomes_inner_join(spark):
    assert "LeftOuter" not in plan(QUERIES["p12_null_rejecting_filter"](spark, SF))


@pytest.mark.parametrize("name", ["d12_fact_daily", "d14_daily_market_snapshot", "d16_neighbourhood_trends", "d18_listing_dataset", "w05_freq_encode"])
def test_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_calendar_is_joined_without_a_shuffle_for_small_lookups(spark):
    t = Tables(spark, SF)
    calendar = t.lineitem.select(
        F.col("l_partkey").alias("listing_id"), F.to_date("l_shipdate").alias("calendar_date"), F.lit(True).alias("is_available"),
        F.col("l_extendedprice").alias("price"), F.lit(1).alias("minimum_nights"),
    )
    fact = gold.fact_daily(calendar, t.staged_listing, t.review, t.dims, t.dates, with_id=False)
    assert "Exchange hashpartitioning" not in plan(fact)


def test_large_sides_are_not_broadcast_and_hot_keys_are_split(spark):
    """Above the threshold the join shuffles, and adaptive execution splits the partition of a hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        calendar = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).cast("bigint").alias("listing_id"),
            F.expr("date_add(date'2025-01-01', cast(id % 300 as int))").alias("calendar_date"), (F.col("id") % 2 == 0).alias("is_available"),
            (F.col("id") % 50).cast("double").alias("price"), F.lit(1).alias("minimum_nights"),
        )
        lookup = spark.range(997).select(
            F.col("id").alias("listing_id"), F.col("id").alias("listing_key"), F.lit(1).alias("host_key"), F.lit(1).alias("neighbourhood_key"),
            F.lit(1.0).alias("listing_price"), F.lit(0).cast("bigint").alias("reviews_to_date"),
        )
        fact = gold.fact_rows(calendar, lookup, gold.dim_calendar(spark, "2025-01-01", "2025-12-31"))
        assert len(fact.collect()) == 60000
        text = plan(fact)
        assert "skew=true" in text and "SortMergeJoin" in text
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_keep_first_limits_before_the_shuffle(spark):
    df = K.keep_first(Tables(spark, SF).orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    text = plan(df)
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_work_dir_comes_from_the_session(spark):
    from marketlake.session import work_dir

    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
