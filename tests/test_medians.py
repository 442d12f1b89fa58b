"""Medians of many groups without a value map per group."""

from __future__ import annotations

import random
from statistics import median

from pyspark.sql import functions as F

from marketlake.operators import aggregates as A
from marketlake.operators import stats as S


def test_medians_of_mixed_groups(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", None]), rng.choice([1, None]), rng.choice([None, *[float(rng.randrange(9)) for _ in range(6)]])) for _ in range(500)]
    rows += [("hot", 1, float(k % 997)) for k in range(5000)] + [("empty", 2, None)]
    out = A.median_by(spark.createDataFrame(rows, "k string, j int, v double").repartition(7), ["k", "j"], "v", "m").collect()
    want = {}
    for k, j, v in rows:
        want.setdefault((k, j), []).extend([] if v is None else [v])
    assert {(r.k, r.j): r.m for r in out} == {g: median(v) if v else None for g, v in want.items()} and len(out) == len(want)


def test_no_median_state(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v"), F.lit(1).alias("accommodates"), F.lit(1).alias("bedrooms"),
                                  F.lit(1).alias("beds"), F.lit(True).alias("is_superhost"), F.lit(0.5).alias("availability_rate"))
    for out in (A.median_by(df, ["k"], "v"), A.group_listing_level(df, ["k"], [F.count("v").alias("n")], {"m": "v"}), S.market_comparison(df, "k", "v")):
        plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "median(" not in plan and "percentile(" not in plan


def test_one_group_is_spread(spark, monkeypatch):
    """The distinct values of a single group lie in many ranges."""
    ranges = []

    def staged(df, tag, own=A.stage):
        out = own(df, tag)
        if "_range" in out.columns:
            ranges.append(out.select("_range").distinct().count())
        return out

    monkeypatch.setattr(A, "stage", staged)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).select(F.lit(1).alias("k"), (F.col("id") * 1.0).alias("v"))
        assert A.median_by(df, ["k"], "v").first().median_v == 9999.5 and ranges[0] > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
