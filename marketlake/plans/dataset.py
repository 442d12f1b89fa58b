"""Listing-level dataset for statistics and models."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.exact import micros, money
from marketlake.functions.scalars import label_by_threshold, tenure_days
from marketlake.operators.aggregates import price_summary
from marketlake.operators.joins import star_join
from marketlake.session import stage

LISTING_COLUMNS = ["listing_id", "name", "room_type", "property_type", "accommodates", "bedrooms", "beds", "latitude", "longitude"]
HOST_COLUMNS = ["is_superhost", "host_listings_count", "host_since"]
AREA_COLUMNS = ["neighbourhood", "neighbourhood_group"]
DATASET_KEYS = [*LISTING_COLUMNS, *HOST_COLUMNS, *AREA_COLUMNS]
REFERENCE_DATE = "2026-06-23"

DATASET_SCHEMA = T.StructType([
    T.StructField("listing_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("room_type", T.StringType()), T.StructField("property_type", T.StringType()),
    T.StructField("accommodates", T.IntegerType()), T.StructField("bedrooms", T.DoubleType()),
    T.StructField("beds", T.DoubleType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("is_superhost", T.BooleanType()),
    T.StructField("host_listings_count", T.IntegerType()), T.StructField("host_since", T.DateType()),
    T.StructField("neighbourhood", T.StringType()), T.StructField("neighbourhood_group", T.StringType()),
    T.StructField("target_price", T.DoubleType()), T.StructField("avg_price", T.DoubleType()),
    T.StructField("availability_rate", T.DoubleType()), T.StructField("est_revenue", T.DoubleType()),
    T.StructField("total_reviews", T.LongType()), T.StructField("host_tenure_days", T.IntegerType()),
])


def listing_dataset(fact: DataFrame, dims: dict[str, DataFrame], ref_date: str = REFERENCE_DATE) -> DataFrame:
    """One row per listing (and host and area version) with price, availability, revenue, reviews and tenure.

    Days never meet the wide attributes: those are joined to the distinct keys. Keys with equal attributes are one group,
    known by its smallest keys; the facts are added up per group and price, then per group, and the attributes are joined
    to these sums. Each step is staged, so the facts are read once and the shuffle files of a step go before the next.
    """
    keys = ["listing_key", "host_key", "neighbourhood_key"]
    facts = stage(fact.select(*keys, "price", "is_available", "est_revenue", "reviews_to_date"), "facts")
    known = star_join(
        facts.select(*keys).distinct(),
        [
            (dims["listings"].select("listing_key", *LISTING_COLUMNS), "listing_key"),
            (dims["hosts"].select("host_key", *HOST_COLUMNS), "host_key"),
            (dims["neighbourhoods"].select("neighbourhood_key", *AREA_COLUMNS), "neighbourhood_key"),
        ],
    )
    versions = stage(_versions(known, keys), "listing-versions")
    placed, group = _by_group(facts, versions, keys)
    priced = stage(
        placed.groupBy(*group, "price").agg(
            F.count(F.lit(1)).alias("days"),
            F.sum(F.coalesce(F.col("is_available"), F.lit(False)).cast("int")).alias("available"),
            F.sum(micros("est_revenue")).alias("revenue_micros"),
            F.max("reviews_to_date").alias("total_reviews"),
        ),
        "priced", done=[facts],
    )
    sums = {"available": F.col("available"), "revenue_micros": F.col("revenue_micros")}
    totals = stage(
        price_summary(priced, group, "price", sums, maxima={"total_reviews": F.col("total_reviews")}, weight="days"),
        "listing-totals", done=[priced],
    )
    rows = totals.join(versions.select(*group, *DATASET_KEYS).distinct(), group)
    return rows.select(
        *DATASET_KEYS,
        F.col("median_price").alias("target_price"),
        F.try_divide(money(F.col("price_micros")), F.col("priced")).alias("avg_price"),
        (F.col("available") / F.col("rows")).alias("availability_rate"),
        money(F.col("revenue_micros")).alias("est_revenue"),
        "total_reviews",
        tenure_days("host_since", ref_date).alias("host_tenure_days"),
    )


def _versions(known: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys with their attributes and the group of these: its smallest keys as ``_<key>`` and ``_nth``.

    ``_nth`` tells groups with the same smallest keys apart; it is 1 unless a key comes twice in its dimension.
    """
    smallest = F.min(F.struct(*keys)).over(Window.partitionBy(*DATASET_KEYS))
    first = [f"_{k}" for k in keys]
    found = known.withColumn("_first", smallest).select("*", *[F.col(f"_first.{k}").alias(f"_{k}") for k in keys]).drop("_first")
    return found.withColumn("_nth", F.dense_rank().over(Window.partitionBy(*first).orderBy(*DATASET_KEYS)))


def _by_group(facts: DataFrame, versions: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """The facts by the group of their keys, and the columns of the group.

    Most keys are a group of their own, so only the others are looked up. Keys that a dimension lacks stay as they are;
    no group has their name.
    """
    group = [*[f"_{k}" for k in keys], "_nth"]
    of = [F.col(k).alias(f"_of_{k}") for k in keys]
    counted = versions.select(*of, *group, F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("_n"))
    same = functools.reduce(lambda a, b: a & b, [F.col(f"_of_{k}") == F.col(f"_{k}") for k in keys])
    moved = stage(counted.where((F.col("_n") > 1) | ~same).drop("_n"), "listing-groups")
    match = functools.reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_of_{k}") for k in keys])
    placed = facts.join(moved, match, "left").select(
        *[F.coalesce(f"_{k}", k).alias(f"_{k}") for k in keys], F.coalesce("_nth", F.lit(1)).alias("_nth"),
        *[c for c in facts.columns if c not in keys],
    )
    return placed, group


def label_market(df: DataFrame, threshold: float, above: str, other: str, col: str = "latitude") -> DataFrame:
    """Add the market, told apart by one coordinate."""
    return df.withColumn("market", label_by_threshold(col, threshold, above, other))
