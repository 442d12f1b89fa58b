"""Market, host and neighbourhood marts over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.exact import micros, money, percent, ratio_money
from marketlake.operators.aggregates import price_summary, round_cents
from marketlake.operators.joins import star_join

SNAPSHOT_KEYS = ["full_date", "year", "month", "season", "neighbourhood", "neighbourhood_group", "room_type", "property_type"]
HOST_KEYS = ["host_id", "host_name", "is_superhost", "host_since", "host_listings_count"]


def _sums() -> dict:
    """Whole-number measures of the fact: available rows, revenue in millionths, reviews."""
    available = F.coalesce(F.col("is_available"), F.lit(False)).cast("int")
    return {"available_count": available, "revenue_micros": micros("est_revenue"), "total_reviews": F.col("reviews_to_date")}


def daily_market_snapshot(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Per day, area, room and property type: listings, availability, prices, revenue, reviews.

    The fact is grouped by the keys of day and area, which stand for their attributes, and only the groups meet
    those two dimensions. The host dimension adds no column but keeps only facts with a known host.
    """
    kept = fact.join(dims["hosts"].select("host_key"), "host_key", "left_semi")
    typed = star_join(kept, [(dims["listings"].select("listing_key", "room_type", "property_type"), "listing_key")])
    groups = price_summary(typed, ["date_key", "neighbourhood_key", "room_type", "property_type"], "price", _sums(), "listing_key")
    areas = dims["neighbourhoods"].select("neighbourhood_key", "neighbourhood", "neighbourhood_group")
    dates = dims["dates"].select("date_key", "full_date", "year", "month", "season")
    return star_join(groups, [(areas, "neighbourhood_key"), (dates, "date_key")]).select(
        *SNAPSHOT_KEYS,
        F.col("items").alias("active_listings"),
        "available_count",
        ratio_money(F.col("price_micros"), F.col("priced")).alias("avg_price"),
        round_cents("median_price").alias("median_price"),
        "min_price",
        "max_price",
        money(F.col("revenue_micros")).alias("total_estimated_revenue"),
        "total_reviews",
    )


def host_performance(fact: DataFrame, hosts: DataFrame) -> DataFrame:
    """Per host: listings, mean price, available days, revenue, reviews.

    The fact is first added up per host key and listing, which also resolves the distinct count and splits a
    host with very many rows; only these partial rows meet the host attributes and the final group.
    """
    partial = fact.groupBy("host_key", "listing_key").agg(
        F.sum(micros("price")).alias("price_micros"),
        F.count("price").alias("priced"),
        *[F.sum(c).alias(name) for name, c in _sums().items()],
    )
    joined = star_join(partial, [(hosts.select("host_key", *HOST_KEYS), "host_key")])
    return joined.groupBy(*HOST_KEYS).agg(
        F.countDistinct("listing_key").alias("active_listings"),
        ratio_money(F.sum("price_micros"), F.sum("priced")).alias("avg_price"),
        F.sum("available_count").alias("total_available_days"),
        money(F.sum("revenue_micros")).alias("total_estimated_revenue"),
        F.sum("total_reviews").alias("total_reviews"),
    )


def neighbourhood_trends(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Per area and day: listings, mean price, available rows and their share.

    Added up per area, day and listing first, then per area and day; attributes are joined to the groups.
    """
    partial = fact.groupBy("neighbourhood_key", "date_key", "listing_key").agg(
        F.sum(micros("price")).alias("price_micros"), F.count("price").alias("priced"),
        F.sum(_sums()["available_count"]).alias("available_count"),
    )
    groups = partial.groupBy("neighbourhood_key", "date_key").agg(
        F.count("listing_key").alias("listing_count"), F.sum("price_micros").alias("price_micros"),
        F.sum("priced").alias("priced"), F.sum("available_count").alias("available_count"),
    )
    areas = dims["neighbourhoods"].select("neighbourhood_key", "neighbourhood", "neighbourhood_group")
    dates = dims["dates"].select("date_key", "full_date")
    return star_join(groups, [(areas, "neighbourhood_key"), (dates, "date_key")]).select(
        "neighbourhood", "neighbourhood_group", "full_date", "listing_count",
        ratio_money(F.col("price_micros"), F.col("priced")).alias("avg_price"),
        "available_count",
        percent(F.col("available_count"), F.col("listing_count")).alias("availability_rate"),
    )


def daily_market_summary(fact: DataFrame) -> DataFrame:
    """Per date and area key: listings, available rows, mean and median price, reviews."""
    groups = price_summary(fact, ["date_key", "neighbourhood_key"], "price", _sums(), "listing_key")
    return groups.select(
        "date_key", "neighbourhood_key", F.col("items").alias("total_listings"), "available_count",
        ratio_money(F.col("price_micros"), F.col("priced")).alias("avg_price"),
        round_cents("median_price").alias("median_price"),
        "total_reviews",
    )


def register_marts(fact: DataFrame, dims: dict[str, DataFrame]) -> list[str]:
    """The three marts as session views for SQL users, with the plans of the functions above; returns their names."""
    views = {
        "v_daily_market_snapshot": daily_market_snapshot(fact, dims),
        "v_host_performance": host_performance(fact, dims["hosts"]),
        "v_neighbourhood_trends": neighbourhood_trends(fact, dims),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
