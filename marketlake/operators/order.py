"""Previews, top-k reports and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def head(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first n rows of an order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def top_null_columns(profile: DataFrame, k: int = 5) -> DataFrame:
    """Per table the k columns with the highest null rate above 0."""
    w = Window.partitionBy("table").orderBy(F.col("null_rate").desc(), F.col("column"))
    ranked = profile.where("null_rate > 0").withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= k).select("table", "rank", "column", "type", "null_count", "null_rate")


def top_issues(issues: DataFrame, k: int = 3) -> DataFrame:
    """Per table the number of issues and the first k of them; one row per shown issue."""
    w = Window.partitionBy("table").orderBy("position")
    total = issues.groupBy("table").agg(F.count(F.lit(1)).alias("n_issues"))
    shown = issues.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return shown.join(total, "table").select("table", "n_issues", "rank", "issue")


def top_importances(df: DataFrame, k: int = 15) -> DataFrame:
    """The k features with the largest absolute importance."""
    return df.orderBy(F.abs("importance").desc(), "feature").limit(k)


def rank_hosts(df: DataFrame, by: str = "total_estimated_revenue", n: int = 10, tie: str = "host_id") -> DataFrame:
    """The n hosts with the highest value of ``by``."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie).asc_nulls_last()).limit(n)
