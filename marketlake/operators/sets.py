"""Union and conforming of per-city tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.keys import distributed_key, keep_first


def union_cities(frames: dict[str, DataFrame] | list[DataFrame], city_col: str = "city") -> DataFrame:
    """All rows of all frames; a dict of frames adds the city name as a column."""
    if isinstance(frames, dict):
        frames = [df.withColumn(city_col, F.lit(city)) for city, df in frames.items()]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def city_rank(cities: list[str], col: str = "city"):
    """Position of the row's city in the configured order; unlisted and null cities come last."""
    rank = F.lit(len(cities))
    for i, city in reversed(list(enumerate(cities))):
        rank = F.when(F.col(col) == city, i).otherwise(rank)
    return rank


def conform_dim(dims: DataFrame, natural: list[str], key: str, order: list[str], cities: list[str] | None = None,
                city_col: str = "city") -> DataFrame:
    """One dimension from per-city dimensions held in one frame with a city column.

    Of the rows that share a natural key the one with the lowest per-city key stays (ties by the order of
    ``cities``, else by name); the result gets a new dense key in the order of ``order``.
    """
    rank = city_rank(cities, city_col) if cities else F.col(city_col)
    ranked = dims.withColumn("_city_rank", rank)
    first = keep_first(ranked, natural, [key, "_city_rank", city_col]).drop("_city_rank", key)
    return distributed_key(first, order, key)
