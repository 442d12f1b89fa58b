"""Grouped and global aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.exact import mean_exact, mean_money, micros, percent, sum_money
from marketlake.functions.scalars import rate, sum_if  # noqa: F401  (part of this module for its users)
from marketlake.session import stage


def _n() -> Column:
    return F.count(F.lit(1))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(_n().alias(name))


def count_by(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(_n().alias(name))


def count_distinct_by(df: DataFrame, keys: list[str], col: str, name: str = "n_distinct", approx: bool = False) -> DataFrame:
    """Distinct values per group. Exact by default: Spark first groups by (keys, col), so no group meets in one task."""
    agg = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return df.groupBy(*keys).agg(agg.alias(name))


def cardinality(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """(column, cardinality) for every column; nulls are not counted."""
    cols = cols or df.columns
    if approx:
        one = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    else:
        one = df.agg(*[F.countDistinct(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)])
    return _unpivot(one, {c: {"cardinality": f"c{i}"} for i, c in enumerate(cols)})


def _unpivot(one: DataFrame, layout: dict[str, dict[str, str]]) -> DataFrame:
    """One wide row to one row per column; ``layout`` maps column -> {measure: field of the wide row}."""
    rows = F.array(
        *[F.struct(F.lit(c).alias("column"), *[F.col(f).alias(m) for m, f in measures.items()]) for c, measures in layout.items()]
    )
    return one.select(F.explode(rows).alias("r")).select("r.*")


def sum_min_max(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Sum (added up in millionths), minimum and maximum of a money column."""
    return df.groupBy(*keys).agg(
        sum_money(col).alias(f"sum_{col}"), F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}")
    )


def avg_round(df: DataFrame, keys: list[str], col: str, name: str | None = None) -> DataFrame:
    """Mean of a money column, rounded half up to two digits."""
    return df.groupBy(*keys).agg(mean_money(col).alias(name or f"avg_{col}"))


def price_summary(df: DataFrame, keys: list[str], price: str, sums: dict[str, Column], item: str | None = None,
                  maxima: dict[str, Column] | None = None, weight: str | None = None) -> DataFrame:
    """Per group: rows, priced rows, sum in millionths, min, max and exact median of a price, sums and maxima of whole
    numbers, and with ``item`` the number of its distinct values (as ``items``). With ``weight`` a row stands
    for that many rows; without items such rows are not counted again, the caller has done so.

    Median and distinct count next to each other would pass per-group maps through every step of Spark's
    distinct plan. Here equal prices and equal items are counted first, by hash aggregation on
    (keys, price or item), so a hot group is spread over its prices and items. The items of a group then fold
    into one row, before they are shuffled again; a window over the distinct prices of a group finds the middle,
    and the last group-by reuses the window's partitioning.
    """
    maxima = maxima or {}
    v_type = df.schema[price].dataType
    no_price, no_item = F.lit(None).cast(v_type).alias("_v"), F.lit(None).cast("bigint").alias("_item")
    priced = F.struct(F.col(price).alias("_v"), no_item, (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_n"),
                      *[c.cast("bigint").alias(name) for name, c in {**sums, **maxima}.items()])
    totals = [*[F.sum(s).alias(s) for s in sums], *[F.max(m).alias(m) for m in maxima]]
    if weight and item is None:
        counted = df.select(*keys, priced.alias("_p")).select(*keys, "_p.*").drop("_item")
    else:
        kinds = [priced]
        if item is not None:
            zeros = [F.lit(0).cast("bigint").alias(name) for name in ["_n", *sums]]
            nothing = [F.lit(None).cast("bigint").alias(name) for name in maxima]
            kinds.append(F.struct(no_price, F.col(item).cast("bigint").alias("_item"), *zeros, *nothing))
        rows = df.select(*keys, F.inline(F.array(*kinds)))
        counted = rows.groupBy(*keys, "_v", "_item").agg(F.sum("_n").alias("_n"), *totals)
        if item is not None:
            counted = counted.groupBy(*keys, "_v").agg(F.sum("_n").alias("_n"), *totals, F.count("_item").alias("_items"))
    n_priced = F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(F.lit(0).cast("bigint"))
    group = Window.partitionBy(*keys).orderBy("_v")
    placed = counted.withColumns({
        "_w": n_priced,
        "_before": F.coalesce(F.sum(n_priced).over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_total": F.sum(n_priced).over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })

    def at(rank):
        hit = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_w"))
        return F.max(F.when(hit, F.col("_v").cast("double")))

    low, high = at(F.floor((F.col("_total") - 1) / 2)), at(F.floor(F.col("_total") / 2))
    return placed.groupBy(*keys).agg(
        F.sum("_n").alias("rows"),
        F.sum("_w").alias("priced"),
        F.sum(F.when(F.col("_v").isNotNull(), micros("_v") * F.col("_w"))).alias("price_micros"),
        F.min("_v").alias("min_price"),
        F.max("_v").alias("max_price"),
        _between(low, high, 0.5).alias("median_price"),
        *totals,
        *([F.sum("_items").alias("items")] if item is not None else []),
    )


def round_cents(col) -> Column:
    """A price rounded half up to two digits. Rounding to four first hides the binary error of values like 1.005."""
    value = F.col(col) if isinstance(col, str) else col
    return F.floor((F.round(value * 10000) + 50) / 100).cast("double") / F.lit(100.0)


def with_medians(groups: DataFrame, df: DataFrame, keys: list[str], medians: dict[str, str]) -> DataFrame:
    """``groups`` (one row per group of ``df``) with the exact median of columns; ``medians`` has new name: column.

    Medians are picked by rank from counted values in ranges (see :func:`percentiles`): no state grows with the distinct
    values of a group, and a single group is spread over all tasks. A group without a value has a null median.
    """
    found = percentiles(df, list(dict.fromkeys(medians.values())), [0.5], keys)
    at = [F.max(F.when(F.col("column") == c, F.col("value"))).alias(name) for name, c in medians.items()]
    found = found.groupBy(*[F.col(f"`{k}`").alias(f"_m_{k}") for k in keys]).agg(*at)
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"`{k}`").eqNullSafe(F.col(f"`_m_{k}`"))
    return groups.join(found, match, "left").drop(*[f"_m_{k}" for k in keys])


def median_by(df: DataFrame, keys: list[str], col: str, name: str | None = None) -> DataFrame:
    return with_medians(df.select(*keys).distinct(), df, keys, {name or f"median_{col}": col})


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def centroids(df: DataFrame, keys: list[str], lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Mean latitude and longitude of the distinct points of every group."""
    points = df.select(*keys, lat, lon).distinct()
    return points.groupBy(*keys).agg(mean_exact(lat).alias("centroid_lat"), mean_exact(lon).alias("centroid_lon"))


def global_mean(df: DataFrame, cols: list[str], zero_is_null: bool = False) -> DataFrame:
    """One row with the mean of every column; ``zero_is_null`` leaves zeros out."""
    value = (lambda c: F.when(F.col(c) != 0, F.col(c))) if zero_is_null else F.col
    return df.agg(*[mean_exact(value(c)).alias(c) for c in cols])


def percent_of(df: DataFrame, keys: list[str], condition: Column, distinct_col: str, name: str = "pct") -> DataFrame:
    """100 * rows with the condition / distinct values, two digits half up."""
    return df.groupBy(*keys).agg(percent(sum_if(condition), F.countDistinct(distinct_col)).alias(name))


def value_counts(df: DataFrame, col: str, normalize: bool = False) -> DataFrame:
    """Rows per value (null is a value); ``normalize`` adds the share in percent."""
    counts = count_by(df, [col])
    if not normalize:
        return counts
    # One row, as a scalar subquery over the counts.
    total = df.agg(_n().alias("t")).scalar()
    return counts.withColumn("pct", F.col("n") * F.lit(100.0) / total)


def null_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, null_count, null_rate); the rate is 0 for an empty table. One pass."""
    cols = cols or df.columns
    one = df.agg(_n().alias("n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"z{i}") for i, c in enumerate(cols)])
    one = one.select(
        "*", *[F.coalesce(F.try_divide(F.col(f"z{i}"), F.col("n")), F.lit(0.0)).alias(f"r{i}") for i in range(len(cols))]
    )
    return _unpivot(one, {c: {"null_count": f"z{i}", "null_rate": f"r{i}"} for i, c in enumerate(cols)})


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with the number of nulls per column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])


def _moment_columns(c: str, i: int) -> list[Column]:
    x = F.col(f"`{c}`").cast("double")
    return [
        F.min(x).alias(f"min{i}"),
        F.max(x).alias(f"max{i}"),
        F.count(x).alias(f"cnt{i}"),
        F.avg(x).alias(f"avg{i}"),
        F.stddev(x).alias(f"std{i}"),
    ]


def numeric_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, min, max, avg, stddev) of the non-null values of numeric columns, in one pass."""
    cols = cols or numeric_columns(df)
    one = df.agg(*[m for i, c in enumerate(cols) for m in _moment_columns(c, i)])
    return _unpivot(
        one, {c: {"min": f"min{i}", "max": f"max{i}", "avg": f"avg{i}", "stddev": f"std{i}"} for i, c in enumerate(cols)}
    )


def percentiles(df: DataFrame, cols: list[str], probs: list[float], keys: list[str] | None = None) -> DataFrame:
    """Exact percentiles (linear interpolation) of many columns: (keys, column, prob, value).

    Works for a table that is one single group. Equal values are counted first; the distinct values are then
    range-partitioned, every range adds up its counts, and the number of values before a range comes from one
    row per range. No task sees more than its range.
    """
    keys = list(keys or [])
    group = [*keys, "column"]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols])
    counts = (
        df.select(*keys, F.explode(pairs).alias("p"))
        .select(*keys, "p.column", "p.value")
        .where(F.col("value").isNotNull())
        .groupBy(*group, "value")
        .agg(_n().alias("n"))
    )
    sort = [F.col(c).asc_nulls_last() for c in [*group, "value"]]
    ranged = stage(counts.repartitionByRange(*sort).withColumn("_range", F.spark_partition_id()), "ranks")
    inside = Window.partitionBy("_range", *group).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    edges = ranged.groupBy("_range", *group).agg(F.sum("n").alias("_in_range"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = stage(
        edges.select(
            *[F.col(c).alias(f"_o_{c}") for c in ["_range", *group]],
            F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_offset"),
            F.sum("_in_range").over(whole).alias("_total"),
        ),
        "rank-offsets",
    )
    match = F.col("_range") == F.col("_o__range")
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    placed = local.join(offsets, match).select(
        *group, "value", (F.col("_offset") + F.col("_before")).alias("lo"),
        (F.col("_offset") + F.col("_before") + F.col("n")).alias("hi"), F.col("_total").alias("total"),
    )
    # Only the one or two values around each rank leave their task.
    wanted = placed.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    rank = F.col("prob") * (F.col("total") - 1)
    floor, ceil = F.floor(rank), F.ceil(rank)
    wanted = wanted.select(
        *group, "prob", "value", (rank - floor).alias("frac"),
        ((floor >= F.col("lo")) & (floor < F.col("hi"))).alias("is_lo"),
        ((ceil >= F.col("lo")) & (ceil < F.col("hi"))).alias("is_hi"),
    ).where("is_lo or is_hi")
    low = F.max(F.when(F.col("is_lo"), F.col("value")))
    high = F.max(F.when(F.col("is_hi"), F.col("value")))
    return wanted.groupBy(*group, "prob").agg(_between(low, high, F.max("frac")).alias("value"))


def _between(low: Column, high: Column, fraction) -> Column:
    """Linear interpolation as Spark's own percentiles do it, to the last digit."""
    part = fraction if isinstance(fraction, Column) else F.lit(fraction)
    return F.when(low == high, low).otherwise((1 - part) * low + part * high)


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max), as a data frame's ``describe``."""
    one = df.agg(*[m for i, c in enumerate(cols) for m in _moment_columns(c, i)])
    stats = _unpivot(
        one,
        {
            c: {"count": f"cnt{i}", "mean": f"avg{i}", "std": f"std{i}", "min": f"min{i}", "max": f"max{i}"}
            for i, c in enumerate(cols)
        },
    )
    quartiles = percentiles(df, cols, [0.25, 0.5, 0.75]).groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"p{int(p * 100)}") for p in (0.25, 0.5, 0.75)]
    )
    return stats.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def group_listing_level(df: DataFrame, keys: list[str], aggs: list[Column], medians: dict[str, str] | None = None) -> DataFrame:
    """Wide group-by to listing level; null keys form groups of their own. ``medians`` has new name: column."""
    groups = df.groupBy(*keys).agg(*aggs)
    return with_medians(groups, df, keys, medians) if medians else groups


def group_market(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Wide group-by of the market snapshot."""
    return df.groupBy(*keys).agg(*aggs)
