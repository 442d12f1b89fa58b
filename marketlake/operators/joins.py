"""Joins of the star schema.

No side is broadcast on trust. Dimensions are written tables, so the optimizer knows their size and broadcasts
them below ``spark.sql.autoBroadcastJoinThreshold``; above it both sides are shuffled and adaptive execution
splits partitions that a hot key makes too large.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.session import stage


def _keys(on) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def left_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, _keys(on), "left")


def null_safe_lookup(df: DataFrame, table: DataFrame, keys, staged: bool = True) -> DataFrame:
    """Left join on keys of which null is a value like any other.

    ``table`` has one row per key (an aggregate). It is staged so that its true size decides between a
    broadcast and a shuffle; ``df`` itself is then not shuffled for a small table.
    """
    keys = _keys(keys)
    table = stage(table, "lookup") if staged else table
    renamed = table.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in table.columns if c not in keys])
    match = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return df.join(renamed, match, "left").drop(*[f"_k_{k}" for k in keys])


def lookup_key(df: DataFrame, dim: DataFrame, on, key: str) -> DataFrame:
    """Left join that adds the surrogate key of a dimension. Duplicate natural keys in ``dim`` multiply rows."""
    on = _keys(on)
    return df.join(dim.select(*on, key), on, "left")


def lookup_date_key(df: DataFrame, dim_date: DataFrame, date_col: str) -> DataFrame:
    """Left join to the date dimension, which holds one row per day; the session threshold decides on a broadcast."""
    days = dim_date.select("date_key", F.col("full_date").alias("_day"))
    return df.join(days, F.col(date_col).cast("date") == F.col("_day"), "left").drop("_day")


def left_join_counts(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """Add the number of ``other`` rows per key, 0 when there are none."""
    counts = other.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))


def star_join(fact: DataFrame, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    """Inner join of a fact with dimensions on their surrogate keys."""
    return functools.reduce(lambda f, d: f.join(d[0], d[1], "inner"), dims, fact)


def coalesce_eq(a, b, blank: str = "") -> Column:
    """Equality in which null and ``blank`` are the same value."""
    left, right = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.coalesce(left, F.lit(blank)) == F.coalesce(right, F.lit(blank))


def key_map(old_dim: DataFrame, new_dim: DataFrame, natural: list[str], key: str, by: str | None = None,
            blank_eq: list[str] | None = None) -> DataFrame:
    """Old surrogate key -> new surrogate key over the natural key; columns (by, key, new key)."""
    blank_eq = blank_eq or []
    scope = [by] if by else []

    def natural_cols(dim, prefix):
        return [
            (F.coalesce(F.col(c), F.lit("")) if c in blank_eq else F.col(c)).alias(f"{prefix}{c}") for c in natural
        ]

    old = old_dim.select(*scope, F.col(key).alias("_old"), *natural_cols(old_dim, "_n_"))
    new = new_dim.select(F.col(key).alias("_new"), *natural_cols(new_dim, "_n_"))
    return old.join(new, [f"_n_{c}" for c in natural], "inner").select(*scope, "_old", "_new")


def remap_keys(fact: DataFrame, old_dim: DataFrame, new_dim: DataFrame, natural: list[str], key: str,
               by: str | None = None, blank_eq: list[str] | None = None) -> DataFrame:
    """Replace a per-city surrogate key by the conformed one; rows without a match go, as in an inner join."""
    mapping = key_map(old_dim, new_dim, natural, key, by, blank_eq)
    on = ([by] if by else []) + ["_old"]
    joined = fact.withColumnRenamed(key, "_old").join(mapping, on, "inner")
    return joined.withColumnRenamed("_new", key).select(*fact.columns)


def skip_known(df: DataFrame, known: DataFrame, key: str = "sha256") -> DataFrame:
    """Rows whose key is not known yet."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def only_known(df: DataFrame, known: DataFrame, key: str = "sha256") -> DataFrame:
    """Rows whose key is known already."""
    return df.join(known.select(key), key, "left_semi")


def map_values(df: DataFrame, col: str, mapping: DataFrame, value: str, name: str, default=None) -> DataFrame:
    """Look a value up in a (col, value) table; null is a key like any other, a miss gives ``default``."""
    table = mapping.select(col, F.col(value).alias(name))
    out = null_safe_lookup(df, table, col)
    return out if default is None else out.withColumn(name, F.coalesce(F.col(name), F.lit(default)))


def duplicate_keys(dim: DataFrame, key) -> DataFrame:
    """Natural keys that occur more than once, with their count."""
    return dim.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def assert_unique(dim: DataFrame, key, dedupe: bool = False, order: list[str] | None = None) -> DataFrame:
    """Guard against a fan-out: raises on duplicate keys, or with ``dedupe`` keeps the first row per key."""
    from marketlake.operators.keys import keep_first

    if dedupe:
        return keep_first(dim, _keys(key), order or [c for c in dim.columns if c not in _keys(key)])
    if not duplicate_keys(dim, key).isEmpty():
        raise ValueError(f"duplicate keys in {_keys(key)}")
    return dim
