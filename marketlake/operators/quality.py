"""Profiles, validation rules and audits of keys."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.aggregates import cardinality, numeric_columns

PROFILE_COLUMNS = ["table", "total_rows", "position", "column", "type", "null_count", "null_rate", "cardinality",
                   "min", "max", "avg", "stddev"]


def profile(df: DataFrame, table: str, approx: bool = False) -> DataFrame:
    """One row per column: type, nulls, distinct values and, for numbers, min/max/avg/stddev.

    One pass over the table for everything but the distinct counts, one more for those (``approx`` turns them
    into sketches). The results are one row per column.
    """
    numeric = set(numeric_columns(df))
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(df.schema.fields):
        value = F.col(f"`{f.name}`")
        aggs.append(F.count_if(value.isNull()).alias(f"z{i}"))
        stats = ["min", "max", "avg", "stddev"]
        if f.name in numeric:
            number = value.cast("double")
            aggs += [getattr(F, s)(number).alias(f"{s}{i}") for s in stats]
        rows.append(
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"z{i}").alias("null_count"),
                F.coalesce(F.try_divide(F.col(f"z{i}"), F.col("n")), F.lit(0.0)).alias("null_rate"),
                *[(F.col(f"{s}{i}") if f.name in numeric else F.lit(None)).cast("double").alias(s) for s in stats],
            )
        )
    one = df.agg(*aggs).select(F.col("n").alias("total_rows"), F.explode(F.array(*rows)).alias("r"))
    flat = one.select(F.lit(table).alias("table"), "total_rows", "r.*")
    return flat.join(cardinality(df, approx=approx), "column", "left").select(*PROFILE_COLUMNS)


def profile_many(frames: dict[str, DataFrame], approx: bool = False) -> DataFrame:
    """Profiles of several tables in one frame."""
    return functools.reduce(lambda a, b: a.unionByName(b), [profile(df, name, approx) for name, df in frames.items()])


def validate(profiles: DataFrame, min_rows: int = 10, max_null_fraction: float = 0.5) -> DataFrame:
    """Issues (table, position, issue): too few rows (position 0), too many nulls in a column."""
    few = (
        profiles.select("table", "total_rows").distinct().where(F.col("total_rows") < min_rows)
        .select("table", F.lit(0).alias("position"),
                F.format_string(f"Table has only %d rows (min: {min_rows})", "total_rows").alias("issue"))
    )
    percent = f"{max_null_fraction * 100:.2f}%%"
    sparse = profiles.where(F.col("null_rate") > max_null_fraction).select(
        "table", "position",
        F.format_string(f"Column %s has null rate %.2f%% (max: {percent})", "column", F.col("null_rate") * 100).alias("issue"),
    )
    return few.unionByName(sparse)


def report_json(profiles: DataFrame, timestamp: str) -> DataFrame:
    """The profile report as one JSON text per table."""
    body = F.struct(*[c for c in PROFILE_COLUMNS if c not in ("table", "total_rows")])
    return profiles.groupBy("table", "total_rows").agg(F.sort_array(F.collect_list(body)).alias("columns")).select(
        F.to_json(F.struct(F.lit(timestamp).alias("timestamp"), "table", "total_rows", "columns")).alias("report")
    )


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once. Rows with a null key count too."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def check_fk(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact keys without a dimension row, with the number of fact rows. Null keys are no violation.

    The fact is counted per key before the join, so only distinct keys are compared.
    """
    used = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("orphans"))
    return used.join(dim.select(key), key, "left_anti")


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, nulls) of the columns that must not be null; one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one.unpivot([], cols, "column", "nulls")


def readiness(df: DataFrame, target: str) -> DataFrame:
    """One row: is the target there, are all features numeric, how many rows, null targets, null features?"""
    features = [f for f in df.schema.fields if f.name not in (target, "listing_id")]
    text = [f.name for f in features if not isinstance(f.dataType, T.NumericType)]
    numeric = [f.name for f in features if isinstance(f.dataType, T.NumericType)]
    has_target = target in df.columns
    null_target = F.count_if(F.col(target).isNull() | F.isnan(F.col(target).cast("double"))) if has_target else F.count(F.lit(1))
    nulls = functools.reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in numeric], F.lit(0))
    one = df.agg(F.count(F.lit(1)).alias("rows"), null_target.alias("null_targets"), nulls.cast("bigint").alias("null_features"))
    return one.select(
        F.lit(has_target).alias("has_target"),
        F.lit(",".join(sorted(text))).alias("non_numeric"),
        "rows", "null_targets", "null_features",
        (F.lit(has_target and not text) & (F.col("null_targets") == 0)).alias("ready"),
    )


def leak_check(df: DataFrame, target: str, threshold: float = 0.99) -> DataFrame:
    """(feature, r, leaks): correlation of every numeric feature with the target, all in one pass."""
    features = [c for c in numeric_columns(df) if c != target]
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in features])
    long = one.unpivot([], features, "feature", "r")
    return long.withColumn("leaks", F.coalesce(F.abs("r") > threshold, F.lit(False)))
