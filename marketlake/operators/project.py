"""Projections, filters, fills and typed coercion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.scalars import parse_date, parse_int, parse_money
from marketlake.operators.aggregates import percentiles


def project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select ``source -> name``."""
    return df.select(*[F.col(f"`{src}`").alias(name) for src, name in mapping.items()])


def _coerced(col: str, kind: str, mode: str) -> Column:
    value = F.col(f"`{col}`")
    if mode == "fail":
        return F.regexp_replace(value, "[$,]", "").cast("float") if kind == "money" else value.cast(kind)
    if kind == "money":
        return parse_money(value)
    if kind in ("int", "bigint"):
        return parse_int(value, kind)
    if kind == "date":
        return parse_date(value)
    return value.cast("string").try_cast(kind)


def coerce(df: DataFrame, types: dict[str, str], mode: str = "null") -> DataFrame:
    """Cast columns; ``money`` strips ``$`` and ``,``. A bad value gives null, or an error in mode ``fail``."""
    if mode not in ("null", "fail"):
        raise ValueError("mode is 'null' or 'fail'")
    return df.withColumns({c: _coerced(c, kind, mode) for c, kind in types.items()})


def rejected_counts(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """One row with the number of non-blank values per column that coercion turns into null."""
    bad = {
        c: F.col(f"`{c}`").isNotNull() & (F.trim(F.col(f"`{c}`")) != "") & _coerced(c, kind, "null").isNull()
        for c, kind in types.items()
    }
    return df.agg(*[F.count_if(condition).alias(c) for c, condition in bad.items()])


def require_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def require_positive(df: DataFrame, col: str) -> DataFrame:
    """Rows whose money value is above 0; a missing value drops the row too."""
    return df.where(parse_money(col) > 0)


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def with_load_date(df: DataFrame, as_of=None, name: str = "captured_date") -> DataFrame:
    """Constant load date; ``as_of`` (a date or text) makes runs repeatable, else today."""
    return df.withColumn(name, F.current_date() if as_of is None else F.lit(str(as_of)).cast("date"))


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the columns that exist."""
    return df.drop(*cols)


def numeric_only(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Numeric columns plus those in ``keep``."""
    keep = keep or []
    return df.select(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) or f.name in keep])


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Add missing columns; a value is a literal, or ``None``/(type, value) for a typed one."""
    for name, spec in defaults.items():
        if name not in df.columns:
            kind, value = spec if isinstance(spec, tuple) else (None, spec)
            literal = F.lit(value).cast(kind or "double") if value is None or kind else F.lit(value)
            df = df.withColumn(name, literal)
    return df


def drop_null_rows(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


def fill_nulls(df: DataFrame, value, subset: list[str] | None = None) -> DataFrame:
    """Fill null and NaN by a dict of values, or by one value over the frame (or ``subset``)."""
    return df.na.fill(value) if isinstance(value, dict) else df.na.fill(value, subset=subset)


def fill_median(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace nulls by the exact median of the column. The medians are one number per column."""
    medians = {r["column"]: r["value"] for r in percentiles(df, cols, [0.5]).collect()}
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in cols if medians.get(c) is not None}
    )


def cap_filter(df: DataFrame, col: str, limit: float) -> DataFrame:
    """Rows with a value below the limit."""
    return df.where(F.col(col) < limit)


def flag_outliers(df: DataFrame, cols: list[str], k: float = 5.0, by=None) -> DataFrame:
    """Add ``<col>_outlier``: is the value more than ``k`` sample standard deviations from the mean?

    Mean and deviation are one row (a scalar subquery), or one row per group joined back.
    """
    from marketlake.operators.joins import null_safe_lookup

    def moments():
        return [m for c in cols for m in (F.avg(c).alias(f"_m_{c}"), F.stddev(c).alias(f"_s_{c}"))]

    def flag(c, mean, std):
        return F.coalesce(F.abs(F.col(c) - mean) > F.lit(float(k)) * std, F.lit(False))

    if by is None:
        stats = df.agg(F.struct(*moments()).alias("s")).scalar()
        return df.withColumns({f"{c}_outlier": flag(c, stats[f"_m_{c}"], stats[f"_s_{c}"]) for c in cols})
    keys = [by] if isinstance(by, str) else list(by)
    joined = null_safe_lookup(df, df.groupBy(*keys).agg(*moments()), keys)
    flagged = joined.withColumns({f"{c}_outlier": flag(c, F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in cols})
    return flagged.drop(*[f"_{p}_{c}" for c in cols for p in "ms"])


def filter_cities(df: DataFrame, cities: list[str], col: str = "city") -> DataFrame:
    """Rows of the listed cities, whatever the case; prunes partitions when ``col`` is a partition column."""
    return df.where(F.lower(F.col(col)).isin(*[c.lower() for c in cities]))


def keep_with_target(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """Feature columns next to the target."""
    return df.select(*[c for c in cols if c != target], target)
