"""Column functions on money, numbers, dates, booleans and categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- money and numbers ---------------------------------------------------------------------------------------


def parse_money(col, type_: str = "float") -> Column:
    """``'$1,234.50'`` -> 1234.5; text that is no number gives null."""
    return F.regexp_replace(_c(col).cast("string"), "[$,]", "").try_cast(type_)


def parse_int(col, type_: str = "int") -> Column:
    """Whole number from text; accepts ``'3'`` and ``'3.0'``, anything else gives null."""
    text = F.regexp_replace(F.trim(_c(col).cast("string")), r"\.0*$", "")
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text).try_cast(type_)


def to_numeric(col) -> Column:
    """Double from anything, null when it is not a number."""
    return _c(col).cast("string").try_cast("double")


def clip(col, lower=None, upper=None) -> Column:
    """Bound a value below and above; null stays null."""
    value = _c(col)
    bounded = value
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, F.lit(upper))
    return F.when(value.isNotNull(), bounded)


def first_non_null(*cols) -> Column:
    return F.coalesce(*[_c(c) for c in cols])


def est_revenue(price, available) -> Column:
    """Price on available days, 0 otherwise and when the price is missing."""
    return F.coalesce(_c(price) * F.when(_c(available), 1.0).otherwise(0.0), F.lit(0.0))


def safe_ratio(a, b, on_zero=None) -> Column:
    """a / b as double. A zero denominator gives ``on_zero``; a null operand gives null."""
    ratio = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    if on_zero is None:
        return ratio
    return F.when(_c(b) == 0, F.lit(float(on_zero))).otherwise(ratio)


def positive_ratio(a, b, on_other: float = 0.0) -> Column:
    """a / b when b > 0, else ``on_other`` (also for null)."""
    ratio = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return F.coalesce(F.when(_c(b) > 0, ratio), F.lit(float(on_other)))


def inf_to_null(col) -> Column:
    value = _c(col)
    return F.when(F.abs(value) != F.lit(float("inf")), value)


def log1p_clipped(col) -> Column:
    """log(1 + x) with negative x taken as 0."""
    return F.log1p(clip(_c(col).cast("double"), lower=0.0))


def abs_(col) -> Column:
    return F.abs(_c(col))


def smoothed_ratio(a, b, scale: float = 1.0, offset: float = 1.0) -> Column:
    """a / (b * scale + offset)"""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double") * F.lit(float(scale)) + F.lit(float(offset)))


def capacity_ratios(beds="beds", bedrooms="bedrooms", accommodates="accommodates") -> list[Column]:
    """The four layout ratios; a zero denominator gives null."""
    return [
        safe_ratio(beds, bedrooms).alias("beds_per_bedroom"),
        safe_ratio(accommodates, beds).alias("accommodates_per_bed"),
        safe_ratio(accommodates, bedrooms).alias("accommodates_per_bedroom"),
        safe_ratio(beds, accommodates).alias("beds_per_accommodate"),
    ]


def bool_to_num(col, missing: int | None = 0) -> Column:
    """Boolean or ``t``/``f``/``true``/``false`` text to 1/0; unknown values become ``missing``."""
    number = _c(col).cast("string").try_cast("boolean").cast("int")
    return number if missing is None else F.coalesce(number, F.lit(missing))


# --- dates ---------------------------------------------------------------------------------------------------


def parse_date(col) -> Column:
    return _c(col).cast("string").try_cast("date")


def year(col) -> Column:
    return F.year(_c(col))


def month(col) -> Column:
    return F.month(_c(col))


def isodow(col) -> Column:
    """ISO weekday, Monday = 1."""
    return F.weekday(_c(col)) + 1


def is_weekend(iso_weekday) -> Column:
    return _c(iso_weekday).isin(6, 7)


def season(month_number) -> Column:
    m = _c(month_number)
    return (
        F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring").when(m.isin(6, 7, 8), "Summer").otherwise("Fall")
    )


def tenure_days(col, ref_date: str = "2026-06-23", missing: int = -1) -> Column:
    """Days from a date to the reference date."""
    return F.coalesce(F.datediff(F.lit(ref_date).cast("date"), _c(col)), F.lit(missing))


def tenure_years(days) -> Column:
    return _c(days) / F.lit(365.0)


# --- categories ----------------------------------------------------------------------------------------------


def label_by_threshold(col, threshold: float, above: str = "A", other: str = "B") -> Column:
    """``above`` when the value exceeds the threshold, else ``other``; null counts as ``other``."""
    return F.when(_c(col) > threshold, above).otherwise(other)


def sum_if(condition: Column) -> Column:
    """Number of rows for which the condition holds."""
    return F.sum(F.when(condition, 1).otherwise(0))


def rate(condition: Column) -> Column:
    """Share of rows for which the condition holds."""
    return F.sum(F.when(condition, 1).otherwise(0)) / F.count(F.lit(1))


def one_hot(df: DataFrame, col: str, drop_first: bool = True, max_levels: int = 1000) -> DataFrame:
    """One 0/1 column per level (sorted), the first dropped by default; the category column itself goes away.

    Levels become columns, so all of them come to the driver; more than ``max_levels`` are an error, never a cut.
    """
    found = df.where(F.col(col).isNotNull()).select(col).distinct().limit(max_levels + 1).collect()
    if len(found) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels; use label_encode or freq_encode")
    levels = sorted(r[0] for r in found)[1 if drop_first else 0 :]
    flags = [F.coalesce(F.col(col) == v, F.lit(False)).cast("int").alias(f"{col}_{v}") for v in levels]
    return df.select(*[c for c in df.columns if c != col], *flags)


def to_currency(df: DataFrame, rates: DataFrame, price: str = "price", on: str = "currency", rate_col: str = "rate",
                name: str = "price_converted") -> DataFrame:
    """Price times the rate of its currency (or market and date); without a rate the result is null.

    A plain equi-join: the optimizer broadcasts the rates when their known size allows it.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(rates.select(*keys, rate_col), keys, "left").withColumn(name, F.col(price) * F.col(rate_col)).drop(rate_col)
