"""Error metrics, tests and comparisons from one-pass moments."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.exact import mean_money
from marketlake.operators.aggregates import with_medians


def argmin(df: DataFrame, metric: str, tie: str) -> DataFrame:
    """The row with the smallest metric (NaN and null never win); ties go to the smallest ``tie``."""
    usable = df.where(F.col(metric).isNotNull() & ~F.isnan(metric))
    order = F.struct(F.col(metric), F.col(tie))
    return usable.agg(F.min_by(F.struct(*df.columns), order).alias("r")).where("r is not null").select("r.*")


def _metric_columns(y: str, yhat: str) -> list[Column]:
    """MAE, RMSE, MAPE in percent and R2 of predictions against the truth."""
    err = F.col(y) - F.col(yhat)
    n = F.count(err)
    ss_res = F.sum(err * err)
    ss_tot = F.var_pop(F.when(err.isNotNull(), F.col(y))) * n
    any_zero = F.max(F.when(err.isNotNull(), (F.col(y) == 0).cast("int")))
    return [
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.when(any_zero == 0, F.avg(F.abs(F.try_divide(err, F.col(y)))) * 100).alias("mape"),
        (1 - F.try_divide(ss_res, ss_tot)).alias("r2"),
    ]


def regression_metrics(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """(by, mae, rmse, mape, r2). MAPE is null when a true value is 0, R2 when the truth is constant."""
    return df.groupBy(*(by or [])).agg(*_metric_columns(y, yhat))


def mean_over_folds(metrics: DataFrame) -> DataFrame:
    """Unweighted mean of the metrics over folds."""
    return metrics.agg(*[F.avg(m).alias(m) for m in ("mae", "rmse", "mape", "r2")])


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """(n, r, t, p_value): correlation, its t statistic and two-sided p-value over rows with both values."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    one = both.agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("r"))
    r = F.col("r")
    tested = one.select("n", "r", F.try_divide(r * F.sqrt(F.greatest(F.col("n") - 2, F.lit(0))), F.sqrt(1 - r * r)).alias("t"))
    return tested.withColumn("p_value", student_p_value("t", F.col("n") - 2))


def two_sample(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Means of two groups, their difference (also in percent of b), Welch's t with its degrees of freedom and
    two-sided p-value, and Cohen's d; one pass."""

    def side(g, tag):
        v = F.when(F.col(group) == g, F.col(value))
        return [F.count(v).alias(f"n_{tag}"), F.avg(v).alias(f"mean_{tag}"), F.var_samp(v).alias(f"var_{tag}")]

    one = df.agg(*side(a, "a"), *side(b, "b"))
    n_a, n_b, var_a, var_b = (F.col(c) for c in ("n_a", "n_b", "var_a", "var_b"))
    diff = F.col("mean_a") - F.col("mean_b")
    pooled = F.sqrt(F.try_divide((n_a - 1) * var_a + (n_b - 1) * var_b, n_a + n_b - 2))
    of_a, of_b = F.try_divide(var_a, n_a), F.try_divide(var_b, n_b)
    freedom = F.try_divide((of_a + of_b) * (of_a + of_b), F.try_divide(of_a * of_a, n_a - 1) + F.try_divide(of_b * of_b, n_b - 1))
    tested = one.select(
        "n_a", "n_b", "mean_a", "mean_b", diff.alias("difference"),
        F.try_divide(diff * 100, F.col("mean_b")).alias("difference_pct"),
        F.try_divide(diff, F.sqrt(of_a + of_b)).alias("t"), freedom.alias("df"),
        F.try_divide(diff, pooled).alias("cohens_d"),
    )
    return tested.withColumn("p_value", student_p_value("t", "df"))


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the regularised incomplete beta function of (a, b), by Lentz's method.

    It converges where x < (a + 1) / (a + b + 2), within a multiple of the square root of the larger of a and b.
    """
    steps = F.sequence(F.lit(2), (F.lit(100) + 12 * F.ceil(F.sqrt(F.greatest(a, b, F.lit(1.0))))).cast("int"))

    def coefficient(j: Column) -> Column:
        m = F.floor(j / 2).cast("double")
        even = m * (b - m) * x / ((a - 1 + 2 * m) * (a + 2 * m))
        return F.when(j % 2 == 0, even).otherwise(-(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m)))

    def state(c: Column, d: Column, h: Column) -> Column:
        return F.struct(c.alias("c"), d.alias("d"), h.alias("h"))

    def step(s: Column, k: Column) -> Column:
        c, d = 1 + k / s["c"], 1 / (1 + k * s["d"])
        return state(c, d, s["h"] * c * d)

    d = 1 / (1 - (a + b) * x / (a + 1))
    return F.aggregate(F.transform(steps, coefficient), state(F.lit(1.0), d, d), step)["h"]


def _log_gamma_half_step(a: Column) -> Column:
    """log(gamma(a + 1/2) / gamma(a)): its series at a + 20, and 20 steps of the recurrence back."""
    z = a + 20
    far = F.log(z) / 2 - 1 / (8 * z) + 1 / (192 * F.pow(z, F.lit(3))) - 1 / (640 * F.pow(z, F.lit(5))) + 17 / (14336 * F.pow(z, F.lit(7)))
    return far + sum((F.log1p(-0.5 / (a + i + 0.5)) for i in range(20)), F.lit(0.0))


def student_p_value(t, df) -> Column:
    """Two-sided p-value of a t statistic with ``df`` degrees of freedom, whole or not.

    The regularised incomplete beta function of (df/2, 1/2) at df / (df + t^2), by its continued fraction; right to
    about 1e-12 of itself, far into the tail. Null for null or NaN and for less than one degree of freedom, 0 for infinity.
    """
    t, df = (F.col(c) if isinstance(c, str) else c for c in (t, df))
    t, df = F.abs(t.cast("double")), df.cast("double")
    a, square = df / 2, t * t
    log_x, y = -F.log1p(square / df), square / (df + square)
    x = df / (df + square)
    # x^a (1 - x)^(1/2) / B(a, 1/2); gamma(1/2) is the root of pi.
    front = F.exp(a * log_x + F.log(y) / 2 + _log_gamma_half_step(a) - F.log(F.lit(math.pi)) / 2)
    tail = front * _beta_fraction(a, F.lit(0.5), x) / a
    middle = 1 - front * _beta_fraction(F.lit(0.5), a, y) / 0.5
    return (
        F.when(t.isNull() | F.isnan(t) | df.isNull() | F.isnan(df) | (df < 1), F.lit(None).cast("double"))
        .when(t == 0, 1.0).when(t > 1e150, 0.0)
        .when(x < (a + 1) / (a + 2.5), tail).otherwise(middle)
    )


def market_comparison(df: DataFrame, by: str = "city", price: str = "target_price", cap: float = 1000) -> DataFrame:
    """One row per market: listings, mean and median price, mean below the cap, capacity, superhost and
    availability shares."""
    priced = df.where(F.col(price).isNotNull())
    groups = priced.groupBy(by).agg(
        F.count(F.lit(1)).alias("listings"),
        mean_money(price).alias("mean_price"),
        mean_money(F.when(F.col(price) < cap, F.col(price))).alias("mean_price_capped"),
        F.avg("accommodates").alias("mean_accommodates"),
        F.avg("bedrooms").alias("mean_bedrooms"),
        F.avg("beds").alias("mean_beds"),
        (F.avg(F.col("is_superhost").cast("int")) * 100).alias("superhost_pct"),
        (F.avg("availability_rate") * 100).alias("availability_pct"),
    )
    columns = [*groups.columns[:3], "median_price", *groups.columns[3:]]
    return with_medians(groups, priced, [by], {"median_price": price}).select(*columns)
