"""Frequencies and codes of categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.joins import null_safe_lookup
from marketlake.operators.keys import distributed_key
from marketlake.session import stage


def freq_encode(df: DataFrame, cols: list, normalize: bool = False, names: list[str] | None = None) -> DataFrame:
    """Add how often the row's category occurs; null is a category.

    ``cols`` holds column names or tuples of names (interactions). All frequencies come from one grouping-sets
    pass with map-side combine, so rows are never shuffled by a hot category; the counts are joined back.
    """
    sets = [[c] if isinstance(c, str) else list(c) for c in cols]
    names = names or [f"{'_'.join(s)}_freq" for s in sets]
    used = list(dict.fromkeys(c for s in sets for c in s))
    # A flag per set tells the groups apart: grouping_id() has a bit for each column that is rolled up.
    keys = df.select(*used).groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in used])
    counts = stage(keys.agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set")), "frequencies")
    total = df.agg(F.count(F.lit(1)).alias("t")).scalar() if normalize else None
    out = df
    for s, name in zip(sets, names):
        bits = sum(1 << (len(used) - 1 - i) for i, c in enumerate(used) if c not in s)
        n = F.col("_n").cast("double")
        table = counts.where(F.col("_set") == bits).select(*s, n.alias(name))
        out = null_safe_lookup(out, table, s, staged=False)
    if normalize:
        out = out.withColumns({name: F.col(name) / total for name in names})
    return out


def freq_encode_pair(df: DataFrame, a: str, b: str, name: str, normalize: bool = False) -> DataFrame:
    """Frequency of the pair of two columns."""
    return freq_encode(df, [(a, b)], normalize, [name])


def label_encode(df: DataFrame, cols, names: list[str] | None = None) -> DataFrame:
    """Position of the category in sorted order from 0, -1 for null; columns of one type are coded together.

    The distinct values of all columns are collected in one pass and numbered per column without a global sort.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    names = names or [f"{c}_code" for c in cols]
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).alias("_level")) for c in cols]))
    levels = df.select(pairs).where(F.col("_level").isNotNull()).distinct()
    codes = stage(distributed_key(levels, ["_level"], "_code", by=["_column"]), "codes")
    for c, name in zip(cols, names):
        table = codes.where(F.col("_column") == c).select(F.col("_level").alias(c), (F.col("_code") - 1).alias(name))
        df = df.join(table, c, "left").withColumn(name, F.coalesce(F.col(name), F.lit(-1).cast("bigint")))
    return df
