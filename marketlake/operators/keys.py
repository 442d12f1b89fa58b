"""Dense surrogate keys and first-row selection without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import stage


def _sort(cols) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def _orderable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]


def distributed_key(df: DataFrame, order: list[str], name: str, by: list[str] | None = None) -> DataFrame:
    """Number the rows 1..n in the order of ``order``, restarting for every value of ``by``.

    Equals ``row_number() over (partition by <by> order by <order>)`` but never brings a group, or the table,
    into one task: rows are range-partitioned on the whole sort key, so a hot key is cut by the columns after it.
    Each range keeps its local positions and gets the number of rows before it; that offset table has at most
    one row per range and group edge. Columns not named in ``order`` break ties, so the numbering repeats.
    The input is staged first: it is evaluated once, and the running number that spreads identical rows is counted
    over fixed files, so a task that runs again gives the same cut. The ranges are staged because the counts and the
    rows must see the same cut; the staged input is deleted then.
    """
    by = list(by or [])
    df = stage(df, f"key-input-{name}")
    ties = [c for c in _orderable(df) if c not in by and c not in order]
    sort = _sort([*by, *order, *ties])
    ranged = (
        df.withColumn("_copy", F.monotonically_increasing_id())  # spreads identical rows over ranges
        .repartitionByRange(*sort, F.col("_copy"))
        .sortWithinPartitions(*sort, F.col("_copy"))
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
        .drop("_copy")
    )
    ranged = stage(ranged, f"key-{name}", done=[df])
    edges = ranged.groupBy("_range", *by).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    if not by:
        return ranged.select((F.col("_pos") + _shifts(edges)).cast("bigint").alias(name), *df.columns)
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = edges.select(
        F.col("_range").alias("_o_range"),
        *[F.col(c).alias(f"_o_{c}") for c in by],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    match = F.col("_range") == F.col("_o_range")
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    # As many rows as ranges and groups; staged, so that its true size decides how it is joined.
    return ranged.join(stage(offsets, "offsets"), match, "inner").select(
        (F.col("_pos") + F.col("_shift")).cast("bigint").alias(name), *df.columns
    )


def _shifts(edges: DataFrame) -> Column:
    """What to add to a local position: the rows in earlier ranges, looked up by range number.

    One number per range comes to the driver, as when an index is zipped to partitions.
    """
    shifts, before = {}, 0
    for r in sorted(edges.collect(), key=lambda r: r["_range"]):
        shifts[r["_range"]] = before - r["_first"] + 1
        before += r["_n"]
    return F.get(F.lit([shifts.get(i, 0) for i in range(max(shifts, default=0) + 1)]), F.col("_range"))


def surrogate_key(df: DataFrame, order: list[str], name: str, by: list[str] | None = None) -> DataFrame:
    """Dense key of a dimension; the key is the first column."""
    return distributed_key(df, order, name, by)


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of every key.

    A rank limit of 1 lets Spark drop all but one row per key and task before the shuffle, so a hot key sends
    one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_sort(order)))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
