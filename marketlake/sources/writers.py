"""Sinks: Parquet, CSV, catalog tables and JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import release, stage


def write_silver(df: DataFrame, path: str, partition: str | None = "city", order: list[str] | None = None) -> DataFrame:
    """Snappy Parquet, partitioned by city; a run over some cities replaces only those partitions.

    With ``order`` rows are range-partitioned on (city, order) and sorted, so every file covers a narrow key
    range and its min/max statistics prune reads. A big city is cut into as many files as it needs, and so is a
    single key: a row hash, and for identical rows a running number, follow in the sort. The input is staged first, so
    that the number is counted over fixed files and a task that runs again deals the rows as before; it is deleted
    after the write.
    Returns the table as read back.
    """
    keys = ([partition] if partition else []) + list(order or [])
    out, staged = df, []
    if keys:
        hashable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
        spread = {"_hash": F.xxhash64(*hashable), "_copy": F.monotonically_increasing_id()}
        sort = [F.col(c).asc_nulls_last() for c in keys]
        staged = [stage(df, "write-input")]
        ranged = staged[0].withColumns(spread).repartitionByRange(*sort, *spread)
        out = ranged.sortWithinPartitions(*sort).drop(*spread)
    writer = out.write.mode("overwrite").option("compression", "snappy")
    if partition:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition)
    writer.parquet(path)
    release(*staged)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_sorted(df: DataFrame, cols: list[str], path: str) -> DataFrame:
    """Parquet in a total order: ranges across files, sorted inside each."""
    return write_silver(df, path, partition=None, order=cols)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create or replace a catalog table from a query; ``path`` places its files."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def publish_table(df: DataFrame, target: str, jdbc: dict | None = None, path: str | None = None,
                  batch_size: int = 10_000, writers: int = 16) -> None:
    """Replace a serving table: through JDBC when ``jdbc`` holds its options (url, user, ...), else in the catalog.

    JDBC loads truncate and refill, with at most ``writers`` connections at a time.
    """
    if jdbc:
        (
            df.write.format("jdbc").mode("overwrite")
            .options(**{"truncate": "true", "batchsize": str(batch_size), "numPartitions": str(writers), **jdbc})
            .option("dbtable", target).save()
        )
    else:
        materialise(df, target, path)


def register_views(spark: SparkSession, script: str) -> list[str]:
    """Run the ``create ... view`` statements of a script; returns the view names."""
    names = []
    for statement in (s.strip() for s in script.split(";")):
        if statement:
            spark.sql(statement)
            words = statement.split()
            names.append(words[[w.lower() for w in words].index("view") + 1])
    return names
