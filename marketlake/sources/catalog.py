"""Inventory of tables and schemas, audits of raw files."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def describe_schema(df: DataFrame) -> DataFrame:
    """(position, column, type, nullable)"""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def catalog_inventory(spark: SparkSession, pattern: str | None = None, first: int = 8) -> DataFrame:
    """(table, rows, columns): every table and view of the current database with its first column names."""
    tables = [t.name for t in spark.catalog.listTables(pattern=pattern)]
    rows = []
    for name in sorted(tables):
        table = spark.table(f"`{name}`")
        rows.append(
            table.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"), "rows", F.lit(", ".join(table.columns[:first])).alias("columns")
            )
        )
    if not rows:
        return spark.createDataFrame([], "table string, rows bigint, columns string")
    return functools.reduce(lambda a, b: a.unionByName(b), rows)


def raw_null_audit(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: all rows, and the non-null values of the given columns."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *[F.count(F.col(c)).alias(f"non_null_{c}") for c in cols])
