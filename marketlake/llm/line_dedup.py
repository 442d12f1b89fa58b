"""Boilerplate lines by their frequency within a host.

For each host the pages that contain a line are divided by the host's pages; a line above the ratio (and on at least
``least_pages`` pages) is dropped from all pages of that host. Lines are parted by ``\\n`` and compared as they are;
lines without a word are never dropped.

Defined results: documents with a null host form one host; a null text stays null, an empty one empty; a page whose
lines all go keeps its row with the lines that are left, possibly none; repeated rows count as pages of their own,
or, with ``copies=False``, pages of a host with the same text count as one page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import NO_WORD
from marketlake.session import stage

RATIO_PERCENT = 5
LEAST_PAGES = 3


def _digest(line: Column) -> list[Column]:
    """Two independent 64-bit hashes of a line."""
    return [F.xxhash64(line), F.xxhash64(F.lit(1), line)]


def distinct_pages(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``host`` and ``text`` with one row for equal texts of a host; only texts that have copies are shuffled."""
    a, b = _digest(F.col(text))
    pages = docs.select(host, text, a.alias("__pa"), b.alias("__pb"))
    copied = pages.groupBy(F.col(host).alias("__ch"), F.col("__pa").alias("__ca"), F.col("__pb").alias("__cb")).agg(F.count(F.lit(1)).alias("__c")).where("__c > 1")
    copied = stage(copied, "copied-pages")
    same = F.col(host).eqNullSafe(F.col("__ch")) & (F.col("__pa") == F.col("__ca")) & (F.col("__pb") == F.col("__cb"))
    single = pages.join(copied, same, "left_anti")
    return single.unionByName(pages.join(copied, same, "left_semi").dropDuplicates([host, "__pa", "__pb"])).select(host, text)


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", percent: int = RATIO_PERCENT, least_pages: int = LEAST_PAGES, copies: bool = True) -> DataFrame:
    """One row per host that has boilerplate: ``__host`` and the hashes ``__a``, ``__b`` of its lines.

    Lines become two hashes before the shuffle and are counted within each task first, so a hot host or line moves one
    row per task. A host's list is bounded by its lines per page times 100 / percent.
    """
    docs = docs if copies else distinct_pages(docs, host, text)
    lines = docs.select(F.col(host).alias("__host"), F.explode(F.array_distinct(F.split(F.col(text), "\n"))).alias("__line"))
    a, b = _digest(F.col("__line"))
    counts = lines.where(~F.col("__line").rlike(NO_WORD)).groupBy("__host", a.alias("__a"), b.alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
    pages = stage(docs.groupBy(F.col(host).alias("__of")).agg(F.count(F.lit(1)).alias("__pages")), "host-pages")
    found = counts.where(F.col("__n") >= least_pages).join(pages, F.col("__host").eqNullSafe(F.col("__of")))
    found = found.where(100 * F.col("__n") > percent * F.col("__pages"))
    # Null hosts meet in eqNullSafe; the marker tells a host without boilerplate from a null host.
    return found.groupBy("__host").agg(F.collect_list("__a").alias("__a"), F.collect_list("__b").alias("__b"))


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", percent: int = RATIO_PERCENT, least_pages: int = LEAST_PAGES, copies: bool = True,
) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``, and ``__n_lines``, ``__n_dropped``.

    The lists are written first, so the optimizer knows their size and broadcasts them only below the session's
    threshold; above it both sides are shuffled by host and adaptive execution splits a hot one.
    """
    lists = stage(boilerplate(docs, host, text, percent, least_pages, copies), "boilerplate")
    df = docs.join(lists, F.col(host).eqNullSafe(F.col("__host")), "left").withColumn("__split", F.split(F.col(text), "\n"))

    def stays(line: Column) -> Column:
        a, b = _digest(line)
        pairs = F.arrays_zip(F.col("__a").alias("a"), F.col("__b").alias("b"))
        both = F.array_contains(F.col("__b"), b) & F.exists(pairs, lambda p: (p["a"] == a) & (p["b"] == b))
        return ~(F.array_contains(F.col("__a"), a) & both) | line.rlike(NO_WORD)

    df = df.withColumn("__left", F.when(F.col("__a").isNotNull(), F.filter("__split", stays)).otherwise(F.col("__split")))
    lines = F.coalesce(F.size("__split"), F.lit(0))
    lines = F.when(F.col("__split").isNull(), 0).otherwise(lines)
    left = F.when(F.col("__left").isNull(), 0).otherwise(F.size("__left"))
    df = df.withColumn("__n_lines", lines.cast("long")).withColumn("__n_dropped", (lines - left).cast("long"))
    df = df.withColumn("__text", F.when(F.col("__n_dropped") > 0, F.array_join("__left", "\n")).otherwise(F.col(text)))
    out = [F.col("__text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return df.select(*out, "__n_lines", "__n_dropped")
