"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted in cells of source, language and topic, by tokens. The cells are raked: in turn for each of the
three, every level's tokens are scaled to its target, until nothing moves any more. A cell's factor over the largest
factor is the probability with which its documents are sampled, so the expected mix has the target marginals and no
document is taken twice.

Targets are shares by level; without them a dimension's own shares are flattened by the power ``flatten`` (1 keeps
them, 0 makes all levels equal). A hash of id and text decides, so a rerun takes the same documents.

Defined results: a null level is a level of its own; a null or empty text weighs one token (its end), as every text has
one more token than words; targets for levels without documents are left out and the others scaled up; levels
without a target keep their tokens' share; a share of 0 takes no document; shares that cannot all be met give a warning; copies with the same id share their fate; an empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import GAP, text_of
from marketlake.session import stage

FLATTEN = 0.9
TOLERANCE = 1e-3
ROUNDS = 40
_DIMS = ("__source", "__lang", "__topic")


def topic_of(text: Column) -> Column:
    """A coarse topic from the text itself."""
    return (
        F.when(text.rlike("(?i)licen[cs]e|copyright"), "legal").when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("@")) | F.contains(text, F.lit("://")), "contact").otherwise("prose")
    )


def weight_of(text: Column) -> Column:
    """Words and an end of text."""
    return F.size(F.array_remove(F.split(text, GAP), "")) + 1


def _targets(cells: DataFrame, dim: str, shares: Mapping | None, flatten: float, total: float) -> DataFrame:
    """(level, target tokens) of a dimension; the targets add up to ``total``."""
    own = cells.groupBy(dim).agg(F.sum("w").alias("own"))
    if shares is None:
        own = own.withColumn("share", F.pow("own", flatten))
    else:
        named = F.coalesce(*[F.when(F.col(dim).eqNullSafe(k), F.lit(float(v))) for k, v in shares.items()])
        own = own.withColumn("share", F.coalesce(named, F.col("own") / total))
    own = stage(own, "targets")
    scale = own.agg(F.sum("share")).first()[0]
    return own.select(F.col(dim).alias("level"), (F.col("share") * (total / scale)).alias("target"))


def fit(cells: DataFrame, shares: Mapping[str, Mapping] | None = None, flatten: float = FLATTEN) -> DataFrame:
    """``cells`` (the dimensions, w) with ``factor``: fitted tokens over own tokens.

    Cells are aggregates; each round is one written table, of which marginals are taken with map-side sums.
    """
    current = stage(cells.withColumn("own", F.col("w")), "cells")
    total = current.agg(F.sum("w")).first()[0]
    if not total:
        return current.withColumn("factor", F.lit(1.0))
    targets = {dim: _targets(current, dim, (shares or {}).get(dim.strip("_")), flatten, total) for dim in _DIMS}
    for _ in range(ROUNDS):
        new = current.withColumn("before", F.col("w"))
        for dim, target in targets.items():
            sums = new.groupBy(F.col(dim).alias("at")).agg(F.sum("w").alias("now"))
            scale = sums.join(target, F.col("at").eqNullSafe(F.col("level"))).select("at", F.when(F.col("now") > 0, F.col("target") / F.col("now")).otherwise(0.0).alias("by"))
            new = new.join(scale, F.col(dim).eqNullSafe(F.col("at"))).withColumn("w", F.col("w") * F.col("by")).drop("at", "by")
        current = stage(new.withColumn("moved", F.when(F.col("before") > 0, F.abs(F.col("w") / F.col("before") - 1)).otherwise(0.0)), "cells")
        if current.agg(F.max("moved")).first()[0] < TOLERANCE:
            break
        current = current.drop("before", "moved")
    off = [
        current.groupBy(F.col(dim).alias("at")).agg(F.sum("w").alias("now")).join(target, F.col("at").eqNullSafe(F.col("level"))).agg(F.max(F.abs(F.col("now") - F.col("target"))))
        for dim, target in targets.items()
    ]
    worst = max((d.first()[0] or 0.0) for d in off) / total
    if worst > 10 * TOLERANCE:
        warnings.warn(f"these target shares cannot all be met: one of them is off by {worst:.3f}", stacklevel=2)
    return current.select(*_DIMS, "own", (F.col("w") / F.col("own")).alias("factor"))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
    topic: Column | None = None, shares: Mapping[str, Mapping] | None = None, flatten: float = FLATTEN, seed: int = 17,
) -> DataFrame:
    """``docs`` with ``__topic``, ``__tokens``, ``__probability`` and ``__sampled``; ``shares`` by 'source', 'lang', 'topic'."""
    topic = topic_of(text_of(text)) if topic is None else topic
    marked = docs.withColumn("__topic", topic).withColumn("__tokens", weight_of(text_of(text)).cast("long"))
    cells = marked.groupBy(F.col(source).alias("__source"), F.col(lang).alias("__lang"), "__topic").agg(F.sum("__tokens").cast("double").alias("w"))
    factors = fit(cells, shares, flatten)
    top = factors.agg(F.max("factor")).first()[0]
    # The written cells are small where sources are few; the optimizer broadcasts them only below its threshold.
    chances = stage(factors.select(F.col("__source").alias("__s"), F.col("__lang").alias("__l"), F.col("__topic").alias("__t"), (F.col("factor") / (top or 1.0)).alias("__probability")), "chances")
    same = F.col(source).eqNullSafe(F.col("__s")) & F.col(lang).eqNullSafe(F.col("__l")) & F.col("__topic").eqNullSafe(F.col("__t"))
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 11) / F.lit(float(1 << 53))
    return marked.join(chances, same).drop("__s", "__l", "__t").withColumn("__sampled", drawn < F.col("__probability"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents with their own columns."""
    return mix(docs, **options).where("__sampled").select(*[F.col(f"`{c}`") for c in docs.columns])
