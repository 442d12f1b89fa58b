"""Substring de-duplication over words by level-wise doubling.

Level one looks at windows of half the length: of each full window the half-length window with the smallest hash (see
``windows``), so every full window is represented and few are counted. Only where such a half occurs in several
documents are windows extended to twice that length. The extension goes run by run first: a run of full windows that
as a whole also stands in an earlier document goes at once; what is left of a half with several different runs is
compared window by window. Where no candidate survives, a level is empty and costs nothing.

A word is removed if a window that covers it also starts in a document with a smaller id; windows are judged on the
input. Hashes decide, 128 bits in all: the half's and the window's.

Defined results: a null or empty text has no words; a text shorter than a window stays whole; documents without an id
are never an earlier document and are not cut; rows with the same id do not cut each other, and
each of them is returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import windows
from marketlake.llm.common import Bounded
from marketlake.session import stage

LENGTH = 50


_NUMBERS = Bounded(lambda word: xxhash.xxh64_intdigest(word, 7))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes: only ASCII white space parts


def numbers_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_NUMBERS.__getitem__, words), np.uint64, len(words))


def _runs(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, t, text in zip(batch["doc"], batch["t"], batch["text"], strict=True):
                for key, start, n, digest, _ in windows.runs(numbers_of(words_of(text)), length, length // 2):
                    out.append((np.full(len(key), doc, np.int64), np.full(len(key), t, np.int32), key.view(np.int64), start, n, digest.view(np.int64)))
            cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 6
            yield pd.DataFrame(dict(zip(("doc", "t", "k", "start", "n", "digest"), cols, strict=True)))

    return run


def _single_windows(length: int):
    """For each document and its open runs: the hash of every full window in them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, t, text, open_runs in zip(batch["doc"], batch["t"], batch["text"], batch["open"], strict=True):
                numbers = numbers_of(words_of(text))
                for r in open_runs:
                    key, start, n = r["k"], r["start"], r["n"]
                    sums = windows.prefixes(numbers[start : start + n + length - 1])
                    at = np.arange(n)
                    out.append((np.full(n, doc, np.int64), np.full(n, t, np.int32), np.full(n, key, np.int64), at + start, windows.spans(sums, at, at + length).view(np.int64)))
            cols = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 5
            yield pd.DataFrame(dict(zip(("doc", "t", "k", "start", "h"), cols, strict=True)))

    return run


def repeated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (doc, t, text) to (doc, t, start, n): stretches of windows that also start in an earlier document."""
    docs = docs.where("doc is not null")
    all_runs = stage(docs.mapInPandas(_runs(length), "doc long, t int, k long, start long, n long, digest long"), "runs")
    # Level one: halves that several documents have.
    shared = all_runs.groupBy("k").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("k")
    runs = stage(all_runs.join(shared, "k"), "candidates")
    # Level two, whole runs: the first document with the same run, and how many different runs a half has.
    firsts = stage(runs.groupBy("k", "digest", "n").agg(F.min("doc").alias("first")), "firsts")
    later = runs.join(firsts, ["k", "digest", "n"])
    whole = later.where("doc > first").select("doc", "t", "start", "n")
    several = firsts.groupBy("k").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1").select("k")
    left = later.where("doc = first").join(several, "k")
    # Level two, window by window.
    per_doc = left.groupBy("doc", "t").agg(F.collect_list(F.struct("k", "start", "n")).alias("open"))
    single = docs.join(per_doc, ["doc", "t"]).mapInPandas(_single_windows(length), "doc long, t int, k long, start long, h long")
    single = stage(single, "single-windows")
    low = single.groupBy("k", "h").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").drop("high")
    parts = single.join(low, ["k", "h"]).where("doc > low").select("doc", "t", "start", F.lit(1).cast("long").alias("n"))
    return whole.unionByName(parts)


def _cut(length: int):
    @F.pandas_udf("n_words long, n_removed long, kept string")
    def run(texts: pd.Series, starts: pd.Series, ns: pd.Series) -> pd.DataFrame:
        rows = []
        for text, first, n in zip(texts, starts, ns, strict=True):
            words = words_of(text)
            total = len(words)
            if first is not None and len(first):
                hit = windows.covered(total, np.asarray(first), np.asarray(first) + np.asarray(n) + length - 1)
                words = [w for w, h in zip(words, hit.tolist(), strict=True) if not h]
            rows.append((total, total - len(words), b" ".join(words).decode()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words that stay, joined by one blank)."""
    # Rows with the same id may have different texts: a hash of the text tells them apart.
    own = docs.select(F.col(doc_id).cast("long").alias("doc"), F.hash(text).alias("t"), F.col(text).alias("text"))
    cuts = repeated(own, length).groupBy("doc", "t").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    rows = own.join(cuts, ["doc", "t"], "left").withColumn("x", _cut(length)(F.col("text"), F.col("starts"), F.col("ns")))
    return rows.select(F.col("doc").alias("doc_id"), "x.n_words", "x.n_removed", "x.kept")
