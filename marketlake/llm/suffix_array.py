"""Substring de-duplication over bytes with sharded, externally sorted suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else, in its own document or another. The
windows of LENGTH bytes fall into runs by their smallest gram (see ``windows``); equal windows have equal keys, so a key
that occurs once cannot hold a repeat and its bytes never move. Runs that are equal as a whole are counted by their
digest: all their windows repeat. What is left - keys with several different runs - is cut from the texts, one piece
for each different run, and dealt to shards by key. Each shard writes its pieces to its disk, sorts their suffixes by
external induced sorting (see ``induced_sort``) and reports the windows that share LENGTH bytes with a neighbour.

A key with more than HOT different runs is dealt by key and place of the key in the window, which equal windows also
have in common. Long runs are cut into pieces of PIECE windows. Whole runs are equal by 128 bits of hashes; suffixes are
compared byte by byte.

Defined results: a null or empty text has no bytes; a text shorter than LENGTH stays whole; every row counts as a text of
its own, so of two equal rows both lose everything that is long enough; null ids are rows like others; an empty table
gives no rows. What is left need not be valid UTF-8, so it is a binary column.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm import windows
from marketlake.llm.common import tasks
from marketlake.llm.induced_sort import Sorter
from marketlake.session import stage

LENGTH = 200
GRAM = 96
HOT = 20_000
PIECE = 4096
#: A hot key is dealt by the place of the key in steps of this many bytes.
STEP = 16


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def _frame(rows: list, names: tuple[str, ...], kinds: tuple) -> pd.DataFrame:
    cols = [np.concatenate(x) for x in zip(*rows, strict=True)] if rows else [np.empty(0, k) for k in kinds]
    return pd.DataFrame({n: c.astype(k) for n, c, k in zip(names, cols, kinds, strict=True)})


def _runs(length: int, gram: int):
    names = ("doc", "t", "k", "start", "n", "digest", "several")
    kinds = (np.int64, np.int32, np.int64, np.int64, np.int32, np.int64, bool)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, t, text in zip(batch["doc"], batch["t"], batch["text"], strict=True):
                for key, start, n, digest, several in windows.runs(_bytes(text), length, gram, windows.BYTES):
                    m = len(key)
                    out.append((np.full(m, doc), np.full(m, t), key.view(np.int64), start, n, digest.view(np.int64), several))
            yield _frame(out, names, kinds)

    return run


_PIECES = "k long, part int, doc long, t int, start long, n int, open boolean, data binary"


def _pieces(length: int, gram: int):
    """The bytes of the contested runs; a hot run is cut where the place of its key in the window changes its class."""

    def cut(run, data: np.ndarray) -> Iterator[tuple[int, int, int]]:
        start, n = run["start"], run["n"]
        if run["hot"]:
            hashes = windows.grams(windows.prefixes(windows.BYTES[data[start : start + n + length - 1]]), gram)
            at = np.arange(n)
            places = np.flatnonzero(hashes.view(np.int64) == run["k"])
            parts = (places[np.searchsorted(places, at)] - at) // STEP
        else:
            parts = np.zeros(n, np.int64)
        edges = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]]))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), n], strict=True):
            for low in range(a, b, PIECE):
                yield int(parts[a]), start + low, min(PIECE, b - low)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, t, text, contested in zip(batch["doc"], batch["t"], batch["text"], batch["runs"], strict=True):
                data = _bytes(text)
                for r in contested:
                    for part, start, n in cut(r, data):
                        rows.append((r["k"], part, doc, t, start, n, r["open"], data[start : start + n + length - 1].tobytes()))
            yield pd.DataFrame(rows, columns=["k", "part", "doc", "t", "start", "n", "open", "data"])

    return run


def _sort_shard(length: int):
    """The pieces of a shard to the stretches of windows in open pieces that repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:
            info = []
            with open(f"{folder}/text", "wb") as out:
                for batch in batches:
                    cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
                    data = batch.column(5)
                    for x in data:
                        # Symbols: a byte plus 2; 1 closes a piece.
                        np.append(np.frombuffer(x.as_buffer(), np.uint8).astype(np.uint16) + 2, np.uint16(1)).tofile(out)
                    info.append(cols)
                if not info:
                    return
                np.zeros(4, np.uint16).tofile(out)
            doc, t, start, n, is_open = (np.concatenate(c) for c in zip(*info, strict=True))
            if not len(doc):
                return
            x = np.memmap(f"{folder}/text", np.uint16, "r")
            begins = np.cumsum(np.concatenate([[0], n.astype(np.int64) + length]))[:-1]
            found = []
            for pos in Sorter(x, len(x) - 3, length, folder).groups():
                piece = np.searchsorted(begins, pos, "right") - 1
                keep = is_open[piece] & (pos - begins[piece] < n[piece])
                found.append(pos[keep])
            pos = np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)
            piece = np.searchsorted(begins, pos, "right") - 1
            at = pos - begins[piece] + start[piece]
            edge = np.ones(len(pos), bool)
            edge[1:] = (piece[1:] != piece[:-1]) | (at[1:] != at[:-1] + 1)
            first = np.flatnonzero(edge)
            size = np.diff(np.append(first, len(pos)))
            cols = [pa.array(doc[piece[first]], pa.int64()), pa.array(t[piece[first]], pa.int32()), pa.array(at[first], pa.int64()), pa.array(size, pa.int32())]
            del x
            yield pa.RecordBatch.from_arrays(cols, names=["doc", "t", "start", "n"])

    return run


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``docs`` (doc, t, text, ...) to (doc, t, start, n): stretches of windows that also start elsewhere.

    Texts are shuffled by doc and t with all columns of ``docs``, so that a join of the same rows with the result by doc
    and t is served by the same shuffle.
    """
    schema = "doc long, t int, k long, start long, n int, digest long, several boolean"
    all_runs = stage(docs.select("doc", "t", "text").mapInPandas(_runs(length, gram), schema), "runs")
    twice = all_runs.groupBy("k").agg(F.count(F.lit(1)).alias("c"), F.max("several").alias("s")).where("c > 1 or s").select("k")
    runs = stage(all_runs.join(twice, "k"), "candidates", done=[all_runs])
    place = F.struct("doc", "t", "start")
    variants = runs.groupBy("k", "digest", "n").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("first"), F.max("several").alias("s"))
    variants = stage(variants, "variants")
    whole = runs.join(variants.where("c > 1").select("k", "digest", "n"), ["k", "digest", "n"]).select("doc", "t", "start", "n")
    # Different runs of one key, or one that may repeat within itself: one piece for each goes to the shards.
    keys = variants.groupBy("k").agg(F.count(F.lit(1)).alias("v"), F.max("s").alias("s"), F.min("c").alias("least"))
    keys = keys.where("(v > 1 or s) and least = 1").select("k", (F.col("v") > hot).alias("hot"))
    contested = variants.join(keys, "k").select("first.doc", "first.t", F.struct("k", F.col("first.start").alias("start"), "n", "hot", (F.col("c") == 1).alias("open")).alias("run"))
    per_doc = contested.groupBy("doc", "t").agg(F.collect_list("run").alias("runs"))
    distinct = docs.join(per_doc, ["doc", "t"]).dropDuplicates(["doc", "t"])
    pieces = distinct.mapInPandas(_pieces(length, gram), _PIECES).repartition(tasks(docs.sparkSession), "k", "part")
    parts = pieces.select("doc", "t", "start", "n", "open", "data").mapInArrow(_sort_shard(length), "doc long, t int, start long, n int")
    return whole.unionByName(parts)


def _cut(length: int):
    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def run(texts: pd.Series, starts: pd.Series, ns: pd.Series) -> pd.DataFrame:
        rows = []
        for text, first, n in zip(texts, starts, ns, strict=True):
            data = _bytes(text)
            if first is None or not len(first):
                rows.append((len(data), 0, 0, data.tobytes()))
                continue
            first = np.asarray(first, np.int64)
            hit = windows.covered(len(data), first, first + np.asarray(n, np.int64) + length - 1)
            spans = int(hit[0]) + int((hit[1:] & ~hit[:-1]).sum())
            rows.append((len(data), int(hit.sum()), spans, data[~hit].tobytes()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (binary)."""
    # Rows are told apart by id and a hash of the text; rows that agree in both lose the same bytes.
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.hash(text).alias("t"), F.col(text).alias("text"))
    found = repeated(own, length, gram, hot)
    cuts = found.groupBy("doc", "t").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    rows = own.join(cuts, ["doc", "t"], "left").withColumn("x", _cut(length)(F.col("text"), F.col("starts"), F.col("ns")))
    return rows.select("doc_id", "x.n_bytes", "x.n_removed", "x.n_spans", "x.kept")
