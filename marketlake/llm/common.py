"""Small helpers that the operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import stage

#: The white space that parts words: blank, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"
NO_WORD = r"\A[\x20\x09-\x0D]*\z"

_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
#: A blank beside other white space, or at an end: there the runs between blanks cannot be encoded on their own.
DOUBLE_GAP = f"^ | $|{_WHITE} | {_WHITE}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(text: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, GAP), "")


def tasks(spark: SparkSession, least: int = 1) -> int:
    """How many partitions an explicit shuffle gets: the session's setting."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


class Bounded(dict):
    """What a Python worker keeps for keys, in at most ``limit`` bytes.

    There are two generations of half the size: when the young one is full it becomes the old one, whose values come
    back when they are asked for again. Values of keys longer than ``longest`` are not kept, so a text without blanks
    does not stay. With ``make``, a missing value is made.
    """

    def __init__(self, make: Callable | None = None, limit: int = 32 << 20, longest: int = 32):
        self.make, self.half, self.longest, self.held, self.old = make, limit // 2, longest, 0, {}

    def recall(self, key):
        """The value, None if it is not kept."""
        value = self.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(key) <= self.longest:
            self.held += sys.getsizeof(key) + sys.getsizeof(value) + 100  # the entry itself takes about 100 bytes
            if self.held > self.half:
                self.old = dict(self)
                self.clear()
                self.held = 0
            self[key] = value

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value


class Remembered:
    """The ids that a Python worker keeps for strings: both as Arrow data, where a string and its ids take some 40 bytes.

    All is forgotten when ``limit`` bytes are held, but only when asked for the next strings, so places hold until then.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.strings = pa.array([], pa.large_string())
        self.ids, self.edges = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def places(self, strings: pa.Array, make: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The place of each of distinct strings; ``make`` gives the ids of new ones, and where those of each start."""
        if self.strings.nbytes + self.ids.nbytes + self.edges.nbytes > self.limit:
            self.forget()
        strings = strings.cast(pa.large_string())
        out = pc.fill_null(pc.index_in(strings, value_set=self.strings), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = out < 0
        if missing.any():
            new = strings.filter(pa.array(missing))
            ids, starts = make(new.to_numpy(zero_copy_only=False).tolist())
            out[missing] = np.arange(len(self.strings), len(self.strings) + len(new))
            self.strings = pa.concat_arrays([self.strings, new])
            self.edges = np.concatenate([self.edges[:-1], len(self.ids) + starts, [len(self.ids) + len(ids)]])
            self.ids = np.concatenate([self.ids, ids])
        return out

    def take(self, places: np.ndarray) -> pa.LargeBinaryArray:
        """The ids at each place as bytes; those of neighbours stand behind one another."""
        return binaries(self.ids, 4 * self.edges).take(pa.array(places))


def binaries(data: np.ndarray | pa.Buffer, edges: np.ndarray) -> pa.LargeBinaryArray:
    """The parts of ``data`` between ``edges`` (in bytes), without a copy."""
    buffers = [None, pa.py_buffer(edges.astype(np.int64, copy=False)), data if isinstance(data, pa.Buffer) else pa.py_buffer(data)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, buffers)


def regrouped(parts: pa.LargeBinaryArray, edges: np.ndarray) -> pa.LargeBinaryArray:
    """Neighbouring ``parts``, from one edge to the next, as one."""
    return binaries(parts.buffers()[2] or pa.py_buffer(b""), offsets(parts)[edges])


def offsets(parts: pa.Array) -> np.ndarray:
    """Where each of ``parts`` (with 64-bit offsets) starts in the data, and the end of the last."""
    return np.frombuffer(parts.buffers()[1], np.int64, len(parts) + 1, 8 * parts.offset)


class Runs:
    """Texts cut at blanks: the distinct ``runs`` that follow a blank, as Arrow data, and the ``heads``, one for each text.

    A head is what stands before the first blank, or all of a text in which blanks stand beside other white space.
    ``whole`` puts the texts together again from what was made of the heads and then of the runs.
    """

    def __init__(self, texts: pa.Array):
        double = pc.match_substring_regex(texts, DOUBLE_GAP)
        split = pc.split_pattern(pc.if_else(double, "", texts), " ")
        parts, self.edges = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
        self.heads = pc.if_else(double, texts, parts.take(pa.array(self.edges[:-1])))
        later = np.ones(len(parts), bool)
        later[self.edges[:-1]] = False
        numbered = parts.filter(pa.array(later)).dictionary_encode()
        self.runs = numbered.dictionary
        self.order = np.zeros(len(parts), np.int64)
        self.order[later] = numbered.indices.to_numpy() + len(texts)
        self.order[self.edges[:-1]] = np.arange(len(texts))

    def joined(self, some: int) -> Iterator[tuple[int, str]]:
        """The runs with a blank before each, ``some`` in a text, and the number of them in it."""
        blank, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        after = pc.binary_join_element_wise(blank, self.runs.cast(pa.large_string()), none)
        edges, data = offsets(after), memoryview(after.buffers()[2] or b"")
        for low in range(0, len(after), some):
            high = min(low + some, len(after))
            yield high - low, str(data[edges[low] : edges[high]], "utf-8")

    def whole(self, made: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        return regrouped(made.take(pa.array(self.order)), self.edges)


def slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Where to cut ``texts`` into slices of some ``size`` bytes; a longer text stands alone or ends a slice."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    return ((low, high) for low, high in zip(edges, edges[1:], strict=False) if high > low)


def sum_arrays(parts: DataFrame, kind: str = "f8", fan: int = 16) -> np.ndarray:
    """The sum of the arrays that the rows of ``parts`` (data: bytes of numbers) hold; all are of one length.

    They are added up in rounds of ``fan`` in tasks, so the driver gets ``fan`` arrays at most, however many rows there are.
    """

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"data": [sum(np.frombuffer(x, kind) for x in frame["data"]).tobytes()]})

    parts = stage(parts.select("data"), "parts")
    while (n := parts.count()) > fan:
        keyed = parts.withColumn("k", F.pmod(F.xxhash64("data", F.monotonically_increasing_id()), F.lit(-(-n // fan))))
        parts = stage(keyed.groupBy("k").applyInPandas(lambda f: add(f), "data binary"), "parts")
    return sum((np.frombuffer(r["data"], kind) for r in parts.collect()), np.zeros((), kind))
