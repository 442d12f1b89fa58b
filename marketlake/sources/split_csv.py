"""Large CSV files with line breaks inside quotes, read by many tasks.

Spark cuts a plain file into byte ranges and reads the lines of each; what it cannot know is whether a range starts
inside a quoted value. Quotes tell: a doubled quote keeps the parity, so a line starts inside a value if an odd number
of quotes stands before it. One scan counts the quotes of every range, a running sum over the ranges of a file gives
the parity at each start, and the second scan closes records where the parity is even. A record that lies across ranges
arrives in pieces, which alone are shuffled and joined again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OPTIONS = {"escape": '"', "multiLine": "true"}
_PIECES = "file string, start long, record string, is_first boolean, is_piece boolean, opens boolean"


def _lines(spark: SparkSession, path) -> DataFrame:
    """Lines of the files with their file and byte range, in the order of the file. A carriage return stays."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("start"), "value"
    )


def open_ranges(spark: SparkSession, path) -> DataFrame:
    """(file, start) of the byte ranges whose first line continues a quoted value."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = _lines(spark, path).groupBy("file", "start").agg(F.sum(quotes).alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select("file", "start", (F.sum("n").over(before) % 2).alias("odd")).where("odd = 1").select("file", "start")


def _cut(opened: dict[str, set[int]], pieces_only: bool):
    """Lines of byte ranges to records: whole ones, and the pieces at the edges of a range."""

    def rows(file: str, start: int, records: pa.Array, first: int | None, piece: bool, opens: bool) -> pa.RecordBatch:
        n = len(records)
        is_first = np.zeros(n, bool)
        if first is not None:
            is_first[first] = True
        columns = [pa.array([file] * n, pa.string()), pa.array(np.full(n, start)), records, pa.array(is_first),
                   pa.array(np.full(n, piece)), pa.array(np.full(n, opens))]
        return pa.RecordBatch.from_arrays(columns, names=["file", "start", "record", "is_first", "is_piece", "opens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, start, odd, head, seen = None, 0, 0, False, False
        held: list[str] = []  # lines of the record that is open

        def last_piece() -> Iterator[pa.RecordBatch]:
            # A record open at the end goes on in the next range; if it also came from the one before, it opens none.
            if held:
                yield rows(file, start, pa.array(["\n".join(held)]), 0 if start == 0 and not seen else None, True, not head)

        for batch in batches:
            for low, high in _runs(batch):
                name, at = batch.column(0)[low].as_py(), batch.column(1)[low].as_py()
                if (name, at) != (file, start):
                    yield from last_piece()
                    file, start, held, seen = name, at, [], False
                    head = at in opened.get(name, ())
                    odd = int(head)
                values = batch.column(2).slice(low, high - low)
                parity = (odd + np.cumsum(pc.count_substring(values, '"').to_numpy(zero_copy_only=False))) % 2
                odd = int(parity[-1])
                ends = np.flatnonzero(parity == 0)
                if not len(ends):
                    held += values.to_pylist()
                    continue
                done = 0
                if held or head:
                    done = int(ends[0]) + 1
                    record = pa.array(["\n".join([*held, *values.slice(0, done).to_pylist()])])
                    if head or not pieces_only:
                        yield rows(file, start, record, 0 if start == 0 and not seen and not head else None, head, False)
                    held, head, seen, ends = [], False, True, ends[1:]
                if len(ends) and not pieces_only:
                    offsets = pa.array(np.concatenate([[done], ends + 1]).astype(np.int32))
                    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, values), "\n")
                    yield rows(file, start, joined, 0 if start == 0 and not seen else None, False, False)
                if len(ends):
                    seen, done = True, int(ends[-1]) + 1
                held = values.slice(done).to_pylist()
        yield from last_piece()

    def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        """Rows of one range; small files share a task."""
        if not batch.num_rows:
            return
        starts = batch.column(1).to_numpy()
        files = batch.column(0).dictionary_encode().indices.to_numpy()
        edges = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1
        yield from zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True)

    return run


def _across(pieces: DataFrame) -> DataFrame:
    """The records that lie across ranges: the piece that opens one and all up to the next opening."""
    # At most two pieces a range. The piece that closes a record comes before the one that opens the next.
    in_order = Window.partitionBy("file").orderBy("start", "opens").rowsBetween(Window.unboundedPreceding, 0)
    numbered = pieces.withColumn("no", F.sum(F.col("opens").cast("int")).over(in_order))
    parts = F.array_sort(F.collect_list(F.struct("start", "opens", "record")))
    whole = numbered.groupBy("file", "no").agg(parts.alias("parts"), F.max("is_first").alias("is_first"))
    return whole.select("file", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"), "is_first")


def read_records(spark: SparkSession, path) -> DataFrame:
    """(file, record, is_first): the records of CSV files as text, those of a large plain file by many tasks.

    Only the starts of ranges inside a quoted value come to the driver, at most one for each range
    (``spark.sql.files.maxPartitionBytes``). A record must fit into memory; without a closing quote it is the rest of
    the file. Blank lines are no records.
    """
    opened: dict[str, set[int]] = {}
    for r in open_ranges(spark, path).toLocalIterator():
        opened.setdefault(r["file"], set()).add(r["start"])
    found = _lines(spark, path).mapInArrow(_cut(opened, False), _PIECES)
    # A record still open where its file ends is a piece too, so pieces can exist where no range starts inside a value.
    records = found.where("not is_piece").select("file", "record", "is_first")
    pieces = _lines(spark, path).mapInArrow(_cut(opened, True), _PIECES).where("is_piece")
    records = records.unionByName(_across(pieces))
    return records.withColumn("record", F.regexp_replace("record", r"\r$", "")).where(F.col("record").rlike(r"\S"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def read_csv_split(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """Headered CSV whose values may hold line breaks, with large plain files cut into ranges.

    The rows equal those of ``read_csv`` with ``multi_line``, in no order. Without a schema every column is text, named
    by the header. A file whose header has other names than the first one is an error. Gzip cannot be cut: such files
    are one range each.
    """
    if schema is None:
        names = spark.read.option("header", True).options(**_OPTIONS).option("inferSchema", False).csv(path).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema.fields) + 1)])
    header = F.from_csv("record", _ddl(texts), _OPTIONS)
    same = F.lit(True)
    for i, f in enumerate(schema.fields):
        same = same & header[f"c{i}"].eqNullSafe(F.lit(f.name))
    same = same & header[f"c{len(schema.fields)}"].isNull()
    checked = F.when(same, F.lit(False)).otherwise(F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("boolean"))
    rows = read_records(spark, path).where(F.when(F.col("is_first"), checked).otherwise(True))
    return rows.select(F.from_csv("record", _ddl(schema), _OPTIONS).alias("r")).select("r.*")
