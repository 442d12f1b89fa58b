"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors of one label and length are compared. Unit vectors are turned into the basis of their second moments (principal
components, most energy first), put in order of cells of their leading coordinates and cut into tiles. Two tiles are
compared only if the boxes of their leading coordinates are near enough for a pair at the threshold: unit vectors with
a cosine of t are sqrt(2 - 2 t) apart. Within two tiles the products of the leading coordinates are summed up first; the
products of the rest are bounded by the norms of both suffixes, and a pair is given up as soon as its cosine cannot
reach the threshold. What is left and too close to the threshold to trust is judged on the vectors as given. So all
pairs at or above the threshold are found.

Equal vectors are compared once and count as often as they occur. A pair of tiles gives the number of links of each
vector and the edges of a spanning forest, never the pairs; one pair of tiles is the unit of work, so a large label is
dealt over many tasks.

Defined results: a vector that is null or empty, has a null or non-finite component or no length, or has no label, is
linked with nothing; neither are vectors of different length. Rows with an equal vec_id are different vectors. A null
vec_id is linked like any other, but is never the smallest of its group: its group may have no id, then it is null, and
``kept`` is false. An empty table gives no rows. Only the three named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import sum_arrays, tasks
from marketlake.llm.components import components
from marketlake.session import stage

THRESHOLD = 0.98
TILE = 512
#: Leading coordinates that order the tiles, that a tile's box has, and that are summed up step by step.
CELLS, BOX, STEPS = 4, 8, (8, 16, 32, 64, 128, 256, 512)
#: Cells are at least as wide, so a tile lies in 18 x 18 of them at most, whatever the threshold.
CELL = 0.125
#: A cosine that is as close to the threshold is taken again from the vectors as given.
CLOSE = 1e-9


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow, no underflow of squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def basis(classes: DataFrame, size: int) -> np.ndarray:
    """The principal directions of the unit vectors of this length, as columns, most energy first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                unit = _unit(_matrix(batch.column(0), size))
                total += unit.T @ unit
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["data"])

    parts = classes.where(F.size("vec") == size).select("vec").mapInArrow(moments, "data binary")
    energy, directions = np.linalg.eigh(sum_arrays(parts).reshape(size, size))
    return directions[:, np.argsort(-energy)]


def _cells(leading: np.ndarray, width: float) -> np.ndarray:
    """A key for the cell of each row, near for near cells: the bits of the cell's numbers take turns."""
    cell = np.floor((leading + 1) / width).astype(np.int64)
    key = np.zeros(len(cell), np.int64)
    for bit in range(15, -1, -1):
        for k in range(cell.shape[1]):
            key = key << 1 | cell[:, k] >> bit & 1
    return key


def _turn(vectors: np.ndarray, turn: np.ndarray | None) -> np.ndarray:
    unit = _unit(vectors)
    return unit if turn is None or len(turn) != unit.shape[1] else unit @ turn


def _keyed(turn, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("vec").offsets.to_numpy())
            keys = np.zeros(batch.num_rows, np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                turned = _turn(_matrix(batch.column("vec").take(pa.array(rows)), size), turn.value)
                keys[rows] = _cells(turned[:, :CELLS], width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], names=[*batch.schema.names, "cell"])

    return run


_TILES = "label string, size int, low array<double>, high array<double>, n int, cids binary, weights binary, vectors binary"


def _tiler(turn, rows: int):
    """Rows in order of label, length and cell to tiles of ``rows`` rows at most."""
    names = ["label", "size", "low", "high", "n", "cids", "weights", "vectors"]
    types = [pa.string(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32(), *[pa.binary()] * 3]

    def tile(label: str, size: int, held: list) -> pa.RecordBatch:
        cids, weights, vectors = (np.concatenate(x) for x in zip(*held, strict=True))
        lead = _turn(vectors, turn.value)[:, :BOX]
        row = [label, size, lead.min(axis=0).tolist(), lead.max(axis=0).tolist(), len(cids), cids.tobytes(), weights.tobytes(), vectors.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, n = None, [], 0
        for batch in batches:
            labels, vec = batch.column("label").to_pylist(), batch.column("vec")
            sizes = np.diff(vec.offsets.to_numpy()).tolist()
            cids, weights = batch.column("cid").to_numpy(), batch.column("n").to_numpy()
            i = 0
            while i < len(labels):
                key = labels[i], sizes[i]
                if key != at or n == rows:
                    if n:
                        yield tile(*at, held)
                    at, held, n = key, [], 0
                j = i
                while j < len(labels) and j - i < rows - n and (labels[j], sizes[j]) == key:
                    j += 1
                held.append((cids[i:j], weights[i:j], _matrix(vec.slice(i, j - i), key[1])))
                n += j - i
                i = j
        if n:
            yield tile(*at, held)

    return run


def near_pairs(a: np.ndarray, b: np.ndarray, turn: np.ndarray | None, threshold: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` have a cosine at or above the threshold, as a matrix of booleans."""
    x, y = _turn(a, turn), _turn(b, turn)
    size, least = x.shape[1], threshold - CLOSE
    steps = [*[s for s in STEPS if s < size], size]
    total = x[:, : steps[0]] @ y[:, : steps[0]].T
    rows = cols = None
    for done, to in zip(steps, [*steps[1:], size], strict=True):
        if rows is None:
            rest = np.outer(np.linalg.norm(x[:, done:], axis=1), np.linalg.norm(y[:, done:], axis=1))
            alive = total + rest >= least
            if 4 * np.count_nonzero(alive) > alive.size:  # most pairs go on: the next step for all of them
                total = total + x[:, done:to] @ y[:, done:to].T
                continue
            rows, cols = np.nonzero(alive)
            total = total[rows, cols]
        else:
            rest = np.linalg.norm(x[:, done:], axis=1)[rows] * np.linalg.norm(y[:, done:], axis=1)[cols]
            alive = total + rest >= least
            rows, cols, total = rows[alive], cols[alive], total[alive]
        if not len(rows):
            break
        total = total + np.einsum("ij,ij->i", x[rows, done:to], y[cols, done:to])
    if rows is None:
        rows, cols = np.nonzero(total >= least)
        total = total[rows, cols]
    near = np.abs(total - threshold) <= CLOSE
    if near.any():
        p, q = a[rows[near]], b[cols[near]]
        total[near] = np.einsum("ij,ij->i", p, q) / (np.linalg.norm(p, axis=1) * np.linalg.norm(q, axis=1))
    out = np.zeros((len(x), len(y)), bool)
    good = total >= threshold
    out[rows[good], cols[good]] = True
    return out


def forest(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges from one node of each component of the links to its others; each row is looked at once."""
    edges, open_rows = [], near.any(axis=1)
    reached = np.zeros(near.shape[1], bool)
    for root in np.flatnonzero(open_rows):
        if not open_rows[root]:
            continue
        front = np.array([root])
        open_rows[root] = False
        while len(front):
            cols = near[front].any(axis=0) & ~reached
            reached |= cols
            edges += [(int(a[root]), int(c)) for c in b[cols]]
            front = np.flatnonzero(near[:, cols].any(axis=1) & open_rows) if cols.any() else front[:0]
            open_rows[front] = False
            edges += [(int(a[root]), int(c)) for c in a[front]]
    return [e for e in edges if e[0] != e[1]]


def _compare(turn, threshold: float):
    """Rows of (one, part, other, ...): in each (one, part) the first row is the tile itself, compared with all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = own = None
        for batch in batches:
            for i in range(batch.num_rows):
                one, part, other, same, size = (batch.column(k)[i].as_py() for k in range(5))
                cids, weights = (np.frombuffer(batch.column(k)[i].as_buffer(), np.int64) for k in (5, 6))
                vectors = np.frombuffer(batch.column(7)[i].as_buffer(), np.float64).reshape(-1, size)
                if (one, part) != at:
                    at, own = (one, part), (cids.copy(), weights.copy(), vectors.copy())
                    if not same:
                        continue
                near = near_pairs(own[2], vectors, turn.value, threshold)
                if one == other:
                    np.fill_diagonal(near, False)
                counts = [(own[0], near @ weights)]
                if one != other:
                    counts.append((cids, near.T @ own[1]))
                ids, links = (np.concatenate(x) for x in zip(*counts, strict=True))
                edges = forest(near, own[0], cids)
                a = np.concatenate([ids[links > 0], np.array([e[0] for e in edges], np.int64)])
                b = pa.array([None] * int((links > 0).sum()) + [e[1] for e in edges], pa.int64())
                n = np.concatenate([links[links > 0], np.zeros(len(edges), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, pa.array(n, pa.int64())], names=["a", "b", "links"])

    return run


def _tile_pairs(tiles: DataFrame, width: float) -> DataFrame:
    """(one, other, same) for tiles whose boxes come within ``width``; tiles meet by cells of two coordinates.

    A pair belongs to either of its tiles by turns, so no tile is compared with all others of a label by itself.
    """
    cell = max(width, CELL)
    span = lambda c, more: F.sequence(F.floor((c[0] - more) / cell), F.floor((c[1] + more) / cell))

    def met(more: float) -> DataFrame:
        df = tiles.select("tile", "label", "size", "low", "high")
        edges = [(F.get("low", i), F.get("high", i)) for i in range(2)]
        df = df.withColumn("c", F.explode(span(edges[0], more)))
        second = F.coalesce(span(edges[1], more), F.array(F.lit(0).cast("long")))  # vectors of length one have no second
        return df.withColumn("d", F.explode(second))

    a, b = (met(m).alias(n) for n, m in (("a", 0.0), ("b", width)))
    gap = F.zip_with(F.arrays_zip(F.col("a.low"), F.col("a.high")), F.arrays_zip(F.col("b.low"), F.col("b.high")),
                     lambda x, y: F.greatest(F.lit(0.0), y["low"] - x["high"], x["low"] - y["high"]))
    apart = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)
    keys = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("label", "size", "c", "d")]
    pairs = a.join(b, keys).where(F.col("a.tile") <= F.col("b.tile")).where(apart <= width * width + CLOSE)
    pairs = pairs.select(F.col("a.tile").alias("x"), F.col("b.tile").alias("y")).distinct()
    even = (F.col("x") + F.col("y")) % 2 == 0
    return pairs.select(F.when(even, F.col("x")).otherwise(F.col("y")).alias("one"), F.when(even, F.col("y")).otherwise(F.col("x")).alias("other"))


def _links(classes: DataFrame, threshold: float, rows: int, together: int = 32) -> DataFrame:
    """(a, b, links): numbers of links of a class, or edges (a, b) where b is given."""
    spark = classes.sparkSession
    common = classes.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], "a long, b long, links long")
    turn = spark.sparkContext.broadcast(basis(classes, common["size"]))
    width = math.sqrt(2 - 2 * threshold)
    keyed = classes.mapInArrow(_keyed(turn, max(width, CELL)), "label string, vec array<double>, n long, cid long, cell long")
    order = ["label", F.size("vec"), "cell", "cid"]
    ranged = stage(keyed, "cells").repartitionByRange(tasks(spark), *order).sortWithinPartitions(*order)
    tiles = ranged.mapInArrow(_tiler(turn, rows), _TILES).withColumn("tile", F.monotonically_increasing_id())
    tiles = stage(tiles, "tiles")
    pairs = stage(_tile_pairs(tiles, width), "tile-pairs")
    # A unit of work is a tile with some of its partners; the tile itself comes first, once.
    work = pairs.withColumn("part", F.pmod(F.xxhash64("other"), F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)).over(Window.partitionBy("one")) / together))))
    units = work.groupBy("one", "part").agg(F.max(F.col("one") == F.col("other")).alias("same")).select("one", "part", F.col("one").alias("other"), "same")
    wanted = work.where("one != other").select("one", "part", "other", F.lit(True).alias("same")).unionByName(units)
    rows_ = wanted.join(tiles.select(F.col("tile").alias("other"), "size", "cids", "weights", "vectors"), "other")
    rows_ = rows_.select("one", "part", "other", "same", "size", "cids", "weights", "vectors")
    dealt = rows_.repartition(tasks(spark), "one", "part").sortWithinPartitions("one", "part", (F.col("one") != F.col("other")), "other")
    return stage(dealt.mapInArrow(_compare(turn, threshold), "a long, b long, links long"), "links")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, rows: int = TILE) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    # Minus zero becomes zero, so equal vectors have equal hashes.
    vec = F.transform(F.col(f"`{vector}`").cast("array<double>"), lambda x: x + F.lit(0.0))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    used = F.col(f"`{label}`").isNotNull() & finite & F.exists(vec, lambda x: x != 0)
    own = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.when(used, F.col(f"`{label}`").cast("string")).alias("label"), F.when(used, vec).alias("vec")
    )
    given = stage(own.select("*", F.xxhash64(F.lit(1), "vec").alias("h"), F.xxhash64(F.lit(2), "vec").alias("g")), "vectors")
    equal = given.where("label is not null").groupBy("label", "h", "g").agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = stage(equal.withColumn("cid", F.monotonically_increasing_id()), "classes")
    links = _links(classes.select("label", "vec", "n", "cid"), threshold, rows)
    counts = links.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    roots = components(links.where("b is not null").select("a", "b")).withColumnRenamed("node", "cid")
    found = classes.select("label", "h", "g", "n", "least", "cid").join(counts, "cid", "left").join(roots, "cid", "left")
    found = stage(found.withColumn("root", F.coalesce("root", "cid")).withColumn("links", F.coalesce("links", F.lit(0)) + F.col("n") - 1), "classes")
    least = found.groupBy("root").agg(F.min("least").alias("component"))
    found = found.join(least, "root").select("label", "h", "g", "links", "component")
    out = given.select("vec_id", "label", "h", "g").join(found, ["label", "h", "g"], "left")
    component = F.when(F.col("label").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    kept = F.coalesce(F.col("vec_id") == component, F.lit(False))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), kept.alias("kept"))
