"""Boosted regression trees from histograms: leaf-wise growth, a penalty on leaves, features drawn for each tree.

Features are cut into at most 255 bins once. In a pass over the rows each task adds up number and gradient of its rows by
node, feature and bin; these sums are shuffled by (node, feature), added, and give the best cut of that feature. The
driver sees one row per node and feature, so what it and a task hold depends on the number of leaves, features and bins,
not on the number of rows.

The leaf with the largest gain is cut first until ``num_leaves`` are there. A cut needs the sums of the node, so a pass
works on all nodes that best-first order, as far as gains are known, would have made; then the order is played again.
A tree takes about as many passes as it has levels, and is the same as if leaves were cut one by one.

Scores are written with the rows every REFRESH trees; in between a task adds the trees that are new.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import release, stage

BINS = 256
REFRESH = 25


@dataclass
class Tree:
    """Nodes by number: feature -1 for a leaf; rows at or below the bin (and its upper bound) go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def add(self) -> int:
        for column, x in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.right, 0), (self.value, 0.0)):
            column.append(x)
        return len(self.feature) - 1

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of binned features."""
        feature, cut, left, right = (np.array(x) for x in (self.feature, self.bin, self.left, self.right))
        at = np.zeros(len(bins), np.int64)
        rows = np.flatnonzero(feature[at] >= 0)
        while len(rows):
            here = at[rows]
            down = bins[rows, feature[here]] <= cut[here]
            at[rows] = np.where(down, left[here], right[here])
            rows = rows[feature[at[rows]] >= 0]
        return at

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(bins)]


def _binned(values: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    """Bin 0 for a missing value, else 1 and the number of bounds below the value."""
    out = np.empty(values.shape, np.uint8)
    for f, upper in enumerate(bounds):
        column = values[:, f]
        out[:, f] = np.where(np.isnan(column), 0, 1 + np.searchsorted(upper, column, "left"))
    return out


def bin_bounds(df: DataFrame, features: list[str], bins: int = BINS - 2) -> list[np.ndarray]:
    """Upper bounds of the bins of each feature: all values but the last where they are few, else quantiles."""
    value = lambda c: F.col(f"`{c}`").cast("double")
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), value(c).alias("v")) for i, c in enumerate(features)])).alias("p")
    distinct = df.select(pairs).select("p.f", "p.v").where(F.col("v").isNotNull() & ~F.isnan("v")).distinct()
    counts = distinct.groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    few = stage(distinct, "values").join(counts.where(F.col("n") <= bins), "f").groupBy("f").agg(F.array_sort(F.collect_list("v")).alias("v"))
    bounds = {r.f: np.array(r.v[:-1]) for r in few.collect()}
    many = [i for i in range(len(features)) if i not in bounds]
    if many:
        shares = [(k + 1) / (bins + 1) for k in range(bins)]
        clean = lambda c: F.when(~F.isnan(value(c)), value(c))
        row = df.agg(*[F.percentile_approx(clean(features[i]), shares, 20 * bins).alias(f"q{i}") for i in many]).first()
        bounds |= {i: np.unique(np.array(row[f"q{i}"] or [], float)) for i in many}
    return [bounds[i] for i in range(len(features))]


class BoostedModel:
    """Trees over raw features; null and NaN count as lower than any number."""

    def __init__(self, features: list[str], bounds: list[np.ndarray], base: float, trees: list[Tree], target: str = ""):
        self.features, self.bounds, self.base, self.trees, self.target = features, bounds, base, trees, target

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``."""
        shared = df.sparkSession.sparkContext.broadcast((self.bounds, self.base, self.trees))

        @F.pandas_udf("double")
        def predict(columns: pd.DataFrame) -> pd.Series:
            bounds, base, trees = shared.value
            bins = _binned(columns.to_numpy(float), bounds)
            return pd.Series(sum((t.scores(bins) for t in trees), np.full(len(bins), base)))

        return df.withColumn("prediction", predict(F.struct(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(self.features)])))

    @property
    def splits(self) -> list[int]:
        """How often each feature is cut."""
        used = [f for t in self.trees for f in t.feature if f >= 0]
        return np.bincount(used, minlength=len(self.features)).tolist() if used else [0] * len(self.features)

    def save(self, spark: SparkSession, path: str) -> None:
        lines = [json.dumps({"features": self.features, "bounds": [b.tolist() for b in self.bounds], "base": self.base, "target": self.target})]
        lines += [json.dumps(asdict(t)) for t in self.trees]
        spark.createDataFrame(list(enumerate(lines)), "i int, line string").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        head, *trees = (json.loads(r.line) for r in spark.read.parquet(path).orderBy("i").collect())
        return cls(head["features"], [np.array(b) for b in head["bounds"]], head["base"], [Tree(**t) for t in trees], head["target"])


def _rows(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    bins = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, width)
    return (batch.column(0).to_numpy(), bins, *(batch.column(i).to_numpy().copy() for i in (2, 3)))


def _scored(width: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, bins, _, score = _rows(batch, width)
            for tree in shared.value:
                score += tree.scores(bins)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score)], names=["id", "bins", "y", "score"])

    return run


def _drawn(ids: np.ndarray, number: int, share: float) -> np.ndarray:
    """Which rows a tree sees: a hash of row and tree, so a task that runs again draws the same."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(number) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return (x ^ x >> np.uint64(31)) < np.uint64(min(share, 1 - 2.0**-53) * 2.0**64)


_SUMS = "node int, feature int, n binary, g binary"


def _histograms(width: int, shared):
    """Rows to (node, feature, n, g): numbers and gradients by bin, for the wanted nodes and the tree's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, tree, wanted, features, number, share = shared.value
        slot = np.full(len(tree.feature), -1)
        slot[wanted] = np.arange(len(wanted))
        count = np.zeros((len(features), len(wanted) * BINS), np.int64)
        total = np.zeros(count.shape)
        for batch in batches:
            ids, bins, y, score = _rows(batch, width)
            at = slot[tree.nodes(bins)]
            here = at >= 0 if share >= 1 else (at >= 0) & _drawn(ids, number, share)
            at, bins, gradient = at[here], bins[here], score[here] - y[here]
            for t in new:
                gradient += t.scores(bins)
            for k, f in enumerate(features):
                key = at * BINS + bins[:, f]
                count[k] += np.bincount(key, minlength=count.shape[1])
                total[k] += np.bincount(key, gradient, count.shape[1])
        count, total = (x.reshape(len(features), len(wanted), BINS) for x in (count, total))
        seen = np.argwhere(count.any(axis=2))
        columns = [[wanted[s] for _, s in seen], [features[k] for k, _ in seen], [count[k, s].tobytes() for k, s in seen], [total[k, s].tobytes() for k, s in seen]]
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["node", "feature", "n", "g"])

    return run


def best_cut(n: np.ndarray, g: np.ndarray, penalty: float, least: int) -> tuple[float, int, int, float]:
    """(gain, bin, rows on the left, gradients on the left) of the best cut; a gain of 0 means there is none."""
    left, gl = np.cumsum(n)[:-1], np.cumsum(g)[:-1]
    rows, total = int(n.sum()), float(g.sum())
    good = (left >= max(least, 1)) & (rows - left >= max(least, 1))
    if not good.any():
        return 0.0, 0, 0, 0.0
    at = np.flatnonzero(good)
    gain = gl[at] ** 2 / (left[at] + penalty) + (total - gl[at]) ** 2 / (rows - left[at] + penalty) - total**2 / (rows + penalty)
    k = int(gain.argmax())
    return max(float(gain[k]), 0.0), int(at[k]), int(left[at[k]]), float(gl[at[k]])


_CUTS = "node int, feature int, rows long, total double, gain double, bin int, left long, below double"


def _cuts(penalty: float, least: int):
    """Sums in order of (node, feature) to the best cut of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, g, out = None, None, None, []

        def close() -> None:
            if at is not None:
                gain, cut, left, below = best_cut(n, g, penalty, least)
                out.append((*at, int(n.sum()), float(g.sum()), gain, cut, left, below))

        for batch in batches:
            for node, feature, more_n, more_g in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (node, feature) != at:
                    close()
                    at, n, g = (node, feature), np.zeros(BINS, np.int64), np.zeros(BINS)
                n, g = n + np.frombuffer(more_n, np.int64), g + np.frombuffer(more_g)
        close()
        types = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int64(), pa.float64()]
        names = ["node", "feature", "rows", "total", "gain", "bin", "left", "below"]
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=names)

    return run


class Boosting:
    """A spec with n_estimators, learning_rate, num_leaves, max_depth (-1: any), min_child_samples, reg_lambda,
    colsample_bytree, and subsample with subsample_freq: as in the common library, rows are drawn only where the latter
    is above 0, anew for every so many trees. Trees fit the gradient of the squared error, from the mean of the target."""

    def __init__(self, target: str, spec: dict, seed: int = 42):
        known = {"n_estimators", "learning_rate", "num_leaves", "max_depth", "min_child_samples", "reg_lambda", "colsample_bytree", "subsample", "subsample_freq", "objective", "metric"}
        if unknown := set(spec) - known:
            raise ValueError(f"not in a spec of boosted trees: {sorted(unknown)}")
        if spec.get("objective", "regression") not in ("regression", "regression_l2", "l2", "mse"):
            raise ValueError("only the squared error is fitted")
        self.target, self.seed = target, seed
        self.rounds, self.rate = int(spec.get("n_estimators", 100)), float(spec.get("learning_rate", 0.1))
        depth = int(spec.get("max_depth") or -1)
        self.depth = depth if depth > 0 else None
        self.leaves = int(spec.get("num_leaves", 31))
        self.least, self.penalty = int(spec.get("min_child_samples", 20)), float(spec.get("reg_lambda", 0.0))
        self.columns = float(spec.get("colsample_bytree", 1.0))
        self.every = int(spec.get("subsample_freq", 0))
        self.share = float(spec.get("subsample", 1.0)) if self.every > 0 else 1.0

    def fit(self, df: DataFrame, features: list[str]) -> BoostedModel:
        """Rows without a target are not used; an empty table gives a model that predicts 0."""
        spark, width = df.sparkSession, len(features)
        y = F.col(f"`{self.target}`").cast("double")
        used = stage(df.where(y.isNotNull() & ~F.isnan(y)).select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)], y.alias("y")), "training")
        names = [f"f{i}" for i in range(width)]
        bounds = bin_bounds(used, names)
        base = float(used.agg(F.avg("y")).first()[0] or 0.0)
        cut = spark.sparkContext.broadcast(bounds)

        @F.pandas_udf("binary")
        def binned(columns: pd.DataFrame) -> pd.Series:
            return pd.Series([row.tobytes() for row in _binned(columns.to_numpy(float), cut.value)], dtype=object)

        rows = stage(used.select(F.monotonically_increasing_id().alias("id"), binned(F.struct(*names)).alias("bins"), "y", F.lit(base).alias("score")), "binned", done=[used])
        model, new = BoostedModel(features, bounds, base, [], self.target), []
        for number in range(self.rounds):
            if len(new) == REFRESH:
                scored = _scored(width, spark.sparkContext.broadcast(new))
                rows, new = stage(rows.mapInArrow(scored, "id long, bins binary, y double, score double"), "scores", done=[rows]), []
            tree = self._grow(rows, width, new, number)
            if len(tree.feature) == 1 and self.columns >= 1 and self.share >= 1:
                break  # no cut is left, and the next tree would find none either
            model.trees.append(tree)
            new.append(tree)
        release(rows)
        return model

    def _grow(self, rows: DataFrame, width: int, new: list[Tree], number: int) -> Tree:
        spark = rows.sparkSession
        n_features = max(1, int(self.columns * width)) if self.columns < 1 else width
        drawn = np.random.default_rng([self.seed, number]).permutation(width)[:n_features]
        features = sorted(int(f) for f in drawn)
        tree, depth, best, sums, wanted = Tree(), {0: 0}, {}, {}, [0]
        bag = number // self.every if self.every else 0
        while wanted:
            shared = spark.sparkContext.broadcast((new, tree, wanted, features, bag, self.share))
            parts = rows.mapInArrow(_histograms(width, shared), _SUMS).repartition("node", "feature").sortWithinPartitions("node", "feature")
            for r in sorted(parts.mapInArrow(_cuts(self.penalty, self.least), _CUTS).collect(), key=lambda r: (r.node, r.feature)):
                sums[r.node] = (r.rows, r.total)
                if r.gain > best.get(r.node, (0.0,))[0]:
                    best[r.node] = (r.gain, r.feature, r.bin, r.left, r.below)
            shared.unpersist()
            wanted, cut = self._play(tree, depth, best, sums)
        return self._cropped(tree, cut, sums)

    def _play(self, tree: Tree, depth: dict, best: dict, sums: dict) -> tuple[list[int], set[int]]:
        """Cut the best leaves first. Returns the nodes whose sums are still needed, and the nodes that are cut."""
        heap, cut, wanted = [], set(), []

        def offer(node: int) -> None:
            if node in best and (self.depth is None or depth[node] < self.depth):
                heappush(heap, (-best[node][0], node))

        offer(0)
        while heap and len(cut) + 1 < self.leaves:
            _, node = heappop(heap)
            cut.add(node)
            if tree.feature[node] < 0:
                _, feature, at, n, g = best[node]
                tree.feature[node], tree.bin[node] = feature, at
                for side, own in (("left", (n, g)), ("right", (sums[node][0] - n, sums[node][1] - g))):
                    child = tree.add()
                    getattr(tree, side)[node] = child
                    depth[child] = depth[node] + 1
                    if own[0] < 2 * max(self.least, 1) or (self.depth is not None and depth[child] >= self.depth) or self.leaves == 2:
                        sums[child] = own  # it cannot be cut
            for child in (tree.left[node], tree.right[node]):
                if child in sums:
                    offer(child)
                else:
                    wanted.append(child)
        return wanted, cut

    def _cropped(self, tree: Tree, cut: set[int], sums: dict) -> Tree:
        """The tree of the nodes that are cut and their leaves, with leaf values."""
        out, todo = Tree(), [(0, 0)]
        while todo:
            node, to = todo.pop()
            if node in cut:
                out.feature[to], out.bin[to] = tree.feature[node], tree.bin[node]
                out.left[to], out.right[to] = out.add(), out.add()
                todo += [(tree.left[node], out.left[to]), (tree.right[node], out.right[to])]
            elif node in sums:
                n, g = sums[node]
                out.value[to] = -self.rate * g / (n + self.penalty) if n else 0.0
        return out
