"""Near-duplicate vectors and whitening against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from marketlake.llm import common, cosine, queries, whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, n string, cid string, x string, data string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "n", "c", "x", "d") for i, v, k in rows], SCHEMA)


def vectors(seed=1, size=12, groups=40):
    """Clusters, copies, scaled copies and everything that cannot be compared."""
    rng, rows = np.random.default_rng(seed), []
    for g in range(groups):
        base = rng.normal(size=size)
        for k in range(int(rng.integers(1, 9))):
            rows.append((len(rows), [float(x) for x in np.float32(base + rng.normal(size=size) * 0.08 * (k % 4))], g % 3))
    hot = [float(x) for x in np.float32(rng.normal(size=size))]
    rows += [(1000 + k, hot, 1) for k in range(150)] + [(2000, [2 * x for x in hot], 1), (2001, hot, 2), (None, hot, 1), (5, hot, 1)]
    rows += [(3000 + k, [float(x) for x in np.float32(np.array(hot) + rng.normal(size=size) * 0.1)], 1) for k in range(60)]
    rows += [(4000, None, 1), (4001, [], 1), (4002, [0.0] * size, 1), (4003, [math.nan] + hot[1:], 1), (4004, [None] + hot[1:], 1), (4005, hot, None), (4006, [math.inf] + hot[1:], 1)]
    rows += [(4007, hot[:5], 1), (4008, hot[:5], 1), (4009, [-0.0] + hot[1:], 0), (4010, [0.0] + hot[1:], 0), (4011, [3.0], 0), (4012, [-1.0], 0), (4013, [1e-30], 0), (None, None, None)]
    random.Random(seed).shuffle(rows)
    return rows


def brute_links(rows, threshold):
    n = len(rows)
    ok = [k is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v, k in rows]
    links, root, groups = [0] * n, list(range(n)), {}
    for i, (_, v, k) in enumerate(rows):
        if ok[i]:
            groups.setdefault((k, len(v)), []).append(i)
    for at in groups.values():
        m = np.array([rows[i][1] for i in at], float)
        m /= np.abs(m).max(axis=1, keepdims=True)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        near = m @ m.T >= threshold - 1e-14
        np.fill_diagonal(near, False)
        for a, b in zip(*np.nonzero(near), strict=True):
            links[at[a]] += 1
            x, y = at[a], at[b]
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
    least = {}
    for i in range(n):
        r = i
        while root[r] != r:
            r = root[r]
        root[i] = r
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return sorted(((rows[i][0], links[i], c := least.get(root[i]), c is not None and c == rows[i][0]) for i in range(n)), key=repr)


@pytest.mark.parametrize("threshold, tile", [(0.98, 512), (0.98, 7), (0.9, 16), (1.0, 16)])
def test_links(spark, threshold, tile):
    rows = [r for r in vectors() if threshold < 1 or r[0] != 2000]  # at 1.0 a scaled copy is a matter of rounding
    out = cosine.near_duplicates(frame(spark, rows), threshold=threshold, rows=tile)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_links(rows, threshold if threshold < 1 else 1 - 1e-12)


def test_no_vectors(spark):
    assert cosine.near_duplicates(frame(spark, [])).count() == 0
    out = cosine.near_duplicates(frame(spark, [(1, None, 1), (2, [1.0], None)])).collect()
    assert sorted(map(tuple, out)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_pairs_given_up_are_none(monkeypatch):
    """Bounds and boxes never lose a pair, whatever the order of dimensions."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(30, 40)) * np.linspace(3, 0.1, 40)
    a = np.concatenate([base, base + rng.normal(size=base.shape) * 0.05])
    unit = a / np.linalg.norm(a, axis=1, keepdims=True)
    _, directions = np.linalg.eigh(unit.T @ unit)
    for turn in (None, directions[:, ::-1]):
        assert (cosine.near_pairs(a, a, turn, 0.98) == (unit @ unit.T >= 0.98)).all()


def test_all_links_of_a_label_meet_in_tiles(spark):
    """Many small tiles of one label: each vector still meets all that are near."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.float32([math.cos(t), math.sin(t), 0.02])], 0) for i, t in enumerate(rng.uniform(0, 2 * math.pi, 600))]
    out = cosine.near_duplicates(frame(spark, rows), rows=8)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute_links(rows, 0.98)


def test_sums_of_arrays(spark):
    arrays = [np.arange(3) * k for k in range(100)]
    df = spark.createDataFrame([(bytearray(np.array(a, "f8").tobytes()),) for a in arrays], "data binary")
    assert common.sum_arrays(df).tolist() == sum(arrays).tolist()


# --- whitening --------------------------------------------------------------------------------------------------


def brute_whitened(rows, k):
    good = [(i, v) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    size = max((len(v) for _, v in good), default=0)
    good = [(i, v) for i, v in good if len(v) == size]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good], dtype=object)
    n, far = len(good), len(good) * x - x.sum(axis=0)
    y = far.astype(float) / n
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(k, int((e > 1e-12 * e[0]).sum()))
    return [i for i, _ in good], n, [int(d) for d in (far * far).sum(axis=1)], y @ q[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def assert_whitened(rows, out, k=32):
    ids, n, deviations, whitened, explained = brute_whitened(rows, k)
    assert len(out) == len(ids) * whitened.shape[1] and {r.n for r in out} <= {n}
    want = sorted(zip(ids, deviations, whitened.tolist(), strict=True), key=lambda r: (repr(r[0]), r[1], r[2]))
    for c in range(whitened.shape[1]):
        got = [r for r in out if r.component == c + 1]
        sign = min((1, -1), key=lambda s: abs(sum(s * r.whitened * w[2][c] for r, w in zip(sorted(got, key=lambda r: (repr(r.vec_id), r.deviation)), want, strict=True)) - n))
        own = sorted((repr(r.vec_id), r.deviation, round(sign * r.whitened, 7) + 0.0) for r in got)
        assert own == pytest.approx([], abs=1) if not own else [o[:2] for o in own] == sorted((repr(i), d) for i, d, _ in want)
        assert np.allclose([o[2] for o in own], [w for *_, w in sorted((repr(i), d, round(v[c], 7) + 0.0) for i, d, v in want)], atol=1e-6)
        assert all(abs(r.explained / explained[c] - 1) < 1e-9 for r in got)
    assert all(r.identity_error < 1e-9 for r in out)


@pytest.mark.parametrize("block", [1, 5, 4096])
def test_whitening(spark, block):
    rng = np.random.default_rng(2)
    turn = rng.normal(size=(6, 6)) * [9, 5, 3, 2, 1, 0.5]
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6) @ turn.T + 3)], None) for i in range(200)]
    rows += [(7, rows[7][1], 1), (900, None, 1), (901, [], 1), (902, [math.nan] * 6, 1), (903, [None] + [1.0] * 5, 1), (904, [1.0] * 5, 1), (None, rows[3][1], 1)]
    assert_whitened(rows, whitening.whiten(frame(spark, rows).repartition(7), block=block).collect())


def test_whitening_of_few_directions(spark):
    """Constant and dependent dimensions, ties of eigenvalues, and tables with nothing to whiten."""
    rows = [(i, [float(i % 5), 2.0 * (i % 5), 1.0, float(i % 3)], 0) for i in range(60)]
    assert_whitened(rows, whitening.whiten(frame(spark, rows).repartition(5)).collect())
    for none in ([], [(1, None, 1)], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1)] * 9):
        assert whitening.whiten(frame(spark, none)).collect() == []
    with pytest.raises(Exception, match="63 bits"):
        whitening.whiten(frame(spark, [(1, [1e30], 1), (2, [0.0], 1)])).collect()


def test_whitening_of_given_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert_whitened(rows, queries.op12_embedding_whitening(spark, SF).collect())


def test_rank_one_updates():
    rng = np.random.default_rng(1)
    for _ in range(300):
        size, scale = int(rng.integers(1, 20)), 10.0 ** rng.integers(-6, 7)
        total, values, directions = np.zeros((size, size)), np.zeros(size), np.eye(size)
        for _ in range(int(rng.integers(1, 60))):
            u = [rng.normal(size=size) * scale, np.eye(size)[rng.integers(size)] * scale, rng.integers(-1, 2, size=size) * 1.0, rng.normal(size=size) * 1e-9][rng.integers(4)]
            total += np.outer(u, u)
            values, directions = whitening.rank_one(values, directions, u)
        assert np.abs((directions * values) @ directions.T - total).max() <= 1e-12 * max(np.abs(total).max(), 1e-300)
        assert np.abs(directions.T @ directions - np.eye(size)).max() < 1e-12 and (np.diff(values) >= 0).all()
