"""Histogram boosting against a plain version that cuts one leaf at a time and tries every value."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators import ml as M
from marketlake.operators.boosting import BoostedModel, Boosting, _drawn
from marketlake.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


def plain(x, y, spec):
    rate, leaves, penalty, least = (spec[k] for k in ("learning_rate", "num_leaves", "reg_lambda", "min_child_samples"))
    deepest = spec.get("max_depth", -1)
    x = np.where(np.isnan(x), -np.inf, x)
    score = np.full(len(y), y.mean())

    def best(rows, g):
        found, total, n = (0.0,), g[rows].sum(), len(rows)
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= cut]
                if least <= len(left) <= n - least:
                    gl = g[left].sum()
                    gain = gl**2 / (len(left) + penalty) + (total - gl) ** 2 / (n - len(left) + penalty) - total**2 / (n + penalty)
                    if gain > found[0] + 1e-9:
                        found = (gain, f, cut)
        return found

    for _ in range(spec["n_estimators"]):
        g = score - y
        parts = [(best(np.arange(len(y)), g), np.arange(len(y)), 0)]
        while len(parts) < leaves:
            able = [i for i, (b, _, d) in enumerate(parts) if b[0] > 0 and (deepest <= 0 or d < deepest)]
            if not able:
                break
            (_, f, cut), rows, d = parts.pop(max(able, key=lambda i: parts[i][0][0]))
            parts += [(best(p, g), p, d + 1) for p in (rows[x[rows, f] <= cut], rows[x[rows, f] > cut])]
        for _, rows, _ in parts:
            score[rows] -= rate * g[rows].sum() / (len(rows) + penalty)
    return score


@pytest.fixture(scope="module")
def table(spark):
    rng, n = np.random.default_rng(0), 400
    x = np.column_stack([rng.integers(0, 40, n), rng.integers(0, 7, n), rng.normal(size=n).round(1)]).astype(float)
    x[::17, 2] = np.nan
    y = np.sin(x[:, 0] / 5) * 10 + x[:, 1] ** 2 * (np.nan_to_num(x[:, 2], nan=-1) > 0) + rng.normal(size=n)
    rows = [(i, a, b, None if i % 34 == 0 else c, t) for i, (a, b, c, t) in enumerate(np.column_stack([x, y]).tolist())]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(6), x, y


@pytest.mark.parametrize("spec", [
    {"n_estimators": 3, "learning_rate": 0.3, "num_leaves": 8, "reg_lambda": 2.0, "min_child_samples": 10},
    {"n_estimators": 2, "learning_rate": 0.5, "num_leaves": 31, "reg_lambda": 0.5, "min_child_samples": 5, "max_depth": 3},
    {"n_estimators": 3, "learning_rate": 1.0, "num_leaves": 2, "reg_lambda": 0.0, "min_child_samples": 1},
])
def test_equals_growing_one_leaf_at_a_time(spark, table, spec):
    df, x, y = table
    model = M.fit_gbt(df, ["a", "b", "c"], "y", spec)
    got = [r.prediction for r in M.predict(model, df).orderBy("id").collect()]
    assert got == pytest.approx(plain(x, y, spec), abs=1e-9)
    path = scratch_path(spark, "boosted")
    M.save_model(model, path)
    assert [r.prediction for r in M.predict(M.load_model(path), df).orderBy("id").collect()] == got


def test_scores_are_refreshed(spark, table, monkeypatch):
    df, x, y = table
    monkeypatch.setattr("marketlake.operators.boosting.REFRESH", 2)
    spec = {"n_estimators": 5, "learning_rate": 0.3, "num_leaves": 4, "reg_lambda": 1.0, "min_child_samples": 10}
    got = [r.prediction for r in M.predict(M.fit_gbt(df, ["a", "b", "c"], "y", spec), df).orderBy("id").collect()]
    assert got == pytest.approx(plain(x, y, spec), abs=1e-9)


def test_champion_spec_is_accepted(table):
    df, x, y = table
    spec = {"n_estimators": 2, "learning_rate": 0.04, "max_depth": -1, "num_leaves": 48, "subsample": 0.8, "colsample_bytree": 0.8, "reg_lambda": 2.0, "min_child_samples": 30, "objective": "regression", "metric": "rmse"}
    model = M.fit(df, ["a", "b", "c"], M.build_estimator(df, "y", "LightGBM", spec))
    assert len(model.trees) == 2 and all(len({f for f in t.feature if f >= 0}) <= 2 for t in model.trees)  # two of three features for a tree
    with pytest.raises(ValueError, match="not in a spec"):
        Boosting("y", {"dart": True})
    model = M.fit(df, ["a", "b", "c"], M.build_estimator(df, "y", "XGBoost", {"n_estimators": 2, "max_depth": 2, "subsample": 0.5}))
    assert all(sum(f >= 0 for f in t.feature) <= 3 for t in model.trees)


def test_tables_with_nothing_to_learn(spark, table):
    df, *_ = table
    for rows in (df.where("false"), df.where("id < 3"), df.withColumn("a", F.lit(1.0)).withColumn("b", F.lit(None).cast("double")).withColumn("c", F.lit(float("nan")))):
        model = M.fit_gbt(rows, ["a", "b", "c"], "y", {"n_estimators": 3})
        assert isinstance(model, BoostedModel) and sum(model.splits) == 0
        assert {round(r.prediction, 6) for r in M.predict(model, rows).collect()} <= {round(rows.agg(F.avg("y")).first()[0] or 0.0, 6)}


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).select("id", (F.col("id") * 1.0).alias("a"), F.when(F.col("id") < 2500, 0.0).otherwise(10.0).alias("y"))
    model = M.fit_gbt(df, ["a"], "y", {"n_estimators": 1, "learning_rate": 1.0, "num_leaves": 2})
    wrong = M.predict(model, df).where("abs(prediction - y) > 1").count()
    assert len(model.bounds[0]) <= 254 and wrong <= 5000 / 250


def test_rows_are_drawn_the_same_again():
    ids = np.arange(100_000)
    first = _drawn(ids, 3, 0.8)
    assert (first == _drawn(ids, 3, 0.8)).all() and abs(first.mean() - 0.8) < 0.01 and (first != _drawn(ids, 4, 0.8)).any()
    assert _drawn(ids, 1, 1.0).all()
