from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators import ml as M
from marketlake.session import scratch_path


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 2))
    y = 3 * x[:, 0] - x[:, 1] + 5 + rng.normal(scale=0.1, size=200)
    data = [(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id int, a double, b double, y double"), x, y


def test_folds_are_stable_and_balanced(table):
    df, *_ = table
    first = M.assign_folds(df, "id").select("id", "fold").collect()
    again = M.assign_folds(df.repartition(7), "id").select("id", "fold").collect()
    assert sorted(first) == sorted(again)
    sizes = [sum(r.fold == f for r in first) for f in range(5)]
    assert sum(sizes) == 200 and min(sizes) > 20


def test_ridge_equals_closed_form(table):
    df, x, y = table
    for alpha in (1.0, 50.0):
        model = M.fit_ridge(df, ["a", "b"], "y", alpha)
        centred, target = x - x.mean(0), y - y.mean()
        expected = np.linalg.solve(centred.T @ centred + alpha * np.eye(2), centred.T @ target)
        got = {r.feature: r.importance for r in M.importances(model, df, ["a", "b"]).collect()}
        assert [got["a"], got["b"]] == pytest.approx(list(expected), rel=1e-5)


def test_every_row_is_scored_once_by_another_fold(table):
    df, x, y = table
    folded = M.assign_folds(df, "id", k=3)
    pred = M.cross_validate(folded, ["a", "b"], lambda train: M.ridge(train, "y", 1.0), k=3).collect()
    assert sorted(r.id for r in pred) == list(range(200))
    assert max(abs(r.prediction - r.y) for r in pred) < 1.0
    for f in range(3):
        train = np.array([r.fold != f for r in sorted(folded.collect(), key=lambda r: r.id)])
        centred, mean = x[train] - x[train].mean(0), y[train].mean()
        beta = np.linalg.solve(centred.T @ centred + np.eye(2), centred.T @ (y[train] - mean))
        for r in pred:
            if r.fold == f:
                assert r.prediction == pytest.approx(mean + (x[r.id] - x[train].mean(0)) @ beta, rel=1e-5)


def test_trees_and_importances(table):
    df, *_ = table
    spec = {"n_estimators": 4, "learning_rate": 0.3, "num_leaves": 8, "max_depth": -1, "subsample": 0.9, "colsample_bytree": 0.8}
    cuts = {r.feature: r.importance for r in M.importances(M.fit_gbt(df, ["a", "b"], "y", spec), df, ["a", "b"]).collect()}
    assert set(cuts) == {"a", "b"} and sum(cuts.values()) == pytest.approx(1.0)
    for model in (M.fit(df, ["a", "b"], M.spark_gbt("y", spec)), M.fit_forest(df, ["a", "b"], "y", {"n_estimators": 4, "max_depth": 3})):
        weights = {r.feature: r.importance for r in M.importances(model, df, ["a", "b"]).collect()}
        assert weights["a"] > weights["b"] and sum(weights.values()) == pytest.approx(1.0)
    model, metrics = M.fit_full(df, ["a", "b"], M.build_estimator(df, "y", "Linear", {"alpha": 0.1}), "y")
    assert metrics.first().r2 > 0.99


def test_save_load(spark, table):
    df, *_ = table
    model = M.fit_ridge(df, ["a", "b"], "y")
    path = scratch_path(spark, "model")
    M.save_model(model, path)
    a = M.predict(model, df).orderBy("id").select("prediction").collect()
    assert a == M.predict(M.load_model(path), df).orderBy("id").select("prediction").collect()


def test_permutation_swaps_values_between_rows(table):
    df, *_ = table
    df = df.withColumn("noise", F.lit(1.0))
    model = M.fit_ridge(df, ["a", "b", "noise"], "y")
    impact = {r.feature: r.increase for r in M.permutation_impact(model, df, ["a", "b", "noise"], "y", "id").collect()}
    assert impact["a"] > impact["b"] > 0.3 and impact["noise"] == pytest.approx(0.0)


def test_residuals(spark):
    pred = spark.createDataFrame([(10.0, 12.0), (20.0, 14.0), (2000.0, 1.0)], "y double, prediction double")
    assert sorted(r.residual for r in M.residual_table(pred, "y").collect()) == [-2.0, 6.0, 1999.0]
    table = M.residual_table(pred, "y", cap=1000)
    assert sorted(r.residual for r in table.collect()) == [-2.0, 6.0]
    assert [tuple(r) for r in M.residual_bins(table, 10).collect()] == [(10.0, 2, 2.0, 4.0)]


def test_promotion(spark):
    path = scratch_path(spark, "runs")
    M.append_runs(spark.createDataFrame([(1, 5.0), (2, float("nan"))], "run_id int, mae double"), path)
    log = M.append_runs(spark.createDataFrame([(3, 4.0), (4, 4.0)], "run_id int, mae double"), path)
    assert M.promote(log).first().run_id == 3
