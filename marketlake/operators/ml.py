"""Folds, models and model reports on feature tables."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.boosting import BoostedModel, Boosting
from marketlake.operators.keys import distributed_key
from marketlake.operators.stats import argmin, regression_metrics
from marketlake.session import stage

PREDICTION = "prediction"
#: The deepest tree that Spark grows; it stands for "no limit", which Spark does not have.
DEEPEST = 30


def _digest(key: str, seed: int) -> Column:
    """A hash of key and seed that every engine can repeat."""
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def assign_folds(df: DataFrame, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1 from a hash of the key and the seed: no shuffle, the same on every run."""
    number = F.conv(F.substring(_digest(key, seed), 1, 12), 16, 10).cast("bigint")
    return df.withColumn("fold", F.pmod(number, F.lit(k)).cast("int"))


def _depth(spec: dict) -> int:
    """Tree depth of a spec; an unlimited depth follows from the number of leaves."""
    depth = spec.get("max_depth")
    if depth is not None and depth > 0:
        return int(depth)
    return max(1, math.ceil(math.log2(spec.get("num_leaves", 32))))


def gbt(target: str, spec: dict, seed: int = 42) -> Boosting:
    """Boosted trees from a run's spec, grown leaf by leaf with a penalty on leaves (see :class:`Boosting`)."""
    return Boosting(target, spec, seed)


def xgboost(target: str, spec: dict, seed: int = 42) -> Boosting:
    """The same for a spec in that library's names and defaults: whole levels down to max_depth, rows drawn for each tree."""
    own = {k: v for k, v in spec.items() if k not in ("min_child_weight", "max_depth", "objective", "eval_metric")}
    if spec.get("objective", "reg:squarederror") != "reg:squarederror":
        raise ValueError("only the squared error is fitted")
    depth = int(spec.get("max_depth") or 6)
    fixed = {"max_depth": depth, "num_leaves": 2**depth, "min_child_samples": math.ceil(spec.get("min_child_weight", 1)), "subsample_freq": 1}
    return Boosting(target, {"learning_rate": 0.3, "reg_lambda": 1.0} | own | fixed, seed)


def spark_gbt(target: str, spec: dict, seed: int = 42) -> GBTRegressor:
    """Spark's own boosted trees from a spec with n_estimators, learning_rate, max_depth or num_leaves, subsample,
    colsample_bytree (here a choice of features for each node) and min_child_samples. They know no penalty on
    leaves, so a spec with ``reg_lambda`` is refused."""
    if spec.get("reg_lambda"):
        raise ValueError("reg_lambda has no counterpart here; leave it out or set it to 0")
    return GBTRegressor(
        labelCol=target, seed=seed, maxDepth=_depth(spec),
        maxIter=int(spec.get("n_estimators", 100)), stepSize=float(spec.get("learning_rate", 0.1)),
        subsamplingRate=float(spec.get("subsample", 1.0)),
        featureSubsetStrategy=str(spec["colsample_bytree"]) if spec.get("colsample_bytree", 1.0) < 1.0 else "all",
        minInstancesPerNode=int(spec.get("min_child_samples", 1)),
    )


def forest(target: str, spec: dict, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=target, seed=seed, numTrees=int(spec.get("n_estimators", 100)),
        maxDepth=int(spec["max_depth"]) if spec.get("max_depth") else DEEPEST, featureSubsetStrategy="all",
        bootstrap=bool(spec.get("bootstrap", True)),
    )


def ridge(df: DataFrame, target: str, alpha: float = 1.0) -> LinearRegression:
    """Ridge regression with the penalty ``alpha`` on the sum of squares.

    Spark's objective is scaled by the row count and the deviation of the target, which one aggregate supplies.
    """
    n, spread = df.agg(F.count(target), F.stddev(target)).first()
    return LinearRegression(
        labelCol=target, regParam=alpha * (spread or 1.0) / max(n, 1), elasticNetParam=0.0, standardization=False,
        solver="l-bfgs", tol=1e-10, maxIter=500,
    )


def build_estimator(df: DataFrame, target: str, model_type: str, spec: dict, seed: int = 42) -> Estimator | Boosting:
    """Estimator of a run record's model type."""
    if model_type == "LightGBM":
        return gbt(target, spec, seed)
    if model_type == "XGBoost":
        return xgboost(target, spec, seed)
    if model_type == "GBT":
        return spark_gbt(target, spec, seed)
    if model_type == "Linear":
        return ridge(df, target, spec.get("alpha", 1.0))
    if model_type in ("RandomForest", "Forest"):
        return forest(target, spec, seed)
    raise ValueError(f"unknown model type {model_type}")


def fit(df: DataFrame, features: list[str], estimator: Estimator | Boosting) -> PipelineModel | BoostedModel:
    """Assemble the features and fit; rows with a null feature are an error of the caller, but not for boosted trees."""
    if isinstance(estimator, Boosting):
        return estimator.fit(df, features)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), estimator]).fit(df)


def fit_gbt(df: DataFrame, features: list[str], target: str, spec: dict) -> BoostedModel:
    return fit(df, features, gbt(target, spec))


def fit_forest(df: DataFrame, features: list[str], target: str, spec: dict) -> PipelineModel:
    return fit(df, features, forest(target, spec))


def fit_ridge(df: DataFrame, features: list[str], target: str, alpha: float = 1.0) -> PipelineModel:
    return fit(df, features, ridge(df, target, alpha))


def predict(model: PipelineModel | BoostedModel, df: DataFrame) -> DataFrame:
    return model.transform(df).drop("features")


def cross_validate(df: DataFrame, features: list[str], estimator: Estimator | Boosting | Callable[[DataFrame], Estimator],
                   folds: str = "fold", k: int = 5) -> DataFrame:
    """Out-of-fold predictions: every row is scored by the model that did not see its fold.

    ``estimator`` may be a function of the training rows, as :func:`ridge` needs it. The table is staged once;
    each of the k fits is a distributed job over it.
    """
    df = stage(df, "cv")
    parts = []
    for i in range(k):
        train = df.where(F.col(folds) != i)
        unfitted = estimator if isinstance(estimator, Estimator | Boosting) else estimator(train)
        parts.append(predict(fit(train, features, unfitted), df.where(F.col(folds) == i)))
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


def fit_full(df: DataFrame, features: list[str], estimator: Estimator | Boosting, target: str) -> tuple[PipelineModel | BoostedModel, DataFrame]:
    """Model on all rows and its metrics on the same rows."""
    model = fit(df, features, estimator)
    return model, regression_metrics(predict(model, df), target, PREDICTION)


def importances(model: PipelineModel | BoostedModel, df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, importance) of a tree model, or the coefficients of a linear one; for boosted trees the share of cuts."""
    if isinstance(model, BoostedModel):
        values = [n / max(1, sum(model.splits)) for n in model.splits]
    else:
        last = model.stages[-1]
        values = (last.featureImportances if hasattr(last, "featureImportances") else last.coefficients).toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def promote(runs: DataFrame, metric: str = "mae", tie: str = "run_id") -> DataFrame:
    """The champion: strictly lowest metric, the earlier run on a tie; the first run counts too."""
    return argmin(runs, metric, tie)


def append_runs(runs: DataFrame, path: str) -> DataFrame:
    """Append run records to the experiment log and return the whole log."""
    runs.write.mode("append").json(path)
    return runs.sparkSession.read.schema(runs.schema).json(path)


def residual_table(pred: DataFrame, y: str, yhat: str = PREDICTION, cap: float | None = None, keep: list[str] | None = None) -> DataFrame:
    """Truth, prediction and residual, the data of the residual charts; of all rows, or of those below a cap."""
    rows = pred if cap is None else pred.where(F.col(y) < cap)
    return rows.select(*(keep or []), F.col(y).alias("actual"), F.col(yhat).alias("predicted"), (F.col(y) - F.col(yhat)).alias("residual"))


def residual_bins(residuals: DataFrame, width: float) -> DataFrame:
    """Residuals counted per bin of predicted value, for tables too large to draw."""
    start = F.floor(F.col("predicted") / width) * width
    return residuals.groupBy(start.cast("double").alias("predicted_from")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("residual").alias("mean_residual"), F.avg(F.abs("residual")).alias("mae")
    )


def permutation_impact(model: PipelineModel | BoostedModel, df: DataFrame, features: list[str], target: str, key: str,
                       inspect: list[str] | None = None, seed: int = 42) -> DataFrame:
    """(feature, mae, increase): error after giving each row another row's value of one feature.

    The permutation pairs the order of the key with the order of a seeded hash, one join for all features.
    Then every row is scored once per feature in a single pass.
    """
    inspect = inspect or features
    rows = distributed_key(df.select(key, target, *features), [key], "_i")
    donors = df.select(_digest(key, seed).alias("_h"), key, *[F.col(f).alias(f"_d_{f}") for f in inspect])
    donors = distributed_key(donors, ["_h", key], "_i").drop("_h", key)
    pairs = stage(rows.join(donors, "_i"), "permutation")
    which = F.explode(F.array(F.lit(-1), *[F.lit(i) for i in range(len(inspect))])).alias("_f")
    wide = pairs.select("*", which)
    swapped = wide.withColumns(
        {f: F.when(F.col("_f") == i, F.col(f"_d_{f}")).otherwise(F.col(f)) for i, f in enumerate(inspect)}
    )
    scored = predict(model, swapped).groupBy("_f").agg(F.avg(F.abs(F.col(target) - F.col(PREDICTION))).alias("mae"))
    scored = stage(scored, "impact")
    base = scored.where("_f = -1").select("mae").scalar()
    name = F.element_at(F.array(*[F.lit(f) for f in inspect]), F.col("_f") + 1)
    return scored.where("_f >= 0").select(name.alias("feature"), "mae", (F.col("mae") - base).alias("increase"))


def save_model(model: PipelineModel | BoostedModel, path: str) -> None:
    if isinstance(model, BoostedModel):
        model.save(SparkSession.active(), f"{path}/boosted")
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | BoostedModel:
    try:
        return BoostedModel.load(SparkSession.active(), f"{path}/boosted")
    except AnalysisException:  # there is no such folder: a pipeline
        return PipelineModel.load(path)
