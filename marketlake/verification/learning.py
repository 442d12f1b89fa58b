"""Folds, models and model reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import ml as M
from marketlake.operators.project import drop_null_rows
from marketlake.plans.features import feature_set, listing_features
from marketlake.session import scratch_path, stage
from marketlake.verification.fixtures import rounded, with_ctes
from marketlake.verification.registry import query

FEATURES = ["accommodates", "bedrooms", "beds", "availability_rate", "reviews"]
TARGET = "target_price"
#: The champion's spec but for its 700 rounds, which are as many times the work of one (README: measured).
SPEC = {
    "n_estimators": 8, "learning_rate": 0.04, "max_depth": -1, "num_leaves": 48, "subsample": 0.8, "colsample_bytree": 0.8,
    "reg_lambda": 2.0, "min_child_samples": 30, "objective": "regression", "metric": "rmse",
}


def _training(t):
    """The listing dataset with a target that hangs together with the features."""
    df = t.dataset.select(
        "listing_id", "accommodates", "bedrooms", "beds", "availability_rate", F.col("total_reviews").cast("double").alias("reviews"), TARGET
    )
    return stage(M.assign_folds(df.where(F.col(TARGET).isNotNull()), "listing_id"), "training")


def _fold_sql(key: str, k: int = 5, seed: int = 42) -> str:
    return f"(('0x' || substr(md5({key}::varchar || '-{seed}'), 1, 12))::bigint % {k})"


@query("m01_assign_folds", f"select p_partkey, {_fold_sql('p_partkey')} fold from part")
def m01(t):
    return M.assign_folds(t.part.select("p_partkey"), "p_partkey").withColumn("fold", F.col("fold").cast("bigint"))


def _all_features(t):
    """Every listing feature, and their names."""
    df = stage(listing_features(t.dataset, keep=["listing_id"]), "features")
    return df, [c for c in df.columns if c not in ("listing_id", TARGET)]


@query("m02_fit_gbt")
def m02(t):
    df, features = _all_features(t)
    return M.predict(M.fit_gbt(df, features, TARGET, SPEC), df).select("listing_id", TARGET, "prediction")


BOOST = {"n_estimators": 2, "learning_rate": 0.5, "num_leaves": 2, "reg_lambda": 2.0, "min_child_samples": 30}


def _boosting_sql(rounds: int, select: str) -> str:
    """Trees of one cut each over two features, with the penalty of BOOST; cuts are tried at every value."""
    rate, penalty, least = BOOST["learning_rate"], BOOST["reg_lambda"], BOOST["min_child_samples"]
    ctes = ["s0 as (select p_partkey, p_size x0, length(p_name) x1, p_retailprice y, avg(p_retailprice) over () s from part)"]
    for k in range(1, rounds + 1):
        ctes.append(f"""v{k} as (select f, v, count(*) n, sum(s - y) g from (select 0 f, x0 v, s, y from s{k - 1} union all select 1, x1, s, y from s{k - 1}) group by f, v),
            c{k} as (select f, v, sum(n) over w ln, sum(g) over w lg, sum(n) over (partition by f) n, sum(g) over (partition by f) g
                     from v{k} window w as (partition by f order by v)),
            b{k} as (select * from c{k} where ln >= {least} and n - ln >= {least}
                     order by lg * lg / (ln + {penalty}) + (g - lg) * (g - lg) / (n - ln + {penalty}) desc, f, v limit 1),
            s{k} as (select p_partkey, x0, x1, y, s - {rate} * case when case f when 0 then x0 else x1 end <= v
                     then lg / (ln + {penalty}) else (g - lg) / (n - ln + {penalty}) end s from s{k - 1}, b{k})""")
    return "with " + ", ".join(ctes) + " " + select


def _two_features(t):
    return t.part.select("p_partkey", "p_retailprice", "p_size", F.length("p_name").alias("name_length"))


@query("m02_boosting_rounds", _boosting_sql(2, "select p_partkey, round(s, 4) prediction from s2"))
def m02_rounds(t):
    df = _two_features(t)
    model = M.fit_gbt(df, ["p_size", "name_length"], "p_retailprice", BOOST)
    return rounded(M.predict(model, df), 4, "prediction").select("p_partkey", "prediction")


@query(
    "m07_boosting_cuts",
    _boosting_sql(5, """select feature, (count(*) filter (f = i) / 5.0)::double importance
       from (values ('p_size', 0), ('name_length', 1)) names(feature, i), (""" + " union all ".join(f"select f from b{k}" for k in range(1, 6)) + ") cuts group by feature"),
)
def m07_cuts(t):
    df = _two_features(t)
    model = M.fit_gbt(df, ["p_size", "name_length"], "p_retailprice", BOOST | {"n_estimators": 5})
    return M.importances(model, df, ["p_size", "name_length"])


@query("m03_fit_forest")
def m03(t):
    df = _training(t)
    model = M.fit_forest(df, FEATURES, TARGET, {"n_estimators": 5, "max_depth": 4})
    return M.predict(model, df).select("listing_id", TARGET, "prediction")


_GROUPS = ("case when p_size > 25 then 1 else 0 end", "select p_partkey, round(avg(p_retailprice) over (partition by {0}), 4) prediction from part")


def _halves(t):
    """One 0/1 feature: a tree without sampling predicts the mean of each half."""
    return t.part.select("p_partkey", "p_retailprice", F.when(F.col("p_size") > 25, 1).otherwise(0).alias("large"))


@query("m02_fit_gbt_groups", _GROUPS[1].format(_GROUPS[0]))
def m02_groups(t):
    df = _halves(t)
    model = M.fit(df, ["large"], M.spark_gbt("p_retailprice", {"n_estimators": 20, "learning_rate": 0.1, "max_depth": 1}))
    return rounded(M.predict(model, df), 4, "prediction").select("p_partkey", "prediction")


@query("m03_fit_forest_groups", _GROUPS[1].format(_GROUPS[0]))
def m03_groups(t):
    df = _halves(t)
    return rounded(M.predict(M.fit_forest(df, ["large"], "p_retailprice", {"n_estimators": 1, "bootstrap": False}), df), 4, "prediction").select("p_partkey", "prediction")


@query("m07_importances_groups", "select 'large' feature, 1.0::double importance")
def m07_groups(t):
    df = _halves(t)
    return M.importances(M.fit_forest(df, ["large"], "p_retailprice", {"n_estimators": 1}), df, ["large"])


def _lines(t):
    """Quantity as the feature, price as the target; a row without them cannot train a model."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return drop_null_rows(lines, ["l_quantity", "l_extendedprice"])


_LINES_SQL = "(select * from lineitem where l_quantity is not null and l_extendedprice is not null)"


@query(
    "m04_fit_ridge",
    f"""with c as (select avg(l_quantity) mx, avg(l_extendedprice) my from {_LINES_SQL}),
            s as (select sum((l_quantity - mx) * (l_extendedprice - my)) sxy, sum((l_quantity - mx) ** 2) sxx from {_LINES_SQL}, c)
       select 'l_quantity' feature, round(sxy / (sxx + 1000.0), 2) importance from s""",
)
def m04(t):
    df = _lines(t)
    model = M.fit_ridge(df, ["l_quantity"], "l_extendedprice", alpha=1000.0)
    return M.importances(model, df, ["l_quantity"]).select("feature", F.round("importance", 2).alias("importance"))


_MOMENTS = "count(*) n, sum(l_quantity) sq, sum(l_extendedprice) sy, sum(l_quantity * l_quantity) sqq, sum(l_quantity * l_extendedprice) sqy"
_SLOPE = "(sqy - sq * sy / n) / (sqq - sq * sq / n + {})"


@query(
    "m05_cross_validate",
    f"""with lines as (select *, {_fold_sql('l_orderkey')} fold from {_LINES_SQL}),
            parts as (select fold, {_MOMENTS} from lines group by 1),
            train as (select a.fold, sum(b.n) n, sum(b.sq) sq, sum(b.sy) sy, sum(b.sqq) sqq, sum(b.sqy) sqy
                      from parts a join parts b on a.fold <> b.fold group by 1),
            models as (select fold, {_SLOPE.format(100.0)} slope, sy / n my, sq / n mq from train)
       select l_orderkey, l_linenumber, fold, round(my + slope * (l_quantity - mq), 1) prediction from lines join models using (fold)""",
)
def m05(t):
    folded = M.assign_folds(_lines(t), "l_orderkey")
    pred = M.cross_validate(folded, ["l_quantity"], lambda train: M.ridge(train, "l_extendedprice", 100.0))
    return rounded(pred, 1, "prediction").select("l_orderkey", "l_linenumber", F.col("fold").cast("bigint").alias("fold"), "prediction")


_MODEL = f"model as (select {_SLOPE.format(100.0)} slope, sy / n my, sq / n mq from (select {_MOMENTS} from {_LINES_SQL}))"


@query(
    "m06_fit_full",
    f"""with {_MODEL}, scored as (select l_extendedprice y, my + slope * (l_quantity - mq) p from {_LINES_SQL}, model)
       select round(avg(abs(y - p)), 3) mae, round(sqrt(avg((y - p) * (y - p))), 3) rmse,
              round(avg(abs((y - p) / y)) * 100, 3) mape, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) r2 from scored""",
)
def m06(t):
    df = _lines(t)
    metrics = M.fit_full(df, ["l_quantity"], M.ridge(df, "l_extendedprice", 100.0), "l_extendedprice")[1]
    return rounded(rounded(metrics, 3, "mae", "rmse", "mape"), 6, "r2")


@query("m07_importances")
def m07(t):
    df, features = _all_features(t)
    return M.importances(M.fit_gbt(df, features, TARGET, SPEC), df, features)


_WITH_LEAKS = with_ctes("dataset", """select {} from (select listing_id, accommodates, avg_price, est_revenue,
    round(est_revenue / (total_reviews + 1), 6) revenue_per_review, round(est_revenue / (availability_rate * 365 + 1), 6) revenue_per_available_day, target_price
    from dataset)""")


@query("m08_feature_sets", _WITH_LEAKS.replace("select {} from", "select 'no_avg,prospective' dropped, listing_id, accommodates, target_price from"))
def m08(t):
    df = t.dataset.select("listing_id", "accommodates", "avg_price", "est_revenue", "total_reviews", "availability_rate", TARGET)
    df = df.withColumns({
        "revenue_per_review": F.col("est_revenue") / (F.col("total_reviews") + 1),
        "revenue_per_available_day": F.col("est_revenue") / (F.col("availability_rate") * 365 + 1),
    }).drop("total_reviews", "availability_rate")
    dropped = [k for k in ("full", "no_avg", "prospective") if "avg_price" not in feature_set(df, k).columns]
    return feature_set(df, "prospective").withColumn("dropped", F.lit(",".join(dropped)))


@query(
    "m09_promote",
    """select run_id, mae from (select l_suppkey run_id, sum(cast(round(abs(l_extendedprice - l_quantity * 1400) * 100) as bigint))::double / count(*) mae
                               from lineitem group by 1) order by mae, run_id limit 1""",
)
def m09(t):
    err = F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1400)
    runs = t.lineitem.groupBy(F.col("l_suppkey").alias("run_id")).agg(
        (F.sum(F.round(err * 100).cast("bigint")).cast("double") / F.count(F.lit(1))).alias("mae")
    )
    log = M.append_runs(runs, scratch_path(t.spark, "m09"))
    return M.promote(log)


@query(
    "m10_residual_table",
    """select l_orderkey, l_linenumber, l_extendedprice actual, l_quantity * 1500 predicted, round(l_extendedprice - l_quantity * 1500, 2) residual
       from lineitem where l_extendedprice < 20000""",
)
def m10(t):
    pred = t.lineitem.withColumn("prediction", F.col("l_quantity") * 1500)
    table = M.residual_table(pred, "l_extendedprice", cap=20000, keep=["l_orderkey", "l_linenumber"])
    return rounded(table, 2, "residual")


@query(
    "m11_permutation_impact",
    """with own as (select row_number() over (order by p_partkey) i, p_size x, p_retailprice y from part),
            donor as (select row_number() over (order by md5(p_partkey::varchar || '-42'), p_partkey) i, p_size d from part),
            m as (select (sum(x * y) - sum(x) * sum(y) / count(*)) / (sum(x * x) - sum(x) * sum(x) / count(*) + 100.0) slope, avg(x) mx, avg(y) my from own),
            e as (select avg(abs(y - my - slope * (x - mx))) base, avg(abs(y - my - slope * (d - mx))) moved from own join donor using (i), m)
       select 'p_size' feature, round(moved, 5) mae, round(moved - base, 5) increase from e""",
)
def m11(t):
    model = M.fit_ridge(t.part, ["p_size"], "p_retailprice", 100.0)
    return rounded(M.permutation_impact(model, t.part, ["p_size"], "p_retailprice", "p_partkey"), 5, "mae", "increase")


@query(
    "m12_save_load_model",
    f"with {_MODEL} select l_orderkey, l_linenumber, round(my + slope * (l_quantity - mq), 1) prediction from {_LINES_SQL}, model",
)
def m12(t):
    df = _lines(t)
    path = scratch_path(t.spark, "m12")
    M.save_model(M.fit_ridge(df, ["l_quantity"], "l_extendedprice", 100.0), path)
    return rounded(M.predict(M.load_model(path), df), 1, "prediction").select("l_orderkey", "l_linenumber", "prediction")
