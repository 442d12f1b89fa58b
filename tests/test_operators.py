from __future__ import annotations

import decimal
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.operators import aggregates as A
from marketlake.operators import encode as E
from marketlake.operators import joins as J
from marketlake.operators import keys as K
from marketlake.operators import order as O
from marketlake.operators import project as P
from marketlake.operators import quality as Q
from marketlake.operators import sets as U
from marketlake.operators import stats as S


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- a third of all rows under one key ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    data = []
    for i in range(3000):
        hot = i % 3 == 0
        data.append((7 if hot else rng.randrange(50), "x" if hot else None if i % 7 == 0 else f"c{i % 5}", float(rng.randrange(0, 500)) / 4, i))
    data += [(7, "x", 1.0, -1)] * 1500  # copies of one row
    return spark.createDataFrame(data, "k int, c string, v double, id int").repartition(6), data


def test_distributed_key_equals_row_number(skewed):
    df, data = skewed
    got = K.distributed_key(df, ["k", "v"], "key").collect()
    assert sorted(r.key for r in got) == list(range(1, len(data) + 1))
    order = [(r.k, r.v, r.c is None, r.c or "", r.id) for r in sorted(got, key=lambda r: r.key)]
    assert order == sorted(order)


def test_distributed_key_restarts_per_group(skewed):
    df, data = skewed
    got = K.distributed_key(df, ["v", "id"], "key", by=["c"]).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.c, []).append((r.key, r.v, r.id))
    assert None in groups and sum(map(len, groups.values())) == len(data)
    for members in groups.values():
        members.sort()
        assert [m[0] for m in members] == list(range(1, len(members) + 1))
        assert [m[1:] for m in members] == sorted(m[1:] for m in members)


def test_distributed_key_of_nothing(spark):
    assert K.distributed_key(spark.createDataFrame([], "a int"), ["a"], "k").collect() == []


def test_percentiles_match_numpy(skewed):
    df, data = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["column"], r.prob): r.value for r in A.percentiles(df, ["v", "id"], probs).collect()}
    for name, position in (("v", 2), ("id", 3)):
        for p in probs:
            assert got[(name, p)] == pytest.approx(np.percentile([d[position] for d in data], p * 100))
    grouped = {(r.k, r.prob): r.value for r in A.percentiles(df, ["v"], [0.5], keys=["k"]).collect()}
    for k in {d[0] for d in data}:
        assert grouped[(k, 0.5)] == pytest.approx(statistics.median(d[2] for d in data if d[0] == k))


def test_price_summary_matches_brute_force(skewed):
    df, data = skewed
    df = df.withColumn("price", F.when(F.col("id") % 4 != 0, F.col("v")))
    got = {r.c: r for r in A.price_summary(df, ["c"], "price", {"total": F.col("k")}, "id", {"top": F.col("id")}).collect()}
    for c in {d[1] for d in data}:
        members = [d for d in data if d[1] == c]
        prices = [d[2] for d in members if d[3] % 4 != 0]
        r = got[c]
        assert (r["rows"], r.priced, r.items, r.total, r.top) == (
            len(members), len(prices), len({d[3] for d in members}), sum(d[0] for d in members), max(d[3] for d in members)
        )
        assert r.median_price == pytest.approx(statistics.median(prices))
        assert (r.min_price, r.max_price) == (min(prices), max(prices))
        assert r.price_micros == sum(round(p * 10**6) for p in prices)


def test_price_summary_weights(spark):
    df = spark.createDataFrame([(1, 10.0, 3), (1, 20.0, 1), (1, None, 5)], "g int, p double, n int")
    r = A.price_summary(df, ["g"], "p", {}, weight="n").first()
    assert (r["rows"], r.priced, r.median_price, r.price_micros) == (9, 4, 10.0, 50_000_000)


def test_round_cents(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (100.25,), (1.004,), (None,)], "m double")
    assert [r[0] for r in df.select(A.round_cents("m")).collect()] == [1.01, 2.68, 100.25, 1.0, None]


def test_keep_first(skewed):
    df, data = skewed
    got = K.keep_first(df, ["k"], ["v", "id"]).collect()
    assert len(got) == len({d[0] for d in data})
    for r in got:
        assert (r.v, r.id) == min((d[2], d[3]) for d in data if d[0] == r.k)


def test_freq_encode_with_null_category(skewed):
    df, data = skewed
    got = E.freq_encode(df, ["c", ("c", "k")], names=["n", "pair"]).collect()
    assert len(got) == len(data)
    for r in random.Random(2).sample(got, 50):
        assert r.n == sum(d[1] == r.c for d in data)
        assert r.pair == sum((d[1], d[0]) == (r.c, r.k) for d in data)
    shares = E.freq_encode(df, ["c"], normalize=True).select("c", "c_freq").distinct().collect()
    assert sum(r.c_freq for r in shares) == pytest.approx(1.0)


def test_label_encode(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "c string")
    assert rows(E.label_encode(df, "c")) == [("a", 0), ("b", 1), ("b", 1), (None, -1)]


# --- joins ----------------------------------------------------------------------------------------------------


def test_fan_out_on_name_and_guard(spark):
    areas = spark.createDataFrame([("N", "G1", 1), ("N", "G2", 2)], "neighbourhood string, g string, neighbourhood_key int")
    listings = spark.createDataFrame([(1, "N"), (2, "M")], "listing_id int, neighbourhood string")
    assert J.lookup_key(listings, areas, "neighbourhood", "neighbourhood_key").count() == 3
    with pytest.raises(ValueError):
        J.assert_unique(areas, "neighbourhood")
    one = J.assert_unique(areas, "neighbourhood", dedupe=True, order=["neighbourhood_key"])
    assert rows(one.select("neighbourhood_key")) == [(1,)]


def test_coalesce_eq_treats_blank_as_null(spark):
    df = spark.createDataFrame([("", None), (None, None), ("a", ""), ("a", "a")], "a string, b string")
    assert [r[0] for r in df.select(J.coalesce_eq("a", "b")).collect()] == [True, True, False, True]


def test_map_values_null_key(spark):
    df = spark.createDataFrame([("a",), (None,), ("z",)], "c string")
    counts = spark.createDataFrame([("a", 2), (None, 5)], "c string, n int")
    assert rows(J.map_values(df, "c", counts, "n", "freq", 0)) == [("a", 2), ("z", 0), (None, 5)]


def test_left_join_counts(spark):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    other = spark.createDataFrame([(1,), (1,), (3,)], "id int")
    assert rows(J.left_join_counts(df, other, "id", "n")) == [(1, 2), (2, 0)]


def test_remap_drops_unknown(spark):
    old = spark.createDataFrame([("A", 1, 9, None), ("B", 1, 9, "")], "city string, k int, id int, g string")
    new = spark.createDataFrame([(5, 9, None)], "k int, id int, g string")
    fact = spark.createDataFrame([("A", 1, 10), ("B", 1, 20), ("B", 2, 30), ("A", None, 40)], "city string, k int, v int")
    out = J.remap_keys(fact, old, new, ["id", "g"], "k", by="city", blank_eq=["g"])
    assert rows(out) == [("A", 5, 10), ("B", 5, 20)]


# --- sets and order -------------------------------------------------------------------------------------------


def test_conform_prefers_low_key_then_city_order(spark):
    dims = spark.createDataFrame(
        [("paris", 1, 9, "p"), ("london", 1, 9, "l"), ("london", 2, 3, "l3"), ("paris", 2, 4, "p4")],
        "city string, host_key int, host_id int, host_name string",
    )
    out = U.conform_dim(dims, ["host_id"], "host_key", ["host_id"], cities=["paris", "london"])
    assert rows(out.select("host_key", "host_id", "host_name")) == [(1, 3, "l3"), (2, 4, "p4"), (3, 9, "p")]


def test_union_adds_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2,)], "i int")
    assert rows(U.union_cities({"A": a, "B": b}).select("i", "s", "city")) == [(1, "x", "A"), (2, None, "B")]


def test_rankings(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0), (4, 5.0)], "host_id int, total_estimated_revenue double")
    assert [r.host_id for r in O.rank_hosts(df, n=3).collect()] == [3, 1, 4]
    weights = spark.createDataFrame([("a", -3.0), ("b", 2.0), ("c", 0.0)], "feature string, importance double")
    assert [r.feature for r in O.top_importances(weights, 2).collect()] == ["a", "b"]
    issues = spark.createDataFrame([("t", i, f"i{i}") for i in range(5)], "table string, position int, issue string")
    assert rows(O.top_issues(issues, 2)) == [("t", 5, 1, "i0"), ("t", 5, 2, "i1")]


# --- projections ----------------------------------------------------------------------------------------------


def test_coerce_modes(spark):
    df = spark.createDataFrame([("1", "$2.50", "t"), ("x", "n/a", "?")], "a string, p string, b string")
    types = {"a": "int", "p": "money", "b": "boolean"}
    assert rows(P.coerce(df, types)) == [(1, 2.5, True), (None, None, None)]
    assert tuple(P.rejected_counts(df, types).first()) == (1, 1, 1)
    with pytest.raises(Exception):
        P.coerce(df, types, mode="fail").collect()


def test_fill_and_flag(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (3.0, 4.0)], "a double, b double")
    assert rows(P.fill_median(df, ["a", "b"])) == [(1.0, 3.0), (2.0, 2.0), (3.0, 4.0)]
    empty = spark.createDataFrame([(None,)], "a double")
    assert rows(P.fill_median(empty, ["a"])) == [(None,)]
    values = spark.createDataFrame([(10.0,)] * 30 + [(1000.0,), (None,)], "x double")
    flagged = P.flag_outliers(values, ["x"], 5.0).where("x_outlier").collect()
    assert [r.x for r in flagged] == [1000.0]


def test_ensure_numeric_keep(spark):
    df = spark.createDataFrame([(1, "a", True)], "i int, s string, b boolean")
    out = P.ensure_columns(df, {"n": None, "i": 0, "z": ("int", None)})
    assert out.schema["n"].dataType.simpleString() == "double" and out.schema["z"].dataType.simpleString() == "int"
    assert P.numeric_only(out, keep=["s"]).columns == ["i", "s", "n", "z"]


# --- statistics -----------------------------------------------------------------------------------------------


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 2.0), ("b", 5.0, 4.0), ("b", 5.0, 6.0)], "f string, y double, p double")
    got = {r.f: r for r in S.regression_metrics(df, "y", "p", ["f"]).collect()}
    assert got["a"].mape is None and got["a"].mae == 0.5 and got["a"].r2 == pytest.approx(0.5)
    assert got["b"].r2 is None and got["b"].mape == pytest.approx(20.0)


def test_argmin_ignores_nan_and_takes_first(spark):
    runs = spark.createDataFrame([(1, float("nan")), (2, 3.0), (3, 3.0), (4, None)], "run_id int, mae double")
    assert rows(S.argmin(runs, "mae", "run_id")) == [(2, 3.0)]
    assert S.argmin(runs.where("run_id in (1, 4)"), "mae", "run_id").collect() == []


def test_two_sample_and_pearson(spark):
    a, b = [1.0, 2.0, 4.0], [2.0, 5.0, 7.0, 9.0]
    df = spark.createDataFrame([("a", v) for v in a] + [("b", v) for v in b], "g string, v double")
    r = S.two_sample(df, "v", "g", "a", "b").first()
    se = (statistics.variance(a) / 3 + statistics.variance(b) / 4) ** 0.5
    assert r.t == pytest.approx((statistics.mean(a) - statistics.mean(b)) / se)
    xy = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (None, 1.0)], "x double, y double")
    p = S.pearson(xy, "x", "y").first()
    assert p.n == 3 and p.r == pytest.approx(np.corrcoef([1, 2, 3], [2, 1, 5])[0, 1])
    assert p.p_value == pytest.approx(1 - 2 / math.pi * math.atan(abs(p.t)))  # one degree of freedom


def _exact_p(t: str, df: int) -> float:
    """Two-sided p-value for an even number of degrees of freedom: a finite sum, in 400 digits."""
    with decimal.localcontext() as c:
        c.prec = 400
        t = decimal.Decimal(t)
        square = df / (df + t * t)
        term = total = decimal.Decimal(1)
        for k in range(1, df // 2):
            term *= square * (2 * k - 1) / (2 * k)
            total += term
        return float(1 - (1 - square).sqrt() * total)


def test_student_p_values_hold_far_into_the_tail(spark):
    cases = [(t, n) for n in (2, 4, 10, 60, 1000, 20000) for t in ("0.001", "0.5", "1.7", "1.8", "5", "21.9", "-22", "300") if n > 4 or t != "300"]
    df = spark.createDataFrame([(float(t), n) for t, n in cases], "t double, n long")
    for (t, n), r in zip(cases, df.select(S.student_p_value("t", "n").alias("p")).collect(), strict=True):
        exact = _exact_p(t, n)
        if exact > 1e-300:
            assert r.p == pytest.approx(exact, rel=1e-9), (t, n)
        else:
            assert r.p < 1e-290
    assert _exact_p("22", 20000) < 1e-100


def test_student_p_values_between_whole_degrees_and_without_any(spark):
    a, x = 7.3 / 2, 7.3 / (7.3 + 40.0**2)
    z, w = np.polynomial.laguerre.laggauss(60)
    whole = float((w / np.sqrt(1 - x * np.exp(-z / a))).sum())
    exact = x**a / a * math.exp(math.lgamma(a + 0.5) - math.lgamma(a)) / math.sqrt(math.pi) * whole
    data = [(40.0, 7.3), (2.0, 0.5), (None, 3.0), (float("nan"), 3.0), (float("inf"), 3.0), (0.0, 3.0), (1.0, None)]
    got = [r.p for r in spark.createDataFrame(data, "t double, n double").select(S.student_p_value("t", "n").alias("p")).collect()]
    assert got[0] == pytest.approx(exact, rel=1e-9)
    assert got[1:] == [None, None, None, 0.0, 1.0, None]


# --- quality --------------------------------------------------------------------------------------------------


def test_profile_and_rules(spark):
    df = spark.createDataFrame([(1, None, 1.5), (1, None, None)], "`a b` int, z string, d double").withColumn("m", F.lit(2).cast("decimal(5,2)"))
    profile = {r["column"]: r for r in Q.profile(df, "t").collect()}
    assert profile["z"].null_rate == 1.0 and profile["z"].cardinality == 0 and profile["a b"].cardinality == 1
    assert profile["d"].avg == 1.5 and profile["m"].min == 2.0 and profile["z"].min is None
    issues = [r.issue for r in Q.validate(Q.profile(df, "t")).orderBy("position").collect()]
    assert issues == ["Table has only 2 rows (min: 10)", "Column z has null rate 100.00% (max: 50.00%)"]
    empty = Q.profile(df.where("false"), "e").collect()
    assert {r.null_rate for r in empty} == {0.0} and {r.total_rows for r in empty} == {0}
    assert Q.report_json(Q.profile(df, "t"), "2025-01-01").count() == 1


def test_key_audits(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows(Q.check_fk(fact, dim, "k")) == [(2, 1)]
    assert rows(Q.check_unique(fact, ["k"])) == [(1, 2)]
    assert rows(Q.check_not_null(fact, ["k"])) == [("k", 1)]
    ready = Q.readiness(spark.createDataFrame([(1, 2.0), (None, 3.0)], "x int, y double"), "y").first()
    assert ready.ready and ready.null_features == 1 and ready.has_target
