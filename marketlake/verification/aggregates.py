"""Aggregates, statistics and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import aggregates as A
from marketlake.operators import quality as Q
from marketlake.operators import stats as S
from marketlake.verification.fixtures import rounded, with_ctes
from marketlake.verification.registry import query

AVG2 = "((2 * sum(cast(round({0} * 100) as bigint)) + count({0})) // (2 * count({0})))::bigint / 100.0::double"


@query("a01_row_count", "select count(*) \"rows\" from lineitem")
def a01(t):
    return A.row_count(t.lineitem)


@query("a02_count_by", with_ctes("fx_review", "select listing_id, count(*) n from fx_review group by 1"))
def a02(t):
    return A.count_by(t.review, ["listing_id"])


@query("a03_count_distinct_by", "select l_suppkey, count(distinct l_partkey) n_distinct from lineitem group by 1")
def a03(t):
    return A.count_distinct_by(t.lineitem, ["l_suppkey"], "l_partkey")


@query(
    "a04_cardinality",
    with_ctes("fx_calendar", """select unnest(['listing_id', 'calendar_date', 'is_available', 'price', 'minimum_nights']) "column",
              unnest([count(distinct listing_id), count(distinct calendar_date), count(distinct is_available), count(distinct price),
                      count(distinct minimum_nights)]) cardinality from fx_calendar"""),
)
def a04(t):
    return A.cardinality(t.calendar)


@query("a05_sum_if", "select l_returnflag, sum(case when l_quantity > 25 then 1 else 0 end)::bigint large from lineitem group by 1")
def a05(t):
    return t.lineitem.groupBy("l_returnflag").agg(A.sum_if(F.col("l_quantity") > 25).cast("bigint").alias("large"))


@query("a06_rate", "select l_suppkey, sum(case when l_returnflag = 'N' then 1 else 0 end)::double / count(*) rate from lineitem group by 1")
def a06(t):
    return t.lineitem.groupBy("l_suppkey").agg(A.rate(F.col("l_returnflag") == "N").alias("rate"))


@query(
    "a07_sum_min_max",
    """select l_suppkey, sum(cast(round(l_extendedprice * 100) as bigint))::double / 100.0::double sum_l_extendedprice,
              min(l_extendedprice) min_l_extendedprice, max(l_extendedprice) max_l_extendedprice from lineitem group by 1""",
)
def a07(t):
    return A.sum_min_max(t.lineitem, ["l_suppkey"], "l_extendedprice")


@query("a08_avg_round", f"select l_partkey, {AVG2.format('l_extendedprice')} avg_price from lineitem group by 1")
def a08(t):
    return A.avg_round(t.lineitem, ["l_partkey"], "l_extendedprice", "avg_price")


@query("a09_median_by", "select l_partkey, percentile_cont(0.5) within group (order by l_extendedprice) median_price from lineitem group by 1")
def a09(t):
    return A.median_by(t.lineitem, ["l_partkey"], "l_extendedprice", "median_price")


@query(
    "a10_numeric_stats",
    """select 'l_quantity' "column", min(l_quantity) "min", max(l_quantity) "max", round(avg(l_quantity), 6) "avg", round(stddev(l_quantity), 4) stddev from lineitem
       union all select 'l_extendedprice', min(l_extendedprice), max(l_extendedprice), round(avg(l_extendedprice), 4), round(stddev(l_extendedprice), 4) from lineitem""",
)
def a10(t):
    stats = A.numeric_stats(t.lineitem, ["l_quantity", "l_extendedprice"])
    digits = F.when(F.col("column") == "l_quantity", F.round("avg", 6)).otherwise(F.round("avg", 4))
    return stats.withColumns({"avg": digits, "stddev": F.round("stddev", 4)})


@query(
    "a11_null_stats",
    with_ctes("fx_listing_raw", """select unnest(['price', 'latitude', 'minimum_nights']) "column",
              unnest([count(*) - count(price), count(*) - count(latitude), count(*) - count(minimum_nights)]) null_count,
              unnest([(count(*) - count(price)) / count(*), (count(*) - count(latitude)) / count(*), (count(*) - count(minimum_nights)) / count(*)]) null_rate
              from fx_listing_raw"""),
)
def a11(t):
    return A.null_stats(t.listing_raw, ["price", "latitude", "minimum_nights"])


@query("a12_distinct_rows", "select distinct l_partkey, l_suppkey from lineitem")
def a12(t):
    return A.distinct_rows(t.lineitem, ["l_partkey", "l_suppkey"])


@query(
    "a13_centroids",
    with_ctes("fx_listing", """select neighbourhood, neighbourhood_group, avg(latitude) centroid_lat, avg(longitude) centroid_lon
              from (select distinct neighbourhood, neighbourhood_group, latitude, longitude from fx_listing) group by 1, 2"""),
)
def a13(t):
    return A.centroids(t.listing, ["neighbourhood", "neighbourhood_group"])


@query(
    "a14_global_mean",
    with_ctes("fx_listing", """select avg(latitude) latitude, avg(longitude) longitude, avg(nullif(beds, 0)) beds_nonzero from fx_listing"""),
)
def a14(t):
    plain = A.global_mean(t.listing, ["latitude", "longitude"])
    beds = A.global_mean(t.listing.withColumnRenamed("beds", "beds_nonzero"), ["beds_nonzero"], zero_is_null=True).scalar()
    return plain.withColumn("beds_nonzero", beds)


@query(
    "a15_percent_of",
    """select l_suppkey, ((2 * 10000 * sum(case when l_returnflag = 'N' then 1 else 0 end) + count(distinct l_partkey))
              // (2 * count(distinct l_partkey)))::bigint / 100.0::double pct from lineitem group by 1""",
)
def a15(t):
    return A.percent_of(t.lineitem, ["l_suppkey"], F.col("l_returnflag") == "N", "l_partkey")


@query("a16_value_counts", "select p_type, count(*) n, count(*) * 100.0::double / (select count(*) from part) pct from part group by 1")
def a16(t):
    return A.value_counts(t.part, "p_type", normalize=True)


def _describe_sql(cols):
    return " union all ".join(
        f"""select '{c}' "column", count({c}) "count", round(avg({c}), 4) mean, round(stddev({c}), 4) std, min({c})::double "min",
                   percentile_cont(0.25) within group (order by {c}::double) p25, percentile_cont(0.5) within group (order by {c}::double) p50,
                   percentile_cont(0.75) within group (order by {c}::double) p75, max({c})::double "max" from fx_calendar"""
        for c in cols
    )


@query("a17_describe", with_ctes("fx_calendar", _describe_sql(["price", "minimum_nights"])))
def a17(t):
    return rounded(A.describe(t.calendar, ["price", "minimum_nights"]), 4, "mean", "std")


@query("a18_null_counts", with_ctes("fx_listing_raw", "select count(*) - count(price) price, count(*) - count(latitude) latitude from fx_listing_raw"))
def a18(t):
    return A.null_counts(t.listing_raw, ["price", "latitude"])


@query(
    "a19_group_listing_level",
    """select o_custkey, o_orderstatus, o_orderpriority, year(o_orderdate) "year", median(o_totalprice) median_price, count(*) orders
       from orders group by 1, 2, 3, 4""",
)
def a19(t):
    df = t.orders.withColumn("year", F.year("o_orderdate").cast("bigint"))
    return A.group_listing_level(
        df, ["o_custkey", "o_orderstatus", "o_orderpriority", "year"],
        [F.count(F.lit(1)).alias("orders")], {"median_price": "o_totalprice"},
    )


@query(
    "a20_group_market",
    f"""select p_brand, p_type, l_returnflag, count(distinct l_partkey) parts, {AVG2.format('l_extendedprice')} avg_price, max(l_extendedprice) max_price
        from lineitem join part on p_partkey = l_partkey group by 1, 2, 3""",
)
def a20(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return A.group_market(
        joined, ["p_brand", "p_type", "l_returnflag"],
        [F.countDistinct("l_partkey").alias("parts"), A.mean_money("l_extendedprice").alias("avg_price"), F.max("l_extendedprice").alias("max_price")],
    )


_RUN_METRICS = """select l_suppkey run_id, sum(cast(round(abs(l_extendedprice - l_quantity * 1500) * 100) as bigint))::double / count(*) mae
                  from lineitem group by 1"""


def _runs(t):
    err = F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1500)
    return t.lineitem.groupBy(F.col("l_suppkey").alias("run_id")).agg(
        (F.sum(F.round(err * 100).cast("bigint")).cast("double") / F.count(F.lit(1))).alias("mae")
    )


@query("a21_argmin", f"select run_id, mae from ({_RUN_METRICS}) order by mae, run_id limit 1")
def a21(t):
    return S.argmin(_runs(t), "mae", "run_id")


_ERR = "(l_extendedprice - l_quantity * 1500)"


def _metrics_sql(by: str) -> str:
    return f"""select {by} fold, avg(abs({_ERR})) mae, sqrt(avg({_ERR} ** 2)) rmse,
                      case when min(abs(l_extendedprice)) > 0 then avg(abs({_ERR} / l_extendedprice)) * 100 end mape,
                      1 - sum({_ERR} ** 2) / (var_pop(l_extendedprice) * count(*)) r2
               from lineitem where l_extendedprice is not null and l_quantity is not null group by 1"""


def _predicted(t):
    return t.lineitem.select(
        F.col("l_linenumber").alias("fold"), F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("yhat")
    )


@query(
    "a22_mean_over_folds",
    f"select round(avg(mae), 4) mae, round(avg(rmse), 4) rmse, round(avg(mape), 4) mape, round(avg(r2), 6) r2 from ({_metrics_sql('l_linenumber')})",
)
def a22(t):
    mean = S.mean_over_folds(S.regression_metrics(_predicted(t), "y", "yhat", ["fold"]))
    return rounded(rounded(mean, 4, "mae", "rmse", "mape"), 6, "r2")


@query(
    "a23_regression_metrics",
    f"select fold, round(mae, 4) mae, round(rmse, 4) rmse, round(mape, 4) mape, round(r2, 6) r2 from ({_metrics_sql('l_linenumber')})",
)
def a23(t):
    metrics = S.regression_metrics(_predicted(t), "y", "yhat", ["fold"])
    return rounded(rounded(metrics, 4, "mae", "rmse", "mape"), 6, "r2")


def _p_sql(t: str, df: str) -> str:
    """Two-sided p-value: one less twice the area of Student's density up to t, by Simpson's rule in 20,000 steps."""
    density = f"exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2) - ln({df} * pi()) / 2 - ({df} + 1) / 2 * ln(1 + (abs({t}) * i / 20000) ** 2 / {df}))"
    weight = "case when i in (0, 20000) then 1 when i % 2 = 1 then 4 else 2 end"
    return f"(select round(1 - 2 * abs({t}) / 60000 * sum({weight} * {density}), 6) from range(20001) steps(i))"


def _pearson_sql(x: str, y: str) -> str:
    return f"""with g as (select *, r * sqrt(n - 2) / sqrt(1 - r * r) t_value, (n - 2)::double freedom from
         (select count(*) n, corr({x}, {y}) r from lineitem where {x} is not null and {y} is not null))
       select n, round(r, 6) r, round(t_value, 4) t, {_p_sql('t_value', 'freedom')} p_value from g"""


@query("a24_pearson", _pearson_sql("l_quantity", "l_extendedprice"))
def a24(t):
    return rounded(rounded(S.pearson(t.lineitem, "l_quantity", "l_extendedprice"), 6, "r", "p_value"), 4, "t")


@query("a24_pearson_unrelated", _pearson_sql("l_discount", "l_extendedprice"))
def a24_unrelated(t):
    return rounded(rounded(S.pearson(t.lineitem, "l_discount", "l_extendedprice"), 6, "r", "p_value"), 4, "t")


@query(
    "a25_two_sample",
    f"""with g as (select *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) t_value,
                         (var_a / n_a + var_b / n_b) ** 2 / ((var_a / n_a) ** 2 / (n_a - 1) + (var_b / n_b) ** 2 / (n_b - 1)) freedom
                  from (select count(l_extendedprice) filter (l_returnflag = 'A') n_a, count(l_extendedprice) filter (l_returnflag = 'R') n_b,
                         avg(l_extendedprice) filter (l_returnflag = 'A') mean_a, avg(l_extendedprice) filter (l_returnflag = 'R') mean_b,
                         var_samp(l_extendedprice) filter (l_returnflag = 'A') var_a, var_samp(l_extendedprice) filter (l_returnflag = 'R') var_b from lineitem))
       select n_a, n_b, round(mean_a, 4) mean_a, round(mean_b, 4) mean_b, round(mean_a - mean_b, 4) difference,
              round((mean_a - mean_b) * 100 / mean_b, 4) difference_pct, round(t_value, 6) t, round(freedom, 3) df, {_p_sql('t_value', 'freedom')} p_value,
              round((mean_a - mean_b) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2)), 6) cohens_d from g""",
)
def a25(t):
    test = S.two_sample(t.lineitem, "l_extendedprice", "l_returnflag", "A", "R")
    return rounded(rounded(rounded(test, 4, "mean_a", "mean_b", "difference", "difference_pct"), 6, "t", "cohens_d", "p_value"), 3, "df")


@query(
    "a26_market_comparison",
    with_ctes(
        "dataset",
        f"""select market, count(*) listings, {AVG2.format('target_price')} mean_price, median(target_price) median_price,
                  {AVG2.format('cheap')} mean_price_capped, round(avg(accommodates), 6) mean_accommodates, round(avg(bedrooms), 6) mean_bedrooms,
                  round(avg(beds), 6) mean_beds, round(avg(is_superhost::int) * 100, 6) superhost_pct, round(avg(availability_rate) * 100, 6) availability_pct
           from (select *, case when latitude > 0 then 'north' else 'south' end market, case when target_price < 30000 then target_price end cheap
                 from dataset where target_price is not null) group by 1""",
    ),
)
def a26(t):
    from marketlake.plans.dataset import label_market

    table = S.market_comparison(label_market(t.dataset, 0, "north", "south"), "market", cap=30000)
    return rounded(table, 6, "mean_accommodates", "mean_bedrooms", "mean_beds", "superhost_pct", "availability_pct")


# --- quality --------------------------------------------------------------------------------------------------


def _profile_sql(table: str, relation: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for i, (c, kind) in enumerate(columns):
        if kind in ("string", "boolean", "date"):
            stats = "null::double \"min\", null::double \"max\", null::double \"avg\", null::double stddev"
        else:
            stats = f"min({c})::double \"min\", max({c})::double \"max\", round(avg({c}), 4) \"avg\", round(stddev({c}), 4) stddev"
        parts.append(
            f"""select '{table}' "table", count(*) total_rows, {i + 1} "position", '{c}' "column", '{kind}' "type", count(*) - count({c}) null_count,
                       (count(*) - count({c})) / count(*) null_rate, count(distinct {c}) cardinality, {stats} from {relation}"""
        )
    return " union all ".join(parts)


_CALENDAR_COLUMNS = [("listing_id", "bigint"), ("calendar_date", "date"), ("is_available", "boolean"), ("price", "double"), ("minimum_nights", "int")]
_PART_COLUMNS = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")]


@query("q01_profile", with_ctes("fx_calendar", _profile_sql("calendar", "fx_calendar", _CALENDAR_COLUMNS)))
def q01(t):
    return rounded(Q.profile(t.calendar, "calendar"), 4, "avg", "stddev")


@query(
    "q02_validate",
    with_ctes("fx_listing_raw", """select 'raw' "table", issue from (
        select unnest([(count(*) - count(price)) / count(*), (count(*) - count(host_is_superhost)) / count(*), (count(*) - count(minimum_nights)) / count(*)]) r,
               unnest(['price', 'host_is_superhost', 'minimum_nights']) c,
               'Column ' || c || ' has null rate ' || format('{:.2f}', r * 100) || '% (max: 10.00%)' issue from fx_listing_raw) where r > 0.1
        union all select 'raw', 'Table has only ' || count(*) || ' rows (min: 1000000000)' from fx_listing_raw"""),
)
def q02(t):
    return Q.validate(Q.profile(t.listing_raw, "raw"), min_rows=1_000_000_000, max_null_fraction=0.1).drop("position")


@query(
    "q03_profile_many",
    with_ctes("fx_calendar", _profile_sql("calendar", "fx_calendar", _CALENDAR_COLUMNS) + " union all " + _profile_sql("part", "part", _PART_COLUMNS)),
)
def q03(t):
    return rounded(Q.profile_many({"calendar": t.calendar, "part": t.part}), 4, "avg", "stddev")


@query("q04_check_unique", "select l_orderkey, l_linenumber, count(*) copies from lineitem group by 1, 2 having count(*) > 1")
def q04(t):
    return Q.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "q05_check_fk",
    "select l_partkey, count(*) orphans from lineitem where l_partkey not in (select p_partkey from part where p_size > 25) group by 1",
)
def q05(t):
    parts = t.part.where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"))
    return Q.check_fk(t.lineitem, parts, "l_partkey")


@query(
    "q06_check_not_null",
    with_ctes("fx_calendar", """select unnest(['listing_id', 'calendar_date', 'price']) "column",
              unnest([count(*) - count(listing_id), count(*) - count(calendar_date), count(*) - count(price)]) nulls from fx_calendar"""),
)
def q06(t):
    return Q.check_not_null(t.calendar, ["listing_id", "calendar_date", "price"])


@query(
    "q07_readiness",
    """select true has_target, 'p_brand,p_name,p_type' non_numeric, count(*) "rows", count(*) - count(p_retailprice) null_targets,
              0::bigint null_features, false ready from part""",
)
def q07(t):
    return Q.readiness(t.part, "p_retailprice")


@query(
    "q08_leak_check",
    """select f feature, round(r, 6) r, coalesce(abs(r) > 0.95, false) leaks from (
         select unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_discount', 'l_tax']) f,
                unnest([corr(l_orderkey, l_extendedprice), corr(l_partkey, l_extendedprice), corr(l_suppkey, l_extendedprice),
                        corr(l_linenumber, l_extendedprice), corr(l_quantity, l_extendedprice), corr(l_discount, l_extendedprice),
                        corr(l_tax, l_extendedprice)]) r from lineitem)""",
)
def q08(t):
    return rounded(Q.leak_check(t.lineitem, "l_extendedprice", 0.95), 6, "r")
