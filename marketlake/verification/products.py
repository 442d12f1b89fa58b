"""Named data products: clean tables, star, marts, dataset, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.functions import text as X
from marketlake.plans import features as FT
from marketlake.plans import gold, marts, silver
from marketlake.session import scratch_path
from marketlake.verification.aggregates import AVG2
from marketlake.verification.fixtures import rounded, widen, with_ctes
from marketlake.verification.registry import query
from marketlake.verification.scalars import HAVERSINE


def _money(x):
    """Money text as the raw files show it."""
    return F.concat(F.lit("$"), F.format_number(x, 2))


def _raw_listings(t):
    """The listings as raw text with some gaps."""
    l = t.listing
    text = {"listing_id": "id", "host_id": "host_id", "host_since": "host_since", "host_listings_count": "host_listings_count",
            "latitude": "latitude", "longitude": "longitude", "accommodates": "accommodates", "bedrooms": "bedrooms", "beds": "beds"}
    return l.select(
        *[F.col(c).cast("string").alias(n) for c, n in text.items()],
        "name", "host_name", F.when(F.col("is_superhost"), "t").when(~F.col("is_superhost"), "f").alias("host_is_superhost"),
        F.col("neighbourhood").alias("neighbourhood_cleansed"), F.col("neighbourhood_group").alias("neighbourhood_group_cleansed"),
        "room_type", "property_type",
        F.when(F.col("beds") == 6, None).when(F.col("beds") == 5, "$0.00").otherwise(_money(F.col("price") * 3)).alias("price"),
        F.lit("2").alias("minimum_nights"), F.lit("7").alias("number_of_reviews"), F.lit("4.5").alias("review_scores_rating"),
        F.lit("t").alias("instant_bookable"), "city",
    )


@query(
    "d01_clean_listings",
    with_ctes("fx_listing", """select listing_id, name, host_id, host_name, strftime(host_since, '%Y-%m-%d') host_since, host_listings_count, is_superhost,
              neighbourhood, neighbourhood_group, latitude, longitude, room_type, property_type, accommodates, bedrooms, beds,
              cast(round(price * 3, 2) as float)::double price, 2 minimum_nights, 7 number_of_reviews, 4.5::double review_scores_rating, 't' instant_bookable,
              city, '2025-09-30' captured_date from fx_listing where beds < 5"""),
)
def d01(t):
    clean = silver.clean_listings(_raw_listings(t), "2025-09-30")
    return widen(silver.write_clean(clean, silver.LISTINGS, scratch_path(t.spark, "d01")))


@query(
    "d02_clean_calendar",
    with_ctes("fx_calendar", """select listing_id, strftime(calendar_date, '%Y-%m-%d') calendar_date, is_available, cast(price as float)::double price,
              coalesce(case when minimum_nights > 1 then minimum_nights end, 1) minimum_nights, 365 maximum_nights from fx_calendar"""),
)
def d02(t):
    raw = t.calendar.select(
        F.col("listing_id").cast("string").alias("listing_id"), F.date_format("calendar_date", "yyyy-MM-dd").alias("date"),
        F.when(F.col("is_available"), "t").otherwise("f").alias("available"), _money(F.col("price")).alias("price"),
        F.when(F.col("minimum_nights") > 1, F.col("minimum_nights").cast("string")).otherwise("").alias("minimum_nights"),
        F.lit(None).cast("string").alias("maximum_nights"),
    )
    return widen(silver.write_clean(silver.clean_calendar(raw), silver.CALENDAR, scratch_path(t.spark, "d02")))


@query(
    "d03_clean_reviews",
    with_ctes("fx_review", """select listing_id, review_id, reviewer_id, 'guest ' || reviewer_id reviewer_name, strftime(review_date, '%Y-%m-%d') review_date, comments
              from fx_review where comments <> 'error'"""),
)
def d03(t):
    date = F.when(F.col("comments") == "error", None).otherwise(F.date_format("review_date", "yyyy-MM-dd"))
    raw = t.review.select(
        F.col("listing_id").cast("string").alias("listing_id"), F.col("review_id").cast("string").alias("id"),
        F.col("reviewer_id").cast("string").alias("reviewer_id"), F.concat(F.lit("guest "), "reviewer_id").alias("reviewer_name"),
        date.alias("date"), "comments",
    )
    return widen(silver.write_clean(silver.clean_reviews(raw), silver.REVIEWS, scratch_path(t.spark, "d03")))


@query(
    "d04_clean_listings_summary",
    with_ctes("fx_listing", """select listing_id, name, host_id, host_name, neighbourhood_group, neighbourhood, latitude, longitude, room_type,
              cast(price as float)::double price, 3 minimum_nights, 9 number_of_reviews, case when beds > 3 then '2025-01-31' end last_review,
              0.25::double reviews_per_month, 2 calculated_host_listings_count, 100 availability_365, 1 number_of_reviews_ltm, null::varchar license from fx_listing"""),
)
def d04(t):
    fixed = {"minimum_nights": "3", "number_of_reviews": "9.0", "reviews_per_month": "0.25", "calculated_host_listings_count": "2",
             "availability_365": "100", "number_of_reviews_ltm": "1", "license": ""}
    raw = t.listing.select(
        F.col("listing_id").cast("string").alias("id"), "name", F.col("host_id").cast("string").alias("host_id"), "host_name",
        "neighbourhood_group", "neighbourhood", F.col("latitude").cast("string").alias("latitude"), F.col("longitude").cast("string").alias("longitude"),
        "room_type", F.col("price").cast("string").alias("price"), F.when(F.col("beds") > 3, "2025-01-31").otherwise("never").alias("last_review"),
        *[F.lit(v).alias(c) for c, v in fixed.items()],
    )
    return widen(silver.write_clean(silver.clean_listings_summary(raw), silver.LISTINGS_SUMMARY, scratch_path(t.spark, "d04")))


@query(
    "d05_clean_reviews_summary",
    with_ctes("fx_review", "select listing_id, strftime(review_date, '%Y-%m-%d') review_date from fx_review where comments <> 'view'"),
)
def d05(t):
    listing = F.when(F.col("comments") == "view", "").otherwise(F.col("listing_id").cast("string"))
    raw = t.review.select(listing.alias("listing_id"), F.date_format("review_date", "yyyy-MM-dd").alias("date"))
    return widen(silver.write_clean(silver.clean_reviews_summary(raw), silver.REVIEWS_SUMMARY, scratch_path(t.spark, "d05")))


@query(
    "d06_clean_neighbourhoods",
    "select nullif(c_mktsegment, 'BUILDING') neighbourhood_group, c_name neighbourhood from customer",
)
def d06(t):
    group = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    raw = t.customer.select(group.alias("neighbourhood_group"), F.col("c_name").alias("neighbourhood"))
    return silver.write_clean(silver.clean_neighbourhoods(raw), silver.NEIGHBOURHOODS, scratch_path(t.spark, "d06"))


# --- star -----------------------------------------------------------------------------------------------------


@query(
    "d08_dim_calendar",
    with_ctes("dim_date", """select date_key, strftime(full_date, '%Y-%m-%d') full_date, "year", "month", day_of_week, is_weekend, season from dim_date"""),
)
def d08(t):
    first, last = t.lineitem.agg(F.min(F.to_date("l_shipdate")), F.max(F.to_date("l_shipdate"))).first()
    return widen(gold.dim_calendar(t.spark, str(first), str(last)))


@query("d09_dim_listings", with_ctes("dim_listing", "select * from dim_listing"))
def d09(t):
    return widen(gold.dim_listings(t.staged_listing))


@query(
    "d10_dim_hosts",
    with_ctes("dim_host", "select host_key, host_id, host_name, is_superhost, strftime(host_since, '%Y-%m-%d') host_since, host_listings_count from dim_host"),
)
def d10(t):
    return widen(gold.dim_hosts(t.staged_listing))


@query(
    "d11_dim_neighbourhoods",
    with_ctes("dim_area", """select neighbourhood_key, neighbourhood, neighbourhood_group, centroid_lat, centroid_lon from dim_area"""),
)
def d11(t):
    return gold.dim_neighbourhoods(t.staged_listing)


_FACT_ORDER = "listing_key, date_key nulls last, host_key nulls last, neighbourhood_key nulls last, price, is_available, minimum_nights, est_revenue, reviews_to_date"


@query("d12_fact_daily", with_ctes("fact", f"select row_number() over (order by {_FACT_ORDER}) fact_id, * from fact"))
def d12(t):
    return widen(gold.fact_daily(t.calendar, t.staged_listing, t.review, t.dims, t.dates))


@query(
    "d12_fact_as_of",
    with_ctes("fx_calendar", "known_listing", "dim_date", """
        select listing_key, host_key, neighbourhood_key, date_key, coalesce(c.price, asking) price, is_available, minimum_nights,
               if(is_available, coalesce(c.price, asking, 0), 0) est_revenue, coalesce(so_far, 0)::bigint reviews_to_date
        from fx_calendar c join known_listing using (listing_id) join dim_date on full_date = calendar_date
        asof left join (select listing_id rated, review_date, sum(count(*)) over (partition by listing_id order by review_date) so_far
                        from fx_review group by listing_id, review_date) on rated = c.listing_id and review_date <= calendar_date"""),
)
def d12_as_of(t):
    return widen(gold.fact_daily(t.calendar, t.staged_listing, t.review, t.dims, t.dates, with_id=False, as_of=True))


@query("d13_conform", with_ctes("conf_fact", f"select row_number() over (order by {_FACT_ORDER}) fact_id, * from conf_fact"))
def d13(t):
    star = gold.conform(t.brand_listing, t.brand_calendar, t.brand_review, t.dates)
    return widen(star["fact"])


_MEDIAN2 = "floor(median(cast(round(price * 100) as bigint)) + 0.5)::double / 100.0::double"
_REVENUE = "sum(cast(round(est_revenue * 100) as bigint))::double / 100.0::double"
_AVAILABLE = "count_if(is_available)::bigint"
_REVIEWS = "sum(reviews_to_date)::bigint total_reviews"

# Each mart sums by the keys of its groups first and looks the attributes up afterwards.
_SNAPSHOT = with_ctes("typed_fact", f"""
    select strftime(full_date, '%Y-%m-%d') full_date, year, month, season, neighbourhood, neighbourhood_group, g.* exclude (date_key, neighbourhood_key)
    from (select date_key, neighbourhood_key, room_type, property_type, count(distinct listing_key) active_listings, {_AVAILABLE} available_count,
                 {AVG2.format('price')} avg_price, {_MEDIAN2} median_price, min(price) min_price, max(price) max_price,
                 {_REVENUE} total_estimated_revenue, {_REVIEWS} from typed_fact group by all) g
    join dim_area using (neighbourhood_key) join dim_date using (date_key)""")
_HOSTS = with_ctes("fact", f"""
    select * replace (strftime(host_since, '%Y-%m-%d') as host_since)
    from (select host_id, host_name, is_superhost, host_since, host_listings_count, count(distinct listing_key) active_listings,
                 {AVG2.format('price')} avg_price, {_AVAILABLE} total_available_days, {_REVENUE} total_estimated_revenue, {_REVIEWS}
          from dim_host join fact using (host_key) group by all)""")
_TRENDS = with_ctes("fact", f"""
    select neighbourhood, neighbourhood_group, strftime(full_date, '%Y-%m-%d') full_date, listing_count, avg_price, available_count,
           ((20000 * available_count + listing_count) // (2 * listing_count))::bigint / 100.0::double availability_rate
    from (select neighbourhood_key, date_key, count(distinct listing_key) listing_count, {AVG2.format('price')} avg_price,
                 {_AVAILABLE} available_count from fact group by all)
    join dim_date using (date_key) join dim_area using (neighbourhood_key)""")


@query("d14_daily_market_snapshot", _SNAPSHOT)
def d14(t):
    return widen(marts.daily_market_snapshot(t.fact, t.dims))


@query("d15_host_performance", _HOSTS)
def d15(t):
    return widen(marts.host_performance(t.fact, t.dims["hosts"]))


@query("d16_neighbourhood_trends", _TRENDS)
def d16(t):
    return widen(marts.neighbourhood_trends(t.fact, t.dims))


def _view(t, name):
    marts.register_marts(t.fact, t.dims)
    return widen(t.spark.table(name))


@query("s13_register_views", _HOSTS)
def s13(t):
    return _view(t, "v_host_performance")


@query("s13_view_snapshot", _SNAPSHOT)
def s13_snapshot(t):
    return _view(t, "v_daily_market_snapshot")


@query("s13_view_trends", _TRENDS)
def s13_trends(t):
    return _view(t, "v_neighbourhood_trends")


@query(
    "d17_daily_market_summary",
    with_ctes("fact", f"""select date_key, neighbourhood_key, count(distinct listing_key) total_listings, {_AVAILABLE} available_count,
              {AVG2.format('price')} avg_price, {_MEDIAN2} median_price, {_REVIEWS} from fact group by all"""),
)
def d17(t):
    return marts.daily_market_summary(t.fact)


@query(
    "d18_listing_dataset",
    with_ctes("dataset", "select * replace (strftime(host_since, '%Y-%m-%d') as host_since) from dataset"),
)
def d18(t):
    return widen(t.dataset)


# --- features -------------------------------------------------------------------------------------------------


def _features_sql(polar=False, relative=False, missing=None, words=None):
    flags = words or {X.flag_name(w): f"contains(lower(coalesce(name, '')), '{w}')::int" for w in X.NAME_KEYWORDS}
    cat = {c: (f"coalesce({c}, '{missing}')" if missing else c) for c in FT.CATEGORIES}
    over = "::double / count(*) over ()" if relative else "::double"
    n = "count(*) over (partition by {})" + over
    freqs = {f"{c}_freq": n.format(e) for c, e in cat.items()}
    freqs |= {name: n.format(", ".join(cat[c] for c in pair)) for name, pair in FT.PAIRS.items()}
    ratio = "coalesce(case when {1} <> 0 then {0} / {1} end, 0)"
    values = {
        "listing_id": "listing_id",
        "accommodates": "accommodates", "bedrooms": "bedrooms", "beds": "beds", "latitude": "latitude", "longitude": "longitude",
        "is_superhost": "coalesce(is_superhost::int, 0)::double", "host_listings_count": "host_listings_count::double",
        "avg_price": "avg_price", "availability_rate": "availability_rate", "est_revenue": "est_revenue",
        "total_reviews": "total_reviews::double", "host_tenure_days": "host_tenure_days::double", "target_price": "target_price",
        **flags,
        "name_len_chars": "length(coalesce(name, ''))",
        "name_len_words": "len(list_filter(regexp_split_to_array(coalesce(name, ''), '\\s+'), lambda w: w <> ''))::double",
        "name_kw_count": " + ".join(flags.values()),
        "dist_centroid_haversine": f"round({HAVERSINE}, 5)",
        "dist_centroid_euclidean": "sqrt((latitude - clat) * (latitude - clat) + (longitude - clon) * (longitude - clon))",
        "beds_per_bedroom": ratio.format("beds", "bedrooms"), "accommodates_per_bed": ratio.format("accommodates", "beds"),
        "accommodates_per_bedroom": ratio.format("accommodates", "bedrooms"), "beds_per_accommodate": ratio.format("beds", "accommodates"),
        "host_tenure_years": "host_tenure_days / 365.0::double",
        "host_listings_log1p": "round(ln(1 + greatest(host_listings_count, 0)::double), 9)",
        "revenue_per_review": "est_revenue / (total_reviews + 1.0::double)",
        "revenue_per_available_day": "est_revenue / (availability_rate * 365.0::double + 1.0::double)",
        "reviews_per_year_proxy": "total_reviews / (host_tenure_days / 365.0::double + 0.1::double)",
        **freqs,
    }
    if polar:
        values |= {"rel_lat": "latitude - clat", "rel_lon": "longitude - clon",
                   "dist_radial": values["dist_centroid_euclidean"], "angle_radial": "round(atan2(latitude - clat, longitude - clon), 6)"}
    return values


def _comparable(df):
    """Only results of transcendental functions are rounded; quotients and roots agree to the last digit."""
    df = rounded(rounded(df, 5, "dist_centroid_haversine"), 9, "host_listings_log1p")
    return widen(rounded(df, 6, "angle_radial") if "angle_radial" in df.columns else df)


def _select(values):
    listing = ", ".join(f'{e} "{c}"' for c, e in values.items())
    return f"select {listing} from dataset, (select avg(latitude) clat, avg(longitude) clon from dataset)"


@query("d19_listing_features", with_ctes("dataset", _select(_features_sql())))
def d19(t):
    return _comparable(FT.listing_features(t.dataset, keep=["listing_id"]))


def _variant_sql():
    syn = {n: "(" + " or ".join(f"contains(lower(coalesce(name, '')), '{s}')" for s in g) + ")::int" for n, g in X.NAME_SYNONYMS.items()}
    values = _features_sql(polar=True, relative=True, missing="NA", words=syn)
    for c in FT.CATEGORIES:
        values[f"{c}_code"] = f"dense_rank() over (order by coalesce({c}, 'NA')) - 1"
    for kind in ("LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"):
        values[f"room_{kind}"] = f"(room_type = '{kind}')::int"
    return values


@query("d20_feature_variants", with_ctes("dataset", _select(_variant_sql())))
def d20(t):
    df = FT.listing_features(t.dataset, names="synonyms", polar=True, relative_freq=True, missing="NA", codes=True, one_hot_room=True, keep=["listing_id"])
    return _comparable(df)


@query("g01_feature_program", with_ctes("dataset", "select listing_id, accommodates * 2 double_room, target_price from dataset"))
def g01(t):
    def program(df):
        return df.select("listing_id", (F.col("accommodates") * 2).alias("double_room"), "target_price")

    return FT.apply_program(t.dataset, program)


@query("g02_row_label", with_ctes("dataset", "select listing_id, case when latitude > 44 then 'A' else 'B' end market from dataset"))
def g02(t):
    from marketlake.plans.dataset import label_market

    return label_market(t.dataset, 44, "A", "B").select("listing_id", "market")
