"""Projections, filters and fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.functions import scalars as S
from marketlake.operators import project as P
from marketlake.verification.fixtures import days_as_text, widen, with_ctes
from marketlake.verification.registry import query

MONEY_SQL = "cast(replace(replace(price, '$', ''), ',', '') as float)"


@query("p01_project", "select p_partkey listing_id, p_name name, p_type room_type from part")
def p01(t):
    return P.project(t.part, {"p_partkey": "listing_id", "p_name": "name", "p_type": "room_type"})


@query(
    "p02_coerce",
    with_ctes(
        "fx_listing_raw",
        f"""select cast(id as bigint) id, try_cast(name as bigint) name, {MONEY_SQL}::double price,
                   case host_is_superhost when 't' then true when 'f' then false end host_is_superhost,
                   cast(latitude as float)::double latitude, cast(longitude as float)::double longitude,
                   cast(minimum_nights as bigint) minimum_nights from fx_listing_raw""",
    ),
)
def p02(t):
    types = {"id": "bigint", "name": "int", "price": "money", "host_is_superhost": "boolean", "latitude": "float",
             "longitude": "float", "minimum_nights": "int"}
    return widen(P.coerce(t.listing_raw, types))


@query("p03_parse_money", with_ctes("fx_listing_raw", f"select id, {MONEY_SQL}::double price from fx_listing_raw"))
def p03(t):
    return t.listing_raw.select("id", S.parse_money("price").cast("double").alias("price"))


@query("p04_require_not_null", with_ctes("fx_listing_raw", "select id, latitude, longitude from fx_listing_raw where latitude is not null and longitude is not null"))
def p04(t):
    return P.require_not_null(t.listing_raw.select("id", "latitude", "longitude"), ["latitude", "longitude"])


@query("p05_require_positive", with_ctes("fx_listing_raw", f"select id, price from fx_listing_raw where {MONEY_SQL} > 0"))
def p05(t):
    return P.require_positive(t.listing_raw.select("id", "price"), "price")


@query("p06_fill_defaults", with_ctes("fx_listing_raw", "select id, coalesce(minimum_nights, '1') minimum_nights, coalesce(price, '365') price from fx_listing_raw"))
def p06(t):
    return P.fill_defaults(t.listing_raw.select("id", "minimum_nights", "price"), {"minimum_nights": "1", "price": "365"})


_CAL_PRICED = ("fx_calendar", "fx_listing")


def _priced_calendar(t):
    listing = t.listing.select("listing_id", F.col("price").alias("listing_price"))
    return t.calendar.join(listing, "listing_id", "left")


@query(
    "p07_first_non_null",
    with_ctes(*_CAL_PRICED, """select c.listing_id, strftime(c.calendar_date, '%Y-%m-%d') calendar_date, coalesce(c.price, l.price) price
                               from fx_calendar c left join fx_listing l using (listing_id)"""),
)
def p07(t):
    return days_as_text(_priced_calendar(t).select("listing_id", "calendar_date", S.first_non_null("price", "listing_price").alias("price")))


@query(
    "p08_est_revenue",
    with_ctes("fx_calendar", """select listing_id, strftime(calendar_date, '%Y-%m-%d') calendar_date,
                                       coalesce(price * case when is_available then 1.0::double else 0.0::double end, 0.0::double) est_revenue from fx_calendar"""),
)
def p08(t):
    return days_as_text(t.calendar.select("listing_id", "calendar_date", S.est_revenue("price", "is_available").alias("est_revenue")))


@query("p09_load_date", "select o_orderkey, '2025-09-30' captured_date from orders")
def p09(t):
    return days_as_text(P.with_load_date(t.orders.select("o_orderkey"), "2025-09-30"))


@query(
    "p10_season",
    """select o_orderkey, case when month(o_orderdate) in (12, 1, 2) then 'Winter' when month(o_orderdate) in (3, 4, 5) then 'Spring'
              when month(o_orderdate) in (6, 7, 8) then 'Summer' else 'Fall' end season from orders""",
)
def p10(t):
    return t.orders.select("o_orderkey", S.season(F.month("o_orderdate")).alias("season"))


@query("p11_is_weekend", "select o_orderkey, isodow(o_orderdate) in (6, 7) is_weekend from orders")
def p11(t):
    return t.orders.select("o_orderkey", S.is_weekend(S.isodow("o_orderdate")).alias("is_weekend"))


@query(
    "p12_null_rejecting_filter",
    """select l_orderkey, l_linenumber, p_name from lineitem left join (select * from part where p_size > 10) p on p_partkey = l_partkey
       where p_partkey is not null""",
)
def p12(t):
    parts = t.part.where("p_size > 10")
    joined = t.lineitem.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    return P.require_not_null(joined, ["p_partkey"]).select("l_orderkey", "l_linenumber", "p_name")


@query("p13_drop_columns", "select p_partkey, p_type, p_size, p_retailprice from part")
def p13(t):
    return P.drop_columns(t.part, ["p_name", "p_brand", "no_such_column"])


@query("p14_numeric_only", "select p_partkey, p_size, p_retailprice, p_brand from part")
def p14(t):
    return P.numeric_only(t.part, keep=["p_brand"])


@query(
    "p15_ensure_columns",
    "select p_partkey, p_size, null::double bedrooms, 0::bigint beds, 'none' note from part",
)
def p15(t):
    df = t.part.select("p_partkey", "p_size")
    return P.ensure_columns(df, {"p_size": None, "bedrooms": None, "beds": ("bigint", 0), "note": "none"})


@query("p16_drop_null_rows", with_ctes("fx_calendar", "select listing_id, price from fx_calendar where price is not null"))
def p16(t):
    return P.drop_null_rows(t.calendar.select("listing_id", "price"), ["price"])


@query("p17_fill_nulls", with_ctes("fx_calendar", "select listing_id, minimum_nights, coalesce(price, -1)::double price from fx_calendar"))
def p17(t):
    return P.fill_nulls(t.calendar.select("listing_id", "minimum_nights", "price"), {"price": -1.0})


@query(
    "p18_fill_median",
    with_ctes("fx_calendar", """select listing_id, minimum_nights::double minimum_nights, coalesce(price, (select median(price) from fx_calendar))::double price
                                from fx_calendar"""),
)
def p18(t):
    return P.fill_median(t.calendar.select("listing_id", "minimum_nights", "price"), ["minimum_nights", "price"])


@query("p19_to_numeric", with_ctes("fx_listing_raw", "select id, try_cast(price as double) price, try_cast(latitude as double) latitude from fx_listing_raw"))
def p19(t):
    return t.listing_raw.select("id", S.to_numeric("price").alias("price"), S.to_numeric("latitude").alias("latitude"))


@query("p20_cap_filter", "select l_orderkey, l_linenumber, l_extendedprice from lineitem where l_extendedprice < 20000")
def p20(t):
    return P.cap_filter(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_extendedprice", 20000)


@query("p21_label_by_threshold", with_ctes("fx_listing_raw", "select id, case when try_cast(latitude as double) > 24 then 'A' else 'B' end market from fx_listing_raw"))
def p21(t):
    return t.listing_raw.select("id", S.label_by_threshold(S.to_numeric("latitude"), 24, "A", "B").alias("market"))


@query(
    "p22_flag_outliers",
    """select event_id, coalesce(abs(value - m) > 5 * s, false) value_outlier, coalesce(abs(value - gm) > 3 * gs, false) by_type
       from events join (select event_type et, avg(value) gm, stddev_samp(value) gs from events group by 1) on et = event_type,
            (select avg(value) m, stddev_samp(value) s from events)""",
)
def p22(t):
    flagged = P.flag_outliers(t.events.select("event_id", "event_type", "value"), ["value"], 5.0)
    grouped = P.flag_outliers(flagged.withColumnRenamed("value_outlier", "whole"), ["value"], 3.0, by="event_type")
    return grouped.select("event_id", F.col("whole").alias("value_outlier"), F.col("value_outlier").alias("by_type"))


@query("p23_filter_cities", with_ctes("fx_listing", "select listing_id, city from fx_listing where lower(city) in ('asia', 'europe')"))
def p23(t):
    return P.filter_cities(t.listing.select("listing_id", "city"), ["Asia", "EUROPE"])


@query(
    "p24_clip",
    """select c_custkey, case when c_acctbal is not null then greatest(c_acctbal, 0) end low,
              case when c_acctbal is not null then least(greatest(c_acctbal / 10000, 0), 1) end unit from customer""",
)
def p24(t):
    return t.customer.select(
        "c_custkey", S.clip("c_acctbal", lower=0.0).alias("low"), S.clip(F.col("c_acctbal") / 10000, 0.0, 1.0).alias("unit")
    )
