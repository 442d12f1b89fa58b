"""Joins, windows, order and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import encode as E
from marketlake.operators import joins as J
from marketlake.operators import keys as K
from marketlake.operators import order as O
from marketlake.operators import sets as U
from marketlake.operators.aggregates import count_by
from marketlake.operators.project import keep_with_target
from marketlake.operators.quality import profile_many, validate
from marketlake.plans import gold
from marketlake.plans.marts import host_performance
from marketlake.session import scratch_path, stage
from marketlake.sources.writers import write_sorted
from marketlake.verification.fixtures import days_as_text, with_ctes
from marketlake.verification.registry import query


@query(
    "j01_left_join",
    with_ctes("fx_calendar", "fx_listing", """select c.listing_id, strftime(c.calendar_date, '%Y-%m-%d') calendar_date, l.name, l.host_id
                                              from fx_calendar c left join fx_listing l using (listing_id)"""),
)
def j01(t):
    listings = t.listing.select("listing_id", "name", "host_id")
    return days_as_text(J.left_join(t.calendar.select("listing_id", "calendar_date"), listings, "listing_id"))


@query(
    "j02_lookup_key",
    with_ctes("dim_host", "dim_area", "fx_listing", """select l.listing_id, h.host_key, a.neighbourhood_key from fx_listing l
              left join dim_host h on l.host_id = h.host_id left join dim_area a on l.neighbourhood = a.neighbourhood"""),
)
def j02(t):
    keyed = J.lookup_key(t.staged_listing, t.dims["hosts"], "host_id", "host_key")
    return J.lookup_key(keyed, t.dims["neighbourhoods"], "neighbourhood", "neighbourhood_key").select(
        "listing_id", "host_key", "neighbourhood_key"
    )


@query(
    "j03_lookup_date_key",
    with_ctes("dim_date", "select o_orderkey, date_key from orders left join dim_date on cast(o_orderdate as date) = full_date"),
)
def j03(t):
    return J.lookup_date_key(t.orders, t.dates, "o_orderdate").select("o_orderkey", "date_key")


@query(
    "j04_left_join_counts",
    with_ctes("fx_listing", "fx_review", """select listing_id, coalesce(n, 0) review_count from fx_listing
              left join (select listing_id, count(*) n from fx_review group by 1) using (listing_id)"""),
)
def j04(t):
    return J.left_join_counts(t.listing.select("listing_id"), t.review, "listing_id", "review_count")


@query(
    "j05_star_join",
    """select l_orderkey, l_linenumber, p_brand, s_name, o_orderpriority from lineitem join part on l_partkey = p_partkey
       join supplier on l_suppkey = s_suppkey join orders on l_orderkey = o_orderkey""",
)
def j05(t):
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    dims = [
        (t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"),
        (t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey"),
        (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey"),
    ]
    return J.star_join(fact, dims).select("l_orderkey", "l_linenumber", "p_brand", "s_name", "o_orderpriority")


@query(
    "j06_remap_keys",
    with_ctes(
        "city_dim_host", "conf_dim_host", "brand_listing",
        """select l.city, l.listing_id, n.host_key from brand_listing l
           join city_dim_host o on l.host_id = o.host_id and l.city = o.city join conf_dim_host n on o.host_id = n.host_id""",
    ),
)
def j06(t):
    city_hosts = stage(gold.dim_hosts(t.brand_listing, "city"), "city-hosts")
    hosts = U.conform_dim(city_hosts, ["host_id"], "host_key", ["host_id"])
    keyed = t.brand_listing.join(city_hosts.select("city", "host_id", "host_key"), ["city", "host_id"])
    return J.remap_keys(keyed.select("city", "listing_id", "host_key"), city_hosts, hosts, ["host_id"], "host_key", by="city")


@query(
    "j07_coalesce_eq",
    with_ctes("fx_listing", """select a.listing_id, count(*) matches from fx_listing a
              join (select distinct neighbourhood, neighbourhood_group from fx_listing) b
                on a.neighbourhood = b.neighbourhood and coalesce(a.neighbourhood_group, '') = coalesce(b.neighbourhood_group, '')
              group by 1"""),
)
def j07(t):
    areas = t.listing.select(F.col("neighbourhood").alias("n"), F.col("neighbourhood_group").alias("g")).distinct()
    same = (F.col("neighbourhood") == F.col("n")) & J.coalesce_eq("neighbourhood_group", "g")
    return t.listing.join(areas, same).groupBy("listing_id").agg(F.count(F.lit(1)).alias("matches"))


@query(
    "j08_skip_known",
    """select doc_id, sha256(text) sha256, coalesce(sha256(text) in (select sha256(text) from documents where lang = 'fr' and text is not null), false) known from documents""",
)
def j08(t):
    files = t.documents.select("doc_id", F.sha2("text", 256).alias("sha256"))
    known = t.documents.where("lang = 'fr'").select(F.sha2("text", 256).alias("sha256"))
    fresh = J.skip_known(files, known).withColumn("known", F.lit(False))
    return fresh.unionByName(J.only_known(files, known).withColumn("known", F.lit(True)))


@query(
    "j09_map_values",
    with_ctes("fx_listing", """select listing_id, neighbourhood_group, n from fx_listing
              join (select neighbourhood_group g, count(*) n from fx_listing group by 1) on g is not distinct from neighbourhood_group"""),
)
def j09(t):
    counts = count_by(t.listing, ["neighbourhood_group"])
    return J.map_values(t.listing.select("listing_id", "neighbourhood_group"), "neighbourhood_group", counts, "n", "n")


@query("j10_fan_out_guard", "select name, count(*) copies from (select p_name name from part) group by 1 having count(*) > 1")
def j10(t):
    names = t.part.select(F.col("p_name").alias("name"))
    J.assert_unique(t.part, "p_partkey")
    return J.duplicate_keys(names, "name")


# --- windows --------------------------------------------------------------------------------------------------


@query("w01_surrogate_key", "select row_number() over (order by c_name) customer_key, c_custkey, c_name from customer")
def w01(t):
    return K.surrogate_key(t.customer.select("c_custkey", "c_name"), ["c_name"], "customer_key")


@query(
    "w02_distributed_key",
    """select row_number() over (order by l_partkey, l_shipdate, l_orderkey, l_linenumber) line_key, l_partkey, l_orderkey, l_linenumber
       from lineitem""",
)
def w02(t):
    lines = t.lineitem.select("l_partkey", "l_shipdate", "l_orderkey", "l_linenumber")
    order = ["l_partkey", "l_shipdate", "l_orderkey", "l_linenumber"]
    return K.distributed_key(lines, order, "line_key").drop("l_shipdate")


@query(
    "w03_keep_first",
    """select o_custkey, o_orderkey, o_totalprice from
         (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) rn from orders) where rn = 1""",
)
def w03(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return K.keep_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "w04_row_id",
    """select row_number() over (partition by event_type order by event_id) row_id, event_type, event_id from events""",
)
def w04(t):
    return K.distributed_key(t.events.select("event_type", "event_id"), ["event_id"], "row_id", by=["event_type"])


@query(
    "w05_freq_encode",
    with_ctes("fx_listing", """select listing_id, count(*) over (partition by room_type)::double room_type_freq,
                                      count(*) over (partition by neighbourhood_group)::double neighbourhood_group_freq from fx_listing"""),
)
def w05(t):
    df = t.listing.select("listing_id", "room_type", "neighbourhood_group")
    return E.freq_encode(df, ["room_type", "neighbourhood_group"]).drop("room_type", "neighbourhood_group")


@query(
    "w06_freq_encode_pair",
    with_ctes("fx_listing", """select listing_id, count(*) over (partition by neighbourhood_group, room_type)::double /
                                      (count(*) over ())::double pair_freq from fx_listing"""),
)
def w06(t):
    df = t.listing.select("listing_id", "neighbourhood_group", "room_type")
    return E.freq_encode_pair(df, "neighbourhood_group", "room_type", "pair_freq", normalize=True).select("listing_id", "pair_freq")


@query(
    "w07_label_encode",
    with_ctes("fx_listing", """select listing_id, case when neighbourhood_group is null then -1
                                      else dense_rank() over (order by neighbourhood_group nulls last) - 1 end code from fx_listing"""),
)
def w07(t):
    return E.label_encode(t.listing.select("listing_id", "neighbourhood_group"), "neighbourhood_group", ["code"]).drop("neighbourhood_group")


# --- order ----------------------------------------------------------------------------------------------------


@query("o01_write_sorted", "select l_partkey, l_orderkey, l_linenumber, l_quantity from lineitem")
def o01(t):
    lines = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    return write_sorted(lines, ["l_partkey", "l_orderkey", "l_linenumber"], scratch_path(t.spark, "o01"))


@query("o02_head", "select o_orderkey, o_totalprice from orders order by o_totalprice, o_orderkey limit 10")
def o02(t):
    return O.head(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 10)


def _profiles(t):
    return profile_many({"calendar": t.calendar, "raw": t.listing_raw})


_NULL_RATES = """
rates as (
  select 'raw' "table", c "column", n null_count, n / total null_rate from (
    select count(*) total, unnest(['id', 'name', 'price', 'host_is_superhost', 'latitude', 'longitude', 'minimum_nights']) c,
           unnest([count(*) - count(id), count(*) - count(name), count(*) - count(price), count(*) - count(host_is_superhost),
                   count(*) - count(latitude), count(*) - count(longitude), count(*) - count(minimum_nights)]) n from fx_listing_raw)
  union all
  select 'calendar', 'price', count(*) - count(price), (count(*) - count(price)) / count(*) from fx_calendar)
"""


@query(
    "o03_top_null_columns",
    with_ctes("fx_listing_raw", "fx_calendar", "select * from (select 1)").replace("select * from (select 1)", "")
    + ", " + _NULL_RATES
    + """select "table", "rank", "column", null_count, null_rate from (
           select *, row_number() over (partition by "table" order by null_rate desc, "column") "rank" from rates where null_rate > 0)
         where "rank" <= 5""",
)
def o03(t):
    return O.top_null_columns(_profiles(t), 5).drop("type")


@query(
    "o04_top_issues",
    with_ctes("fx_listing_raw", "fx_calendar", "select * from (select 1)").replace("select * from (select 1)", "")
    + ", " + _NULL_RATES
    + """select "table", count(*) over (partition by "table") n_issues, "column" from rates where null_rate > 0.01
         qualify row_number() over (partition by "table" order by case "column" when 'id' then 1 when 'name' then 2 when 'price' then 3 when 'host_is_superhost' then 4
                   when 'latitude' then 5 else 7 end) <= 3""",
)
def o04(t):
    top = O.top_issues(validate(_profiles(t), max_null_fraction=0.01), 3)
    return top.select("table", "n_issues", F.regexp_extract("issue", r"^Column (\S+) has", 1).alias("column"))


@query(
    "o05_top_importances",
    """select p_brand feature, round(corr(p_size, p_retailprice), 6) importance from part group by 1 order by abs(corr(p_size, p_retailprice)) desc, 1 limit 15""",
)
def o05(t):
    weights = t.part.groupBy(F.col("p_brand").alias("feature")).agg(F.corr("p_size", "p_retailprice").alias("importance"))
    return O.top_importances(weights, 15).select("feature", F.round("importance", 6).alias("importance"))


@query(
    "o06_rank_hosts",
    with_ctes("fact", "dim_host", """select h.host_id, sum(cast(round(f.est_revenue * 100) as bigint))::double / 100.0::double total_estimated_revenue
              from fact f join dim_host h on f.host_key = h.host_key group by 1
              order by sum(cast(round(f.est_revenue * 100) as bigint)) desc, 1 limit 10"""),
)
def o06(t):
    return O.rank_hosts(host_performance(t.fact, t.dims["hosts"]), n=10).select("host_id", "total_estimated_revenue")


# --- sets -----------------------------------------------------------------------------------------------------


@query(
    "u01_union_cities",
    """select c_custkey id, c_nationkey nation, 'customers' city from customer union all select s_suppkey, s_nationkey, 'suppliers' from supplier""",
)
def u01(t):
    return U.union_cities({
        "customers": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation")),
        "suppliers": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation")),
    })


@query(
    "u02_conform_dim",
    with_ctes("conf_dim_area", """select neighbourhood_key, neighbourhood, neighbourhood_group, centroid_lat, centroid_lon from conf_dim_area"""),
)
def u02(t):
    areas = stage(gold.dim_neighbourhoods(t.brand_listing, "city"), "areas")
    natural = ["neighbourhood", "neighbourhood_group"]
    return U.conform_dim(areas, natural, "neighbourhood_key", natural).drop("city")


@query("u03_keep_with_target", "select p_size, p_partkey, p_retailprice from part")
def u03(t):
    return keep_with_target(t.part, ["p_size", "p_partkey"], "p_retailprice")
