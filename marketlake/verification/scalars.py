"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.functions import geo as G
from marketlake.functions import scalars as S
from marketlake.functions import text as X
from marketlake.functions.exact import mean_money, sum_money
from marketlake.operators.aggregates import global_mean
from marketlake.verification.fixtures import days_as_text, rounded, with_ctes
from marketlake.verification.registry import query

WORDS = ["the", "new", "elle", "sch", "of the"]
GROUPS = {"kw_article": ["the ", "der ", "les "], "kw_linking": ["and", "und", "et "]}


@query("f01_strip_chars", "select doc_id, md5(regexp_replace(text, '[aeiou,]', '', 'g')) stripped from documents")
def f01(t):
    return t.documents.select("doc_id", F.md5(X.strip_chars("text", "[aeiou,]")).alias("stripped"))


@query("f02_lower", "select c_custkey, lower(c_name) name, lower(c_mktsegment) segment from customer")
def f02(t):
    return t.customer.select("c_custkey", X.lower("c_name").alias("name"), X.lower("c_mktsegment").alias("segment"))


@query(
    "f03_keyword_flags",
    "select doc_id, " + ", ".join(f"contains(lower(coalesce(text, '')), '{w}')::int kw_{w.replace(' ', '_')}" for w in WORDS) + " from documents",
)
def f03(t):
    return t.documents.select("doc_id", *X.keyword_flags("text", WORDS))


@query(
    "f04_synonym_flags",
    "select doc_id, "
    + ", ".join("(" + " or ".join(f"contains(lower(coalesce(text, '')), '{s}')" for s in g) + f")::int {n}" for n, g in GROUPS.items())
    + " from documents",
)
def f04(t):
    return t.documents.select("doc_id", *X.synonym_flags("text", GROUPS))


@query(
    "f04_synonym_flags_wide",
    "select p_partkey, "
    + ", ".join("(" + " or ".join(f"contains(lower(coalesce(p_name, '')), '{s}')" for s in g) + f")::int {n}" for n, g in X.NAME_SYNONYMS_WIDE.items())
    + " from (select p_partkey, p_name || ' ' || p_type p_name from part)",
)
def f04_wide(t):
    return t.part.withColumn("p_name", F.concat("p_name", F.lit(" "), "p_type")).select("p_partkey", *X.synonym_flags("p_name", X.NAME_SYNONYMS_WIDE))


STANDALONE = ["the", "der", "elle", "of the"]
_EDGE = r"[^\p{L}\p{N}_]"


@query(
    "f05_word_flags",
    "select doc_id, "
    + ", ".join(
        f"contains(lower(coalesce(text, '')), '{w}')::int kw_{w.replace(' ', '_')}" if " " in w
        else f"regexp_matches(lower(coalesce(text, '')), '(^|{_EDGE}){w}($|{_EDGE})')::int kw_{w}"
        for w in STANDALONE
    )
    + " from documents",
)
def f05(t):
    return t.documents.select("doc_id", *X.word_flags("text", STANDALONE))


@query(
    "f06_flag_count",
    "select doc_id, " + " + ".join(f"contains(lower(coalesce(text, '')), '{w}')::int" for w in WORDS) + " kw_count from documents",
)
def f06(t):
    flagged = t.documents.select("doc_id", *X.keyword_flags("text", WORDS))
    return flagged.select("doc_id", X.flag_count([X.flag_name(w) for w in WORDS]).alias("kw_count"))


@query("f07_char_len", "select doc_id, length(coalesce(text, '')) len from documents")
def f07(t):
    return t.documents.select("doc_id", X.char_len("text").alias("len"))


@query("f08_word_count", "select doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda w: w <> '')) words from documents")
def f08(t):
    return t.documents.select("doc_id", X.word_count("text").alias("words"))


@query("f09_pair_key", with_ctes("fx_listing", "select listing_id, coalesce(neighbourhood_group, 'nan') || '||' || coalesce(room_type, 'nan') pair from fx_listing"))
def f09(t):
    return t.listing.select("listing_id", X.pair_key("neighbourhood_group", "room_type").alias("pair"))


@query("f10_missing_marker", with_ctes("fx_listing", "select listing_id, coalesce(neighbourhood_group, 'NA') grp from fx_listing"))
def f10(t):
    return t.listing.select("listing_id", X.missing_marker("neighbourhood_group").alias("grp"))


@query("f12_year_month", "select o_orderkey, year(o_orderdate) \"year\", month(o_orderdate) \"month\" from orders")
def f12(t):
    return t.orders.select("o_orderkey", S.year("o_orderdate").cast("bigint").alias("year"), S.month("o_orderdate").cast("bigint").alias("month"))


@query("f13_isodow", "select o_orderkey, isodow(o_orderdate) isodow from orders")
def f13(t):
    return t.orders.select("o_orderkey", S.isodow("o_orderdate").cast("bigint").alias("isodow"))


@query(
    "f14_tenure_days",
    """select l_orderkey, l_linenumber, coalesce(date_diff('day', case when l_returnflag <> 'N' then cast(l_shipdate as date) end, date '2026-06-23'), -1) as "days"
       from lineitem""",
)
def f14(t):
    since = F.when(F.col("l_returnflag") != "N", F.to_date("l_shipdate"))
    return t.lineitem.select("l_orderkey", "l_linenumber", S.tenure_days(since).cast("bigint").alias("days"))


@query("f15_tenure_years", "select o_orderkey, date_diff('day', cast(o_orderdate as date), date '2026-06-23') / 365.0::double as \"years\" from orders")
def f15(t):
    return t.orders.select("o_orderkey", S.tenure_years(S.tenure_days(F.to_date("o_orderdate"))).alias("years"))


@query(
    "f16_parse_date",
    """select o_orderkey, strftime(case when o_orderstatus = 'F' then null else cast(o_orderdate as date) end, '%Y-%m-%d') d from orders""",
)
def f16(t):
    text = F.when(F.col("o_orderstatus") == "F", "2025-13-01").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return days_as_text(t.orders.select("o_orderkey", S.parse_date(text).alias("d")))


@query(
    "f17_round2",
    """select l_suppkey, ((2 * sum(cast(round(l_extendedprice * 100) as bigint)) + count(l_extendedprice)) // (2 * count(l_extendedprice)))::bigint / 100.0::double avg2
       from lineitem group by 1""",
)
def f17(t):
    return t.lineitem.groupBy("l_suppkey").agg(mean_money("l_extendedprice").alias("avg2"))


_CENTRE = "(select avg(latitude) clat, avg(longitude) clon from fx_listing)"
_HAV = """2 * 6371.0 * asin(least(1.0, sqrt(pow(sin((radians({clat}) - radians({lat})) / 2), 2)
          + cos(radians({lat})) * cos(radians({clat})) * pow(sin((radians({clon}) - radians({lon})) / 2), 2))))"""
HAVERSINE = _HAV.format(lat="latitude", lon="longitude", clat="clat", clon="clon")


def _centred(t):
    centre = global_mean(t.listing, ["latitude", "longitude"]).select(F.struct("latitude", "longitude")).scalar()
    return t.listing.withColumns({"clat": centre["latitude"], "clon": centre["longitude"]})


@query("f18_haversine", with_ctes("fx_listing", f"select listing_id, round({HAVERSINE}, 5) km from fx_listing, {_CENTRE}"))
def f18(t):
    return _centred(t).select("listing_id", F.round(G.haversine("latitude", "longitude", "clat", "clon"), 5).alias("km"))


@query(
    "f19_euclid_deg",
    with_ctes("fx_listing", f"select listing_id, sqrt((latitude - clat) * (latitude - clat) + (longitude - clon) * (longitude - clon)) deg from fx_listing, {_CENTRE}"),
)
def f19(t):
    return _centred(t).select("listing_id", G.euclid_deg("latitude", "longitude", "clat", "clon").alias("deg"))


@query(
    "f20_polar_with_centre",
    with_ctes("fx_listing", f"""select listing_id, round(clat, 6) lat_center, round(clon, 6) lon_center, latitude - clat rel_lat, longitude - clon rel_lon,
              sqrt((latitude - clat) * (latitude - clat) + (longitude - clon) * (longitude - clon)) dist_radial, round(atan2(latitude - clat, longitude - clon), 6) angle_radial
              from fx_listing, {_CENTRE}"""),
)
def f20_centre(t):
    polar = _centred(t).select("listing_id", *G.polar_offsets("latitude", "longitude", "clat", "clon", with_centre=True))
    return rounded(polar, 6, "lat_center", "lon_center", "angle_radial")


@query(
    "f20_polar_offsets",
    with_ctes("fx_listing", f"""select listing_id, latitude - clat rel_lat, longitude - clon rel_lon,
              sqrt((latitude - clat) * (latitude - clat) + (longitude - clon) * (longitude - clon)) dist_radial, round(atan2(latitude - clat, longitude - clon), 6) angle_radial
              from fx_listing, {_CENTRE}"""),
)
def f20(t):
    polar = _centred(t).select("listing_id", *G.polar_offsets("latitude", "longitude", "clat", "clon"))
    return rounded(polar, 6, "angle_radial")


@query(
    "f21_local_distance",
    with_ctes("fx_listing", f"""select listing_id, round({HAVERSINE}, 5) dist_local from fx_listing l
              join (select city c, avg(latitude) clat, avg(longitude) clon from fx_listing group by 1) on c is not distinct from city"""),
)
def f21(t):
    return G.local_distance(t.listing, "city").select("listing_id", F.round("dist_local", 5).alias("dist_local"))


@query(
    "f22_safe_ratio",
    with_ctes("fx_listing", "select listing_id, case when bedrooms <> 0 then beds / bedrooms end ratio from fx_listing"),
)
def f22(t):
    return t.listing.select("listing_id", S.safe_ratio("beds", "bedrooms").alias("ratio"))


@query(
    "f23_positive_ratio",
    """select c_custkey, case when c_acctbal > 0 then c_custkey / c_acctbal else 0 end ratio,
              case when c_nationkey <> 0 then c_acctbal / c_nationkey else 0 end ratio_or_zero from customer""",
)
def f23(t):
    return t.customer.select(
        "c_custkey", S.positive_ratio("c_custkey", "c_acctbal").alias("ratio"), S.safe_ratio("c_acctbal", "c_nationkey", 0).alias("ratio_or_zero")
    )


@query("f24_inf_to_null", "select c_custkey, case when c_nationkey = 0 then null else c_acctbal end x from customer")
def f24(t):
    value = F.when(F.col("c_nationkey") == 0, F.lit(float("-inf"))).otherwise(F.col("c_acctbal"))
    return t.customer.select("c_custkey", S.inf_to_null(value).alias("x"))


@query("f25_log1p_clipped", "select c_custkey, case when c_acctbal is not null then round(ln(1 + greatest(c_acctbal, 0)), 9) end l from customer")
def f25(t):
    return t.customer.select("c_custkey", F.round(S.log1p_clipped("c_acctbal"), 9).alias("l"))


@query("f26_abs", "select c_custkey, abs(c_acctbal) a from customer")
def f26(t):
    return t.customer.select("c_custkey", S.abs_("c_acctbal").alias("a"))


@query(
    "f27_bool_to_num",
    with_ctes("fx_listing_raw", "fx_listing", """select r.id, case host_is_superhost when 't' then 1 else 0 end from_text,
              coalesce(is_superhost::int, 0) from_boolean from fx_listing_raw r join fx_listing l on l.listing_id = r.id::bigint"""),
)
def f27(t):
    listing = t.listing.select("listing_id", "is_superhost")
    joined = t.listing_raw.join(listing, F.col("id").cast("bigint") == F.col("listing_id"))
    return joined.select("id", S.bool_to_num("host_is_superhost").alias("from_text"), S.bool_to_num("is_superhost").alias("from_boolean"))


@query("f28_smoothed_ratio", "select l_orderkey, l_linenumber, l_extendedprice / (l_discount * 365 + 1) ratio from lineitem")
def f28(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", S.smoothed_ratio("l_extendedprice", "l_discount", 365, 1).alias("ratio"))


@query(
    "f29_capacity_ratios",
    with_ctes("fx_listing", """select listing_id, case when bedrooms <> 0 then beds / bedrooms end beds_per_bedroom,
              case when beds <> 0 then accommodates / beds end accommodates_per_bed, case when bedrooms <> 0 then accommodates / bedrooms end accommodates_per_bedroom,
              case when accommodates <> 0 then beds / accommodates end beds_per_accommodate from fx_listing"""),
)
def f29(t):
    return t.listing.select("listing_id", *S.capacity_ratios())


@query("f30_sha256", "select doc_id, sha256(text) sha256 from documents")
def f30(t):
    return t.documents.select("doc_id", X.sha256_hex("text").alias("sha256"))


@query(
    "f31_one_hot",
    """select o_orderkey, (o_orderstatus = 'O')::int "o_orderstatus_O", (o_orderstatus = 'P')::int "o_orderstatus_P" from orders""",
)
def f31(t):
    return S.one_hot(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus")


@query("f32_json_field", "select event_id, json_extract_string(props, '$.k')::bigint k from events")
def f32(t):
    return t.events.select("event_id", X.json_field("props", "$.k").cast("bigint").alias("k"))


_HTML = r"""regexp_replace(html, '(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</(script|style)\s*>', '', 'g')"""
_BLOCK = r"""'(?is)<(title|h[1-3])\b[^>]*>(.*?)</(?:title|h[1-3])\s*>'"""
_DECODED = "text"
# Old named references are valid without the semicolon.
for _entity, _char in (("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&lt;?", "<"), ("&gt;?", ">"), ("&#39;", "''"), ("&amp;?", "&")):
    _DECODED = f"regexp_replace({_DECODED}, '{_entity}', '{_char}', 'g')"


@query(
    "f33_html_headings",
    f"""with blocks as (
          select page_id, unnest(range(len(b))) i, unnest(list_zip(b, c)) z from (
            select page_id, regexp_extract_all(h, {_BLOCK}, 1) b, regexp_extract_all(h, {_BLOCK}, 2) c from (select page_id, {_HTML} h from pages))),
        pieces as (select page_id, i, lower(z[1]) tag, generate_subscripts(p, 1) j, unnest(p) text
                   from (select page_id, i, z, regexp_split_to_array(z[2], '<[^>]*>') p from blocks)),
        kept as (select * from pieces where trim(regexp_replace(text, '\\s+', ' ', 'g')) <> '')
        select page_id, row_number() over (partition by page_id order by i, j) - 1 "position", tag,
               regexp_replace({_DECODED}, '^\\s+|\\s+$', '', 'g') heading from kept""",
)
def f33(t):
    return X.html_headings(t.pages, "page_id", "html")


@query(
    "f34_to_currency",
    """select o_orderkey, o_totalprice * rate price_converted from orders
       left join (select c_mktsegment, count(*) / 1000.0::double rate from customer where c_mktsegment <> 'BUILDING' group by 1) on c_mktsegment = case o_orderpriority
         when '1-URGENT' then 'BUILDING' when '2-HIGH' then 'MACHINERY' else 'FURNITURE' end""",
)
def f34(t):
    rates = t.customer.where("c_mktsegment <> 'BUILDING'").groupBy(F.col("c_mktsegment").alias("currency")).agg(
        (F.count(F.lit(1)) / F.lit(1000.0)).alias("rate")
    )
    currency = F.when(F.col("o_orderpriority") == "1-URGENT", "BUILDING").when(F.col("o_orderpriority") == "2-HIGH", "MACHINERY").otherwise("FURNITURE")
    orders = t.orders.select("o_orderkey", currency.alias("currency"), F.col("o_totalprice").alias("price"))
    return S.to_currency(orders, rates).select("o_orderkey", "price_converted")


_MICROS = "sum(round(converted * 1000000)::bigint)"


@query(
    "f34_converted_totals",
    f"""select l_suppkey, ({_MICROS} / 1000000.0::decimal(8, 1))::double total, floor({_MICROS}::double / count(converted) / 10000 + 0.5) / 100 mean
        from (select l_suppkey, l_extendedprice * (p_size / 100000.0::double) converted from lineitem join part on p_partkey = l_partkey) group by 1""",
)
def f34_totals(t):
    """Sums and means of converted prices, which have more digits than two."""
    rates = t.part.select(F.col("p_partkey").alias("l_partkey"), (F.col("p_size") / F.lit(100000.0)).alias("rate"))
    converted = S.to_currency(t.lineitem.select("l_suppkey", "l_partkey", "l_extendedprice"), rates, "l_extendedprice", "l_partkey")
    return converted.groupBy("l_suppkey").agg(sum_money("price_converted").alias("total"), mean_money("price_converted").alias("mean"))
