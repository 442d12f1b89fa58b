"""Star schema: four dimensions, the daily fact and their conformed forms.

All cities are built together; where a table is kept per city, the city is a key column, not a table name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.functions.scalars import est_revenue, first_non_null, is_weekend, isodow, season
from marketlake.operators.aggregates import centroids
from marketlake.operators.joins import key_map, lookup_date_key
from marketlake.operators.keys import distributed_key, surrogate_key
from marketlake.operators.project import require_not_null
from marketlake.operators.sets import conform_dim
from marketlake.session import StagedTables, stage
from marketlake.sources.readers import date_series

LISTING_ATTRS = ["listing_id", "name", "room_type", "property_type", "accommodates", "bedrooms", "beds", "latitude", "longitude"]
HOST_ATTRS = ["host_id", "host_name", "is_superhost", "host_since", "host_listings_count"]
FACT_COLUMNS = ["listing_key", "host_key", "neighbourhood_key", "date_key", "price", "is_available", "minimum_nights",
                "est_revenue", "reviews_to_date"]


def calendar_attributes(days: DataFrame, col: str = "full_date") -> DataFrame:
    """Key, date parts, weekend flag and season of consecutive days. The key counts from the first day, so no
    sort is needed: it is the distance to the earliest date."""
    first = days.agg(F.min(col)).scalar()
    day = F.col(col)
    return days.select(
        (F.datediff(day, first) + 1).cast("bigint").alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        isodow(day).alias("day_of_week"),
        is_weekend(isodow(day)).alias("is_weekend"),
        season(F.month(day)).alias("season"),
    )


def dim_calendar(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """One row per day of the span."""
    return calendar_attributes(date_series(spark, start, end))


def _scope(df: DataFrame, by: str | None) -> list[str]:
    return [by] if by and by in df.columns else []


def dim_listings(listings: DataFrame, by: str | None = None) -> DataFrame:
    """One row per listing row, keyed in the order of the listing id; ``by`` keeps a key sequence per city."""
    scope = _scope(listings, by)
    return surrogate_key(listings.select(*scope, *LISTING_ATTRS), ["listing_id"], "listing_key", scope)


def dim_hosts(listings: DataFrame, by: str | None = None) -> DataFrame:
    """Distinct host versions; a host whose attributes differ between listings has several keys."""
    scope = _scope(listings, by)
    hosts = require_not_null(listings, ["host_id"]).select(*scope, *HOST_ATTRS).distinct()
    return surrogate_key(hosts, ["host_id"], "host_key", scope)


def dim_neighbourhoods(listings: DataFrame, by: str | None = None) -> DataFrame:
    """Neighbourhoods with the centroid of their distinct points."""
    scope = _scope(listings, by)
    named = require_not_null(listings, ["neighbourhood"])
    areas = centroids(named, [*scope, "neighbourhood", "neighbourhood_group"])
    return surrogate_key(areas, ["neighbourhood", "neighbourhood_group"], "neighbourhood_key", scope)


def listing_lookup(listings: DataFrame, reviews: DataFrame, dims: dict[str, DataFrame], by: str | None = None,
                   strict: bool = False) -> DataFrame:
    """What a calendar row needs to know about its listing: keys, fallback price and review count.

    Everything that depends on the listing alone is joined here, at listing size, so that the calendar is
    joined once. Duplicate natural keys multiply rows as separate joins would. ``strict`` matches a
    neighbourhood on its group too.
    """
    scope = _scope(listings, by)
    base = listings.select(*scope, "listing_id", "host_id", "neighbourhood", "neighbourhood_group",
                           F.col("price").alias("listing_price"))
    dl = dims["listings"].select(*[F.col(c).alias(f"dl_{c}") for c in scope], F.col("listing_id").alias("dl_id"), "listing_key")
    dh = dims["hosts"].select(*[F.col(c).alias(f"dh_{c}") for c in scope], F.col("host_id").alias("dh_id"), "host_key")
    dn = dims["neighbourhoods"].select(*[F.col(c).alias(f"dn_{c}") for c in scope], F.col("neighbourhood").alias("dn_name"),
                                       F.col("neighbourhood_group").alias("dn_group"), "neighbourhood_key")

    def in_city(prefix):
        condition = F.lit(True)
        for c in scope:
            condition = condition & F.col(c).eqNullSafe(F.col(f"{prefix}_{c}"))
        return condition

    area = F.col("neighbourhood") == F.col("dn_name")
    if strict:
        area = area & F.col("neighbourhood_group").eqNullSafe(F.col("dn_group"))
    of_listing = [*_scope(reviews, by), "r_id"]
    seen = reviews.withColumn("r_id", F.col("listing_id"))
    counts = seen.groupBy(*of_listing).agg(F.count(F.lit(1)).alias("review_count"))
    counted = F.col("listing_id") == F.col("r_id")
    for c in _scope(reviews, by):
        counts = counts.withColumnRenamed(c, f"r_{c}")
        counted = counted & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    return (
        base.join(dl, (F.col("listing_id") == F.col("dl_id")) & in_city("dl"), "inner")
        .join(dh, (F.col("host_id") == F.col("dh_id")) & in_city("dh"), "left")
        .join(dn, area & in_city("dn"), "left")
        .join(counts, counted, "left")
        .select(*scope, "listing_id", "listing_key", "host_key", "neighbourhood_key", "listing_price",
                F.coalesce("review_count", F.lit(0).cast("bigint")).alias("reviews_to_date"))
    )


def reviews_at(calendar: DataFrame, reviews: DataFrame, by: str | None = None) -> DataFrame:
    """(by, r_id, r_day, reviews_at): the reviews of a listing up to each of its calendar days and review days.

    Review days and asked days are counted together before anything is ordered, so a listing has at most one row per day,
    however many reviews or calendar rows it has, and a running sum over those is the as-of join. Reviews without a
    date count on no day.
    """
    scope = [c for c in _scope(reviews, by) if c in calendar.columns]

    def days(df: DataFrame, day: str, n: int) -> DataFrame:
        day = F.col(day).cast("date")
        return df.where(day.isNotNull()).select(*scope, F.col("listing_id").alias("r_id"), day.alias("r_day"), F.lit(n).cast("bigint").alias("n"))

    both = days(reviews, "review_date", 1).unionByName(days(calendar, "calendar_date", 0))
    per_day = both.groupBy(*scope, "r_id", "r_day").agg(F.sum("n").alias("n"))
    up_to = Window.partitionBy(*scope, "r_id").orderBy("r_day").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.select(*[F.col(c).alias(f"r_{c}") for c in scope], "r_id", "r_day", F.sum("n").over(up_to).alias("reviews_at"))


def fact_rows(calendar: DataFrame, lookup: DataFrame, dim_date: DataFrame, by: str | None = None,
              as_of: DataFrame | None = None) -> DataFrame:
    """The fact without its id: one join of the calendar with the listing lookup, one with the dates.

    Calendar rows of unknown listings go. The lookup is staged: its true size decides between a broadcast and
    a shuffle by listing, where adaptive execution splits a listing with too many rows. With the reviews in
    ``as_of`` a fact counts those up to its own date, else all of the listing.
    """
    scope = [c for c in _scope(calendar, by) if c in lookup.columns]
    known = stage(lookup, "lookup").select(
        F.col("listing_id").alias("l_id"), *[F.col(c).alias(f"l_{c}") for c in scope],
        *[c for c in lookup.columns if c not in ("listing_id", *scope)],
    )
    match = F.col("listing_id") == F.col("l_id")
    for c in scope:
        match = match & F.col(c).eqNullSafe(F.col(f"l_{c}"))
    joined = lookup_date_key(calendar.join(known, match, "inner"), dim_date, "calendar_date")
    price = first_non_null("price", "listing_price")
    reviews = F.col("reviews_to_date")
    if as_of is not None:
        at = reviews_at(calendar, as_of, by)
        asked = (F.col("listing_id") == F.col("r_id")) & (F.col("calendar_date").cast("date") == F.col("r_day"))
        for c in at.columns[:-3]:
            asked = asked & F.col(c.removeprefix("r_")).eqNullSafe(F.col(c))
        joined = joined.join(at, asked, "left")
        reviews = F.coalesce("reviews_at", F.lit(0).cast("bigint")).alias("reviews_to_date")
    return joined.select(
        *scope, "listing_key", "host_key", "neighbourhood_key", "date_key", price.alias("price"), "is_available",
        "minimum_nights", est_revenue(price, "is_available").alias("est_revenue"), reviews,
    )


def build_dims(listings: DataFrame, by: str | None = None) -> dict[str, DataFrame]:
    """Listing, host and neighbourhood dimension. Their rows are in the work folder, so their size is known."""
    dims = {
        "listings": dim_listings(listings, by),
        "hosts": dim_hosts(listings, by),
        "neighbourhoods": dim_neighbourhoods(listings, by),
    }
    return {name: stage(dim, f"dim-{name}") for name, dim in dims.items()} if by else dims


def _numbered(rows: DataFrame, lookups: StagedTables, scope: list[str] | None = None) -> DataFrame:
    """The fact with its id; the lookups it was made from go, as the key writes the rows."""
    fact = distributed_key(rows, ["listing_key", "date_key"], "fact_id", scope)
    lookups.delete()
    return fact


def fact_daily(calendar: DataFrame, listings: DataFrame, reviews: DataFrame, dims: dict[str, DataFrame],
               dim_date: DataFrame, by: str | None = None, with_id: bool = True, strict: bool = False,
               as_of: bool = False) -> DataFrame:
    """Fact of listing x day. ``fact_id`` numbers the rows by listing and date without a single-task sort.

    ``reviews_to_date`` is the listing's total, with ``as_of`` the running count up to the day of the fact.
    """
    with StagedTables(calendar.sparkSession) as lookups:
        rows = fact_rows(calendar, listing_lookup(listings, reviews, dims, by, strict), dim_date, by, reviews if as_of else None)
    return _numbered(rows, lookups, _scope(rows, by)) if with_id else rows


def conform_dims(city_dims: dict[str, DataFrame], cities: list[str] | None = None) -> dict[str, DataFrame]:
    """Conformed dimensions over all cities, from per-city dimensions with a city column."""
    return {
        "listings": conform_dim(city_dims["listings"], ["listing_id"], "listing_key", ["listing_id"], cities),
        "hosts": conform_dim(city_dims["hosts"], ["host_id"], "host_key", ["host_id"], cities),
        "neighbourhoods": conform_dim(city_dims["neighbourhoods"], ["neighbourhood", "neighbourhood_group"], "neighbourhood_key",
                                      ["neighbourhood", "neighbourhood_group"], cities),
    }


def conform_fact(calendar: DataFrame, listings: DataFrame, reviews: DataFrame, city_dims: dict[str, DataFrame],
                 dims: dict[str, DataFrame], dim_date: DataFrame, by: str = "city", with_id: bool = True,
                 as_of: bool = False) -> DataFrame:
    """Conformed fact of all cities; facts without host or neighbourhood go, as the inner remap joins say.

    Keys depend on the listing alone, so they are remapped in the listing lookup, before the calendar is
    touched: the big table is joined once instead of once per dimension.
    """
    lookup = listing_lookup(listings, reviews, city_dims, by)
    for key, name, natural, blank in (
        ("listing_key", "listings", ["listing_id"], []),
        ("host_key", "hosts", ["host_id"], []),
        ("neighbourhood_key", "neighbourhoods", ["neighbourhood", "neighbourhood_group"], ["neighbourhood_group"]),
    ):
        mapping = key_map(city_dims[name], dims[name], natural, key, by, blank)
        mapping = mapping.select(F.col(by).alias("_m_by"), "_old", "_new")
        same = (F.col(key) == F.col("_old")) & F.col(by).eqNullSafe(F.col("_m_by"))
        columns = lookup.columns
        lookup = lookup.join(mapping, same, "inner").withColumn(key, F.col("_new")).select(*columns)
    with StagedTables(calendar.sparkSession) as lookups:
        rows = fact_rows(calendar, lookup, dim_date, by, reviews if as_of else None).select(*FACT_COLUMNS)
    return _numbered(rows, lookups) if with_id else rows


def conform(listings: DataFrame, calendar: DataFrame, reviews: DataFrame, dim_date: DataFrame,
            cities: list[str] | None = None, by: str = "city", with_id: bool = True, as_of: bool = False) -> dict[str, DataFrame]:
    """The whole conformed star over all cities."""
    spark = listings.sparkSession
    with StagedTables(spark) as city_tables:
        city_dims = build_dims(listings, by)
    dims = conform_dims(city_dims, cities)
    fact = conform_fact(calendar, listings, reviews, city_dims, dims, dim_date, by, with_id, as_of)
    if with_id:  # the fact is numbered and written, so nothing reads the dimensions of single cities any more
        city_tables.delete()
    return {"dates": dim_date, **dims, "fact": fact}
