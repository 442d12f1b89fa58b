"""Numeric features of the listing dataset."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import text
from marketlake.functions.geo import euclid_deg, haversine, polar_offsets
from marketlake.functions.scalars import bool_to_num, capacity_ratios, log1p_clipped, one_hot, smoothed_ratio, tenure_years
from marketlake.operators.aggregates import global_mean
from marketlake.operators.encode import freq_encode, label_encode
from marketlake.operators.project import drop_columns, ensure_columns, fill_nulls, numeric_only
from marketlake.session import stage

TARGET = "target_price"
NUMBERS = ["accommodates", "bedrooms", "beds", "latitude", "longitude", "is_superhost", "host_listings_count",
           "availability_rate", "est_revenue", "total_reviews", "host_tenure_days"]
CATEGORIES = ["room_type", "property_type", "neighbourhood", "neighbourhood_group"]
PAIRS = {"neighbourhood_group_room_type_freq": ("neighbourhood_group", "room_type"),
         "property_room_type_freq": ("property_type", "room_type")}
RAW_COLUMNS = ["listing_id", "name", "neighbourhood", "neighbourhood_group", "room_type", "property_type", "host_since"]
LEAK_COLUMNS = ["avg_price", "est_revenue", "revenue_per_review", "revenue_per_available_day"]


def name_features(df: DataFrame, style: str = "keywords") -> DataFrame:
    """Keyword flags of the listing name, their number, and the length in characters and words.

    ``style``: ``keywords`` (anywhere in the text), ``words`` (whole words), ``synonyms`` (grouped spellings) or
    ``synonyms_wide`` (a group for nearly every word).
    """
    groups = {"synonyms": text.NAME_SYNONYMS, "synonyms_wide": text.NAME_SYNONYMS_WIDE}.get(style)
    if groups:
        flags, names = text.synonym_flags("name", groups), list(groups)
    else:
        flags = {"keywords": text.keyword_flags, "words": text.word_flags}[style]("name")
        names = [text.flag_name(w) for w in text.NAME_KEYWORDS]
    flagged = df.select("*", *flags)
    return flagged.withColumns({
        "name_len_chars": text.char_len("name"),
        "name_len_words": text.word_count("name").cast("double"),
        "name_kw_count": text.flag_count(names),
    })


def position_features(df: DataFrame, polar: bool = False) -> DataFrame:
    """Distances to the centroid of all listings; a missing coordinate counts as the centroid."""
    centre = global_mean(df, ["latitude", "longitude"]).select(F.struct("latitude", "longitude")).scalar()
    df = df.withColumns({"_clat": centre["latitude"], "_clon": centre["longitude"]})
    df = df.withColumns({"_lat": F.coalesce("latitude", "_clat"), "_lon": F.coalesce("longitude", "_clon")})
    position = ("_lat", "_lon", "_clat", "_clon")
    out = df.withColumns({
        "dist_centroid_haversine": haversine(*position),
        "dist_centroid_euclidean": euclid_deg(*position),
    })
    return (out.select("*", *polar_offsets(*position)) if polar else out).drop(*position)


def activity_features(df: DataFrame) -> DataFrame:
    """Host experience and demand; missing counts are 0."""
    zero = ["host_tenure_days", "host_listings_count", "est_revenue", "total_reviews", "availability_rate"]
    df = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in zero})
    df = df.withColumns({
        "host_tenure_years": tenure_years("host_tenure_days"),
        "host_listings_log1p": log1p_clipped("host_listings_count"),
    })
    return df.withColumns({
        "revenue_per_review": smoothed_ratio("est_revenue", "total_reviews", 1.0, 1.0),
        "revenue_per_available_day": smoothed_ratio("est_revenue", "availability_rate", 365.0, 1.0),
        "reviews_per_year_proxy": smoothed_ratio("total_reviews", "host_tenure_years", 1.0, 0.1),
    })


def category_features(df: DataFrame, normalize: bool = False, missing: str | None = None) -> DataFrame:
    """Frequencies of four categories and two pairs, all counted in one pass."""
    if missing is not None:
        df = df.withColumns({c: text.missing_marker(c, missing) for c in CATEGORIES if c in df.columns})
    have = [c for c in CATEGORIES if c in df.columns]
    pairs = {n: p for n, p in PAIRS.items() if set(p) <= set(have)}
    out = freq_encode(df, [*have, *pairs.values()], normalize, [*[f"{c}_freq" for c in have], *pairs]) if have else df
    return ensure_columns(out, {f"{c}_freq": 0.0 for c in CATEGORIES} | {n: 0.0 for n in PAIRS})


def listing_features(df: DataFrame, names: str = "keywords", polar: bool = False, relative_freq: bool = False,
                     missing: str | None = None, codes: bool = False, one_hot_room: bool = False,
                     fill: float | None = 0.0, keep: list[str] | None = None) -> DataFrame:
    """All features plus the target; the options select variants.

    ``names`` as in :func:`name_features`; ``polar`` adds offsets and angle to the centroid; ``relative_freq``
    divides frequencies by the number of rows; ``missing`` is a category for null; ``codes`` adds the sorted
    position of each category; ``one_hot_room`` adds a column per room type. Nulls become ``fill``, but the
    target is never filled. ``keep`` holds columns to carry along, such as the listing id.

    The input is staged first: its mean position, its frequencies and its rows are separate passes, which must
    not repeat the aggregation of the fact behind it.
    """
    keep = list(keep or [])
    df = stage(df, "features")
    df = ensure_columns(df, {c: None for c in NUMBERS} | {"name": ("string", None)})
    df = activity_features(position_features(name_features(df, names), polar)).select("*", *capacity_ratios())
    df = category_features(df, relative_freq, missing)
    if codes:
        df = label_encode(df, [c for c in CATEGORIES if c in df.columns])
    if one_hot_room:
        df = one_hot(df.withColumn("room", F.col("room_type")), "room")
    df = df.withColumn("is_superhost", bool_to_num("is_superhost", None).cast("double"))
    df = drop_columns(df, [c for c in RAW_COLUMNS if c not in keep])
    df = numeric_only(df, [*keep, TARGET])
    if fill is not None:
        df = fill_nulls(df, fill, [c for c in df.columns if c not in (TARGET, *keep)])
    return df


def feature_set(df: DataFrame, kind: str = "full") -> DataFrame:
    """``full``; ``no_avg`` without the mean price; ``prospective`` without anything known only afterwards."""
    drop = {"full": [], "no_avg": ["avg_price"], "prospective": LEAK_COLUMNS}[kind]
    return drop_columns(df, drop)


def apply_program(df: DataFrame, program: Callable[[DataFrame], DataFrame], target: str = TARGET) -> DataFrame:
    """Run a user's feature program and check its result: the target is there and every feature is numeric."""
    out = df.transform(program)
    if target not in out.columns:
        raise ValueError(f"the feature program must return the column {target}")
    numeric = set(numeric_only(out).columns) | {target, "listing_id"}
    text_columns = [c for c in out.columns if c not in numeric]
    if text_columns:
        raise ValueError(f"features that are not numeric: {text_columns}")
    return out
