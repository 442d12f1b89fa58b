"""Raw text tables to typed, clean tables. Extra columns such as ``city`` pass through."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.project import coerce, fill_defaults, project, rejected_counts, require_not_null, with_load_date
from marketlake.sources.readers import geojson_features
from marketlake.sources.writers import write_silver

CARRIED = ["city"]


@dataclass(frozen=True)
class Contract:
    """Source columns with their clean names, types, defaults, required columns and sort order."""

    columns: dict[str, str]
    types: dict[str, str]
    required: list[str] = field(default_factory=list)
    defaults: dict[str, int] = field(default_factory=dict)
    positive: str | None = None
    order: list[str] = field(default_factory=list)


# Names and types of the raw files and of the clean tables.
LISTINGS = Contract(
    columns={
        "id": "listing_id", "name": "name", "host_id": "host_id", "host_name": "host_name", "host_since": "host_since",
        "host_listings_count": "host_listings_count", "host_is_superhost": "is_superhost",
        "neighbourhood_cleansed": "neighbourhood", "neighbourhood_group_cleansed": "neighbourhood_group",
        "latitude": "latitude", "longitude": "longitude", "room_type": "room_type", "property_type": "property_type",
        "accommodates": "accommodates", "bedrooms": "bedrooms", "beds": "beds", "price": "price",
        "minimum_nights": "minimum_nights", "number_of_reviews": "number_of_reviews",
        "review_scores_rating": "review_scores_rating", "instant_bookable": "instant_bookable",
    },
    types={
        "listing_id": "bigint", "host_id": "bigint", "host_since": "date", "host_listings_count": "int",
        "is_superhost": "boolean", "latitude": "float", "longitude": "float", "accommodates": "int", "bedrooms": "float",
        "beds": "float", "price": "money", "minimum_nights": "int", "number_of_reviews": "int",
        "review_scores_rating": "float",
    },
    required=["latitude", "longitude"],
    positive="price",
    order=["listing_id"],
)
CALENDAR = Contract(
    columns={
        "listing_id": "listing_id", "date": "calendar_date", "available": "is_available", "price": "price",
        "minimum_nights": "minimum_nights", "maximum_nights": "maximum_nights",
    },
    types={
        "listing_id": "bigint", "calendar_date": "date", "is_available": "boolean", "price": "money",
        "minimum_nights": "int", "maximum_nights": "int",
    },
    required=["calendar_date", "listing_id"],
    defaults={"minimum_nights": 1, "maximum_nights": 365},
    order=["listing_id", "calendar_date"],
)
REVIEWS = Contract(
    columns={
        "listing_id": "listing_id", "id": "review_id", "reviewer_id": "reviewer_id", "reviewer_name": "reviewer_name",
        "date": "review_date", "comments": "comments",
    },
    types={"listing_id": "bigint", "review_id": "bigint", "reviewer_id": "bigint", "review_date": "date"},
    required=["listing_id", "review_date"],
    order=["listing_id", "review_date"],
)
LISTINGS_SUMMARY = Contract(
    columns={
        "id": "listing_id", "name": "name", "host_id": "host_id", "host_name": "host_name",
        "neighbourhood_group": "neighbourhood_group", "neighbourhood": "neighbourhood", "latitude": "latitude",
        "longitude": "longitude", "room_type": "room_type", "price": "price", "minimum_nights": "minimum_nights",
        "number_of_reviews": "number_of_reviews", "last_review": "last_review", "reviews_per_month": "reviews_per_month",
        "calculated_host_listings_count": "calculated_host_listings_count", "availability_365": "availability_365",
        "number_of_reviews_ltm": "number_of_reviews_ltm", "license": "license",
    },
    types={
        "listing_id": "bigint", "host_id": "bigint", "latitude": "float", "longitude": "float", "price": "money",
        "minimum_nights": "int", "number_of_reviews": "int", "last_review": "date", "reviews_per_month": "float",
        "calculated_host_listings_count": "int", "availability_365": "int", "number_of_reviews_ltm": "int",
    },
    order=["listing_id"],
)
REVIEWS_SUMMARY = Contract(
    columns={"listing_id": "listing_id", "date": "review_date"},
    types={"listing_id": "bigint", "review_date": "date"},
    required=["listing_id", "review_date"],
    order=["listing_id", "review_date"],
)
NEIGHBOURHOODS = Contract(
    columns={"neighbourhood_group": "neighbourhood_group", "neighbourhood": "neighbourhood"},
    types={},
    order=["neighbourhood"],
)


def _blank_to_null(df: DataFrame) -> DataFrame:
    """An empty CSV field is a missing value."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({c: F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")) for c in text})


def clean(raw: DataFrame, contract: Contract, mode: str = "null") -> DataFrame:
    """Rename, type, fill and filter by contract.

    The required columns are tested on the text, as in the source, and once more after typing, since a value
    that cannot be read is no key, date or position either. Missing source columns count as null.
    """
    carried = {c: c for c in CARRIED if c in raw.columns}
    absent = {src: F.lit(None).cast("string") for src in contract.columns if src not in raw.columns}
    named = project(raw.withColumns(absent) if absent else raw, {**contract.columns, **carried})
    filled = require_not_null(_blank_to_null(named), contract.required)
    typed = fill_defaults(coerce(filled, contract.types, mode), contract.defaults) if contract.types else filled
    typed = require_not_null(typed, contract.required)
    return typed.where(F.col(contract.positive) > 0) if contract.positive else typed


def clean_listings(raw: DataFrame, as_of=None, mode: str = "null") -> DataFrame:
    """Listings with a position and a positive price."""
    return with_load_date(clean(raw, LISTINGS, mode), as_of)


def clean_calendar(raw: DataFrame, mode: str = "null") -> DataFrame:
    return clean(raw, CALENDAR, mode)


def clean_reviews(raw: DataFrame, mode: str = "null") -> DataFrame:
    return clean(raw, REVIEWS, mode)


def clean_listings_summary(raw: DataFrame, mode: str = "null") -> DataFrame:
    return clean(raw, LISTINGS_SUMMARY, mode)


def clean_reviews_summary(raw: DataFrame, mode: str = "null") -> DataFrame:
    return clean(raw, REVIEWS_SUMMARY, mode)


def clean_neighbourhoods(raw: DataFrame) -> DataFrame:
    return clean(raw, NEIGHBOURHOODS)


def clean_geojson(raw: DataFrame) -> DataFrame:
    return geojson_features(raw)


def rejects(raw: DataFrame, contract: Contract) -> DataFrame:
    """How many values of each typed column could not be read."""
    named = project(raw, {s: n for s, n in contract.columns.items() if s in raw.columns})
    return rejected_counts(named, {c: t for c, t in contract.types.items() if c in named.columns})


def write_clean(df: DataFrame, contract: Contract, path: str) -> DataFrame:
    """Clean table to the silver folder, partitioned by city when there is one, sorted by the contract's order."""
    return write_silver(df, path, "city" if "city" in df.columns else None, contract.order)
