"""Distances and offsets on latitude/longitude columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km."""
    phi1, phi2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    half_dphi = (phi2 - phi1) / 2.0
    half_dlam = (F.radians(_c(lon2)) - F.radians(_c(lon1))) / 2.0
    chord = F.sin(half_dphi) * F.sin(half_dphi) + F.cos(phi1) * F.cos(phi2) * F.sin(half_dlam) * F.sin(half_dlam)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.sqrt(chord), F.lit(1.0)))


def euclid_deg(lat, lon, clat, clon) -> Column:
    """Straight distance in degrees."""
    dlat, dlon = _c(lat) - _c(clat), _c(lon) - _c(clon)
    return F.sqrt(dlat * dlat + dlon * dlon)


def polar_offsets(lat, lon, clat, clon, with_centre: bool = False) -> list[Column]:
    """Offsets to the centre, their length and their angle; ``with_centre`` adds the centre, the same in every row."""
    dlat, dlon = _c(lat) - _c(clat), _c(lon) - _c(clon)
    centre = [_c(clat).alias("lat_center"), _c(clon).alias("lon_center")] if with_centre else []
    return [
        *centre,
        dlat.alias("rel_lat"),
        dlon.alias("rel_lon"),
        F.sqrt(dlat * dlat + dlon * dlon).alias("dist_radial"),
        F.atan2(dlat, dlon).alias("angle_radial"),
    ]


def local_distance(df: DataFrame, by, lat: str = "latitude", lon: str = "longitude", name: str = "dist_local") -> DataFrame:
    """Distance to the centroid of the row's own group; a missing coordinate counts as the centroid.

    The centroids are one row per group after a map-side combine; the join back is null-safe on the group.
    """
    from marketlake.functions.exact import mean_exact
    from marketlake.operators.joins import null_safe_lookup

    keys = [by] if isinstance(by, str) else list(by)
    centres = df.groupBy(*keys).agg(mean_exact(lat).alias("_clat"), mean_exact(lon).alias("_clon"))
    joined = null_safe_lookup(df, centres, keys)
    distance = haversine(F.coalesce(lat, "_clat"), F.coalesce(lon, "_clon"), "_clat", "_clon")
    return joined.withColumn(name, distance).drop("_clat", "_clon")
