"""Distances on the sphere."""

from pyspark.sql import Column, functions as F

from txnlens.roles import EARTH_RADIUS_KM


def haversine_km(lat1, long1, lat2, long2) -> Column:
    """Great-circle distance in kilometres; the root is held at 1 so rounding cannot give NaN."""
    phi1, phi2 = F.radians(F.col(lat1)), F.radians(F.col(lat2))
    half_dphi = (phi2 - phi1) / 2
    half_dlam = (F.radians(F.col(long2)) - F.radians(F.col(long1))) / 2
    chord = F.pow(F.sin(half_dphi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlam), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.when(chord > 1, 1.0).otherwise(F.sqrt(chord)))
