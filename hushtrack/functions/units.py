"""Unit conversions and small predicates on positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METERS_PER_NAUTICAL_MILE = 1852.0

# Regional fisheries bodies whose authorisations are taken into account.
WHITELISTED_RFMOS = ("ICCAT", "IOTC", "WCPFC", "IATTC", "CCSBT", "SPRFMO", "NPFC")

# Message types of each transponder class.
CLASS_A_TYPES = ("AIS.1", "AIS.2", "AIS.3")
CLASS_B_TYPES = ("AIS.18", "AIS.19")


def ais_class(message_type: Column) -> Column:
    return F.when(message_type.isin(*CLASS_A_TYPES), F.lit("A")).when(
        message_type.isin(*CLASS_B_TYPES), F.lit("B")
    )


def implied_speed_knots(distance_m: Column, duration_h: Column) -> Column:
    """Null when the distance is unknown or the duration is zero."""
    return F.when(duration_h != 0.0, distance_m / duration_h / F.lit(METERS_PER_NAUTICAL_MILE))


def meters_to_km(m: Column) -> Column:
    return m / F.lit(1000.0)


def nautical_miles_to_km(nm: Column) -> Column:
    return nm * F.lit(1.852)


def is_whitelisted_rfmo(rfmo: Column) -> Column:
    return rfmo.isin(*WHITELISTED_RFMOS)


def antipodal_lon(lon: Column) -> Column:
    """Longitude of the opposite meridian; applying it twice gives the longitude back."""
    return F.when(lon < 0, lon + 180.0).otherwise(lon - 180.0)


def mean_lon(start: Column, end: Column, antimeridian_safe: bool = False) -> Column:
    """Mean of two longitudes.

    The plain mean lands on the wrong side of the globe for pairs that straddle the
    antimeridian; ``antimeridian_safe`` averages those on the opposite meridian instead.
    """
    plain = (start + end) / F.lit(2.0)
    if not antimeridian_safe:
        return plain
    shifted = antipodal_lon((antipodal_lon(start) + antipodal_lon(end)) / F.lit(2.0))
    return F.when(F.abs(start - end) > 180.0, shifted).otherwise(plain)


def least_or_first(first: Column, second: Column) -> Column:
    """Smaller of two values; a null second is ignored, a null first gives null."""
    return F.when(first.isNotNull(), F.least(first, F.coalesce(second, first)))


def lon_lat(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))
