"""Geodesic distance on the WGS-84 ellipsoid.

Vincenty's inverse formula, vectorised with numpy inside an Arrow UDF. It is applied to gap rows
only, never to raw messages. Where that iteration does not settle (nearly antipodal points) the
starting azimuth is found by bisection instead: the longitude reached at the second latitude grows
with the azimuth, so there is exactly one root (Karney, "Algorithms for geodesics", 2013).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# WGS-84 ellipsoid.
SEMI_MAJOR_M = 6378137.0
FLATTENING = 1 / 298.257223563
SEMI_MINOR_M = SEMI_MAJOR_M * (1 - FLATTENING)
SECOND_ECCENTRICITY_SQ = (SEMI_MAJOR_M**2 - SEMI_MINOR_M**2) / SEMI_MINOR_M**2

_MAX_ROUNDS = 24
_BISECTIONS = 60


def _longitude_correction(sin_az0, cos2_az0, sigma, sin_sigma, cos_sigma, cos_2sm):
    """Difference between spherical and ellipsoidal longitude along the line."""
    c = FLATTENING / 16 * cos2_az0 * (4 + FLATTENING * (4 - 3 * cos2_az0))
    return (1 - c) * FLATTENING * sin_az0 * (
        sigma + c * sin_sigma * (cos_2sm + c * cos_sigma * (2 * cos_2sm**2 - 1))
    )


def _arc_length(cos2_az0, sigma, sin_sigma, cos_sigma, cos_2sm):
    u2 = cos2_az0 * SECOND_ECCENTRICITY_SQ
    big_a = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    big_b = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    bend = big_b * sin_sigma * (
        cos_2sm
        + big_b / 4 * (
            cos_sigma * (2 * cos_2sm**2 - 1)
            - big_b / 6 * cos_2sm * (4 * sin_sigma**2 - 3) * (4 * cos_2sm**2 - 3)
        )
    )
    return SEMI_MINOR_M * big_a * (sigma - bend)


def _iterate(u1, u2, dlon):
    """Vincenty's iteration. Returns metres and a mask of the pairs that settled.

    A pair is left alone as soon as it settles, so its distance does not depend on the pairs beside it.
    """
    meters = np.full(len(dlon), np.nan)
    settled = np.zeros(len(dlon), dtype=bool)
    at, lam = np.arange(len(dlon)), dlon
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    for _ in range(_MAX_ROUNDS):
        sin_lam, cos_lam = np.sin(lam), np.cos(lam)
        sin_sigma = np.hypot(c2 * sin_lam, c1 * s2 - s1 * c2 * cos_lam)
        cos_sigma = s1 * s2 + c1 * c2 * cos_lam
        sigma = np.arctan2(sin_sigma, cos_sigma)
        sin_az0 = np.where(sin_sigma == 0, 0.0, c1 * c2 * sin_lam / np.where(sin_sigma == 0, 1, sin_sigma))
        cos2_az0 = 1 - sin_az0**2
        equatorial = cos2_az0 < 1e-15
        cos_2sm = np.where(
            equatorial, 0.0, cos_sigma - 2 * s1 * s2 / np.where(equatorial, 1, cos2_az0)
        )
        new = dlon + _longitude_correction(sin_az0, cos2_az0, sigma, sin_sigma, cos_sigma, cos_2sm)
        close = np.abs(new - lam) < 1e-13
        if close.any():
            done = at[close]
            meters[done] = _arc_length(*(v[close] for v in (cos2_az0, sigma, sin_sigma, cos_sigma, cos_2sm)))
            settled[done] = np.abs(new[close]) <= np.pi
            going = ~close
            at, new, dlon, s1, c1, s2, c2 = (v[going] for v in (at, new, dlon, s1, c1, s2, c2))
            if not len(at):
                break
        lam = new
    return meters, settled


def _bisect(u1, u2, dlon):
    """Root search on the starting azimuth, for pairs the iteration cannot solve."""
    # Canonical form: first point in the south and at least as far from the equator.
    swap = np.abs(u1) < np.abs(u2)
    u1, u2 = np.where(swap, u2, u1), np.where(swap, u1, u2)
    flip = u1 > 0
    u1, u2 = np.where(flip, -u1, u1), np.where(flip, -u2, u2)
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    s1 = np.where(s1 == 0, -0.0, s1)
    target = np.abs(dlon)

    def line(az1):
        sin_az0 = np.sin(az1) * c1
        cos2_az0 = 1 - sin_az0**2
        run1 = np.cos(az1) * c1
        run2 = np.sqrt(np.maximum(run1**2 + (c2**2 - c1**2), 0.0))
        sigma1, sigma2 = np.arctan2(s1, run1), np.arctan2(s2, run2)
        omega = np.arctan2(sin_az0 * s2, run2) - np.arctan2(sin_az0 * s1, run1)
        sigma = sigma2 - sigma1
        args = (sigma, np.sin(sigma), np.cos(sigma), np.cos(sigma1 + sigma2))
        return omega - _longitude_correction(sin_az0, cos2_az0, *args), cos2_az0, args

    low, high = np.zeros(len(u1)), np.full(len(u1), np.pi)
    for _ in range(_BISECTIONS):
        mid = (low + high) / 2
        short = line(mid)[0] < target
        low, high = np.where(short, mid, low), np.where(short, high, mid)
    _, cos2_az0, args = line((low + high) / 2)
    return _arc_length(cos2_az0, *args)


def inverse_m(lat1, lon1, lat2, lon2) -> np.ndarray:
    """Metres between points in degrees; NaN where a coordinate is missing or a latitude invalid."""
    lat1, lon1, lat2, lon2 = (np.asarray(v, dtype="float64") for v in (lat1, lon1, lat2, lon2))
    out = np.full(len(lat1), np.nan)
    good = np.isfinite(lat1) & np.isfinite(lon1) & np.isfinite(lat2) & np.isfinite(lon2)
    good &= (np.abs(np.nan_to_num(lat1)) <= 90) & (np.abs(np.nan_to_num(lat2)) <= 90)
    if not good.any():
        return out
    u1 = np.arctan((1 - FLATTENING) * np.tan(np.radians(lat1[good])))
    u2 = np.arctan((1 - FLATTENING) * np.tan(np.radians(lat2[good])))
    dlon = np.radians(np.remainder(lon2[good] - lon1[good] + 180.0, 360.0) - 180.0)
    meters, settled = _iterate(u1, u2, dlon)
    if not settled.all():
        hard = ~settled
        meters[hard] = _bisect(u1[hard], u2[hard], dlon[hard])
    out[good] = meters
    return out


@F.pandas_udf(T.DoubleType())
def _distance_m(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    meters = inverse_m(lat1, lon1, lat2, lon2)
    return pd.Series(meters).astype("Float64").mask(np.isnan(meters))


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Geodesic metres; null if any coordinate is null or a latitude is out of range."""
    return _distance_m(*(c.cast("double") for c in (lat1, lon1, lat2, lon2)))
