"""Distances on a sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean radius of the earth in km.
EARTH_RADIUS_KM = 6371


def great_circle(lon1, lat1, lon2, lat2, on_null: float | None = 0.0) -> Column:
    """Great-circle distance in km of two points in degrees.

    ``on_null`` is the distance of a pair with a missing or non-numeric coordinate (``None`` keeps it null).
    """
    lam1, phi1, lam2, phi2 = (
        F.radians((c if isinstance(c, Column) else F.col(c)).try_cast("double")) for c in (lon1, lat1, lon2, lat2)
    )
    chord = F.pow(F.sin((phi2 - phi1) / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin((lam2 - lam1) / 2), 2)
    # Rounding can push antipodes past 1. A null stays null through the first argument.
    km = EARTH_RADIUS_KM * 2 * F.atan2(F.sqrt(chord), F.sqrt(F.greatest(1 - chord, F.lit(0.0))))
    return km if on_null is None else F.coalesce(km, F.lit(float(on_null)))
