"""Great-circle geometry as column expressions and as array functions, and polygons in WKT."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres; null if any coordinate is null. The root's argument is held in [0, 1]."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return F.when(h.isNotNull(), 2 * EARTH_M * F.asin(F.sqrt(F.least(F.greatest(h, F.lit(0.0)), F.lit(1.0)))))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return haversine_m(lat1, lon1, lat2, lon2) / 1000.0


def heading_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Compass-like direction of the step between two places, 0 to 360, measured with atan2 of the differences."""
    return F.pmod(F.degrees(F.atan2(lon2 - lon1, lat2 - lat1)), F.lit(360.0))


def metres(lat1: np.ndarray, lon1: np.ndarray, lat2: np.ndarray, lon2: np.ndarray) -> np.ndarray:
    """Great-circle metres of arrays."""
    a, b = np.radians(lat1), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin((np.radians(lon2) - np.radians(lon1)) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.clip(h, 0, 1)))


def rings(wkt: str | None) -> list[np.ndarray]:
    """Rings of a WKT POLYGON or MULTIPOLYGON as arrays of (longitude, latitude); nothing of a text that is none."""
    if not wkt or not re.match(r"\s*(MULTI)?POLYGON\b", wkt, re.I):
        return []
    out = []
    for body in re.findall(r"\(([^()]+)\)", wkt):
        try:
            ring = np.array([[float(x) for x in p.split()[:2]] for p in body.split(",")])
        except ValueError:
            return []
        if ring.ndim == 2 and ring.shape[1] == 2 and len(ring) >= 3:
            out.append(ring if (ring[0] == ring[-1]).all() else np.vstack([ring, ring[:1]]))
    return out


def inside(lon: np.ndarray, lat: np.ndarray, shape: list[np.ndarray]) -> np.ndarray:
    """Even-odd test against all rings at once, so that a second ring is a hole; points on an edge count as inside."""
    odd, on = np.zeros(len(lon), dtype=bool), np.zeros(len(lon), dtype=bool)
    for ring in shape:
        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:], strict=True):
            spans = (y1 > lat) != (y2 > lat)
            if spans.any():
                cross = x1 + (lat - y1) * (x2 - x1) / (y2 - y1) if y1 != y2 else np.full(len(lat), np.inf)
                odd ^= spans & (lon < cross)
            near = (lon >= min(x1, x2)) & (lon <= max(x1, x2)) & (lat >= min(y1, y2)) & (lat <= max(y1, y2))
            if near.any():
                on |= near & ((x2 - x1) * (lat - y1) == (y2 - y1) * (lon - x1))
    return odd | on
