"""Map projection, grid cells and the point-in-ring test."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the spherical web map projection.
EARTH_RADIUS_M = 6378137.0
MAX_LATITUDE = 85.05112878


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """x, y in metres; latitude is clamped to the projection's limit."""
    clamped = F.when(
        lat.isNotNull(), F.least(F.greatest(lat, F.lit(-MAX_LATITUDE)), F.lit(MAX_LATITUDE))
    )
    x = F.lit(EARTH_RADIUS_M) * F.radians(lon)
    y = F.lit(EARTH_RADIUS_M) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(clamped) / 2))
    return x, y


def pixel_id(metres: Column, size: float = 250.0) -> Column:
    """Cell number along one axis; floors, so it is right for negative coordinates."""
    return F.floor(metres / F.lit(size)).cast("bigint")


def ring_edges(ring: Column) -> Column:
    """Edges of a ring of points, closing it: array of struct (x1, y1, x2, y2)."""
    after = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(
        ring, after,
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def crosses_odd(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd test: a ray to the east crosses an odd number of edges. Edges are half-open
    in y, so a border shared by two polygons belongs to one of them."""
    def crosses(e: Column) -> Column:
        at = e["x1"] + F.try_divide((y - e["y1"]) * (e["x2"] - e["x1"]), e["y2"] - e["y1"])
        return ((e["y1"] <= y) != (e["y2"] <= y)) & (x < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1
