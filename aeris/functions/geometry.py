"""Point-in-polygon as a Spark expression (crossing-number / ray casting).

The ring is ``array<struct<x:double,y:double>>`` (open or closed). A point on
a left or bottom edge is inside and on a right or top edge outside, so cells
of a tiling are half-open and a point on a shared border belongs to exactly one
polygon. Evaluated with higher-order functions over the ring, inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def previous_vertices(ring: Column) -> Column:
    """The ring rotated by one: element i is vertex i-1 (vertex 0 → last)."""
    n = F.size(ring)
    return F.concat(F.slice(ring, -1, 1), F.slice(ring, F.lit(1), F.greatest(n - 1, F.lit(0))))


def point_in_ring(ring: Column, px: Column, py: Column) -> Column:
    """TRUE when (px, py) lies inside the ring; FALSE for rings of < 3 vertices."""
    px = px.cast("double")
    py = py.cast("double")

    def crosses(a: Column, b: Column) -> Column:
        straddles = (a["y"] > py) != (b["y"] > py)
        x_at_py = (b["x"] - a["x"]) * (py - a["y"]) / (b["y"] - a["y"]) + a["x"]
        return F.when(straddles, px < x_at_py).otherwise(F.lit(False))

    flags = F.zip_with(ring, previous_vertices(ring), crosses)
    odd = (F.size(F.filter(flags, lambda f: f)) % 2) == 1
    return F.when(F.size(ring) >= 3, odd).otherwise(F.lit(False))


def point_in_rings(rings: Column, px: Column, py: Column) -> Column:
    """TRUE when (px, py) lies in an odd number of the rings (parts of a polygon and their holes)."""
    return F.coalesce(F.size(F.filter(rings, lambda r: point_in_ring(r, px, py))) % 2 == 1, F.lit(False))


def ring_bounds(ring: Column) -> tuple[Column, Column, Column, Column]:
    """Bounding box (min x, min y, max x, max y) of a ring."""
    xs = F.transform(ring, lambda p: p["x"])
    ys = F.transform(ring, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)
