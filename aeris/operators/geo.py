"""Spatial join: assign each station (point) to the commune polygon containing it.

Replaces the per-point reverse-geocode HTTP call with one Spark plan over a
commune reference table (``schemas.COMMUNE``):

1. every commune is cut up by grid cells: a cell holds, of each commune that can
   contain a point of it, only the edges that reach into the cell's row at its
   columns, and what tells the side of all edges further right (see
   ``commune_cells``). A detailed outline is spread over its cells, whole rings
   are copied nowhere, and a cell inside a commune is a single flag. Communes
   much larger than a cell go to a coarser grid;
2. every point looks up its single cell on each grid with an equi-join, whose
   kind Spark picks from the sizes it knows or measures (AQE splits a hot
   cell) — many-to-one joins, so points are never multiplied and no groupBy
   follows;
3. after each join the lowest-code candidate that contains the point is kept
   and the candidates are dropped, so no edge travels on with a point; the
   lower code of both grids wins, and no hit keeps the point with NULL fields.

A commune may have several rings (``rings``: parts and holes): a point is
inside when it lies in an odd number of them. The result equals testing every
commune's rings. Cells are half-open, so a point on a shared border matches one
side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeris.functions.geometry import previous_vertices, ring_bounds

#: What a hit tells about its commune.
COMMUNE_FIELDS = ("code", "nom", "codesPostaux", "population")


def _by_code(a: Column, b: Column) -> Column:
    ca, cb = a["code"], b["code"]
    return (
        F.when(ca.isNull() & cb.isNull(), 0)
        .when(ca.isNull(), 1)
        .when(cb.isNull(), -1)
        .when(ca < cb, -1)
        .when(ca > cb, 1)
        .otherwise(0)
    )


def with_rings(communes: DataFrame) -> DataFrame:
    """The communes with all their rings in ``rings``: that column, or the one ``ring`` where it is absent or NULL."""
    ring = F.array("ring") if "ring" in communes.columns else None
    rings = F.col("rings") if "rings" in communes.columns else None
    both = rings if ring is None else ring if rings is None else F.coalesce(rings, ring)
    return communes.select(*COMMUNE_FIELDS, both.alias("rings"))


def _spans(rings: Column, cell_size: float) -> tuple[Column, Column, Column, Column]:
    """First and last cell of the rings' bounding box on each axis."""
    minx, miny, maxx, maxy = ring_bounds(F.flatten(rings))
    size = F.lit(float(cell_size))
    return F.floor(minx / size), F.floor(maxx / size), F.floor(miny / size), F.floor(maxy / size)


def _edges(rings: Column) -> Column:
    """All edges of the rings that a ray can cross, as (vertex, vertex before); a ring of less than 3 vertices has none."""
    def of_ring(ring: Column) -> Column:
        pairs = F.zip_with(ring, previous_vertices(ring), lambda a, b: F.struct(
            a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
        return F.filter(pairs, lambda e: e["ax"].isNotNull() & e["bx"].isNotNull() & (e["ay"] != e["by"]))

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) >= 3), of_ring))


#: Part of a cell by which an edge counts as reaching a neighbouring column, against rounding where it ends on the border.
_MARGIN = 1e-6


def commune_cells(communes: DataFrame, cell_size: float) -> DataFrame:
    """(cx, cy, candidates): the communes that may contain a point of a grid cell, by code. Each has the commune's fields and

    * ``edges``: its edges in the cell's row (floor(y / size) = cy) and columns, which are tested one by one;
    * ``ys`` and ``inside``: an edge further right counts for a point if one end is above it and the other not, whatever its x. Over all
      of them that is whether an odd number of their ends lies above, so ends that occur twice, as all vertices inside a run of such edges do,
      cancel; ends above the row make the flag ``inside``, ends below count for nothing, and ``ys`` are the ends within the row.

    So a cell's size follows the edges that cross it. Communes that repeat in all columns are taken once."""
    size = F.lit(float(cell_size))
    whole = with_rings(communes).withColumn("id", F.sha2(F.to_json(F.struct("*")), 256))
    least_x, _, _, _ = ring_bounds(F.flatten("rings"))  # in the aggregation: behind the explode it would be worked out for every edge
    one = whole.groupBy("id").agg(F.first(F.struct(*COMMUNE_FIELDS)).alias("c"), F.first("rings").alias("rings"),
                                  F.first(F.floor(least_x / size - _MARGIN)).alias("x0"))
    e = F.col("e")
    edges = one.select("id", "c", "x0", F.explode(_edges(F.col("rings"))).alias("e"))
    left = F.floor(F.least(e["ax"], e["bx"]) / size - _MARGIN)
    right = F.floor(F.greatest(e["ax"], e["bx"]) / size + _MARGIN)
    rows = F.sequence(F.floor(F.least(e["ay"], e["by"]) / size), F.floor(F.greatest(e["ay"], e["by"]) / size))
    ends = F.array(e["ay"], e["by"])
    none = F.array().cast("array<double>")
    edge = edges.schema["e"].dataType
    cell = f"array<struct<cx:bigint,edge:{edge.simpleString()},ys:array<double>>>"
    cells = F.concat(
        F.transform(F.sequence(left, right), lambda x: F.struct(x, e, none)).cast(cell),
        F.when(left > F.col("x0"), F.transform(F.sequence(F.col("x0"), left - 1), lambda x: F.struct(x, F.lit(None).cast(edge), ends)).cast(cell))
        .otherwise(F.array().cast(cell)))
    reached = edges.select("id", "c", e, F.explode(rows).alias("cy"), cells.alias("cells")).select("id", "c", "cy", F.explode("cells").alias("s"))
    held = reached.groupBy("id", F.col("s.cx").alias("cx"), "cy").agg(
        F.first("c").alias("c"), F.collect_list("s.edge").alias("edges"), F.flatten(F.collect_list("s.ys")).alias("ys"))
    # of sorted ends, equal neighbours cancel
    odd = F.aggregate(F.array_sort("ys"), none, lambda kept, y: F.when(
        F.coalesce(F.try_element_at(kept, F.lit(-1)) == y, F.lit(False)), F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(F.concat(kept, F.array(y))))
    row = lambda y: F.floor(y / size)
    held = held.withColumn("odd", odd).select(
        "cx", "cy", F.struct(*[F.col("c")[f].alias(f) for f in COMMUNE_FIELDS], "edges",
                             F.filter("odd", lambda y: row(y) == F.col("cy")).alias("ys"),
                             (F.size(F.filter("odd", lambda y: row(y) > F.col("cy"))) % 2 == 1).alias("inside")).alias("c"))
    # a commune that lies wholly to one side of the cell contains nothing of it; told here and not by a filter, which
    # would work the ends out once more
    some = (F.size("c.edges") > 0) | (F.size("c.ys") > 0) | F.col("c.inside")
    return held.groupBy("cx", "cy").agg(F.array_sort(F.collect_list(F.when(some, F.col("c"))), _by_code).alias("candidates"))


def cell_contains(candidate: Column, px: Column, py: Column) -> Column:
    """Whether a candidate of the point's cell contains it: an odd number of the ray's crossings to the right."""
    px, py = px.cast("double"), py.cast("double")

    def crosses(e: Column) -> Column:
        straddles = (e["ay"] > py) != (e["by"] > py)
        return straddles & (px < (e["bx"] - e["ax"]) * (py - e["ay"]) / (e["by"] - e["ay"]) + e["ax"])

    crossed = F.size(F.filter(candidate["edges"], crosses)) + F.size(F.filter(candidate["ys"], lambda y: y > py))
    return F.coalesce((crossed + candidate["inside"].cast("int")) % 2 == 1, F.lit(False))


def cells_spanned(rings: Column, cell_size: float) -> Column:
    """Number of grid cells the rings' bounding box touches."""
    x0, x1, y0, y1 = _spans(rings, cell_size)
    return (x1 - x0 + 1) * (y1 - y0 + 1)


def assign_communes(
    points: DataFrame,
    communes: DataFrame,
    cell_size: float = 0.05,
    lon: str = "city_longitude",
    lat: str = "city_latitude",
    max_cells: int = 64,
    coarse_factor: int = 16,
) -> DataFrame:
    """Points (location_id, city_longitude, city_latitude) → one row per point:
    location_id, longitude, latitude, nom, code, codesPostaux, population.

    ``cell_size`` is in coordinate units (degrees); it only affects speed.
    Communes whose bounding box spans more than ``max_cells`` cells are listed
    on a second grid ``coarse_factor`` times coarser, so a very large polygon
    is not copied into thousands of cells; each point looks up its cell on
    both grids (two many-to-one joins) and the lowest code among the
    containing candidates of both wins.
    """
    px, py = F.col(lon), F.col(lat)
    shaped = with_rings(communes)
    span = cells_spanned(F.col("rings"), cell_size)
    levels = [
        ("fine", float(cell_size), shaped.where(span <= max_cells)),
        ("coarse", float(cell_size) * coarse_factor, shaped.where(~(span <= max_cells))),
    ]
    joined = points
    for name, size, subset in levels:
        cx, cy = f"__{name}_x", f"__{name}_y"
        joined = joined.withColumn(cx, F.floor(px.cast("double") / F.lit(size))).withColumn(
            cy, F.floor(py.cast("double") / F.lit(size)))
        cells = commune_cells(subset, size).select(F.col("cx").alias(cx), F.col("cy").alias(cy), "candidates")
        # the candidates are sorted, so the first that contains the point is the lowest
        hit = F.get(F.filter("candidates", lambda c: cell_contains(c, px, py)), 0)
        joined = joined.join(cells, [cx, cy], "left").withColumn("__hit", hit)  # a column, so that it is worked out once
        joined = joined.select(*[c for c in joined.columns if c not in (cx, cy, "candidates", "__hit")], F.when(
            F.col("__hit").isNotNull(), F.struct(*[F.col("__hit")[f].alias(f) for f in COMMUNE_FIELDS])).alias(f"__{name}"))
    hits = F.array_sort(F.filter(F.array(*[f"__{name}" for name, _, _ in levels]), lambda h: h.isNotNull()), _by_code)
    hit = F.get(hits, 0)
    return joined.select(
        "location_id",
        px.alias("longitude"),
        py.alias("latitude"),
        hit["nom"].alias("nom"),
        hit["code"].alias("code"),
        hit["codesPostaux"].alias("codesPostaux"),
        hit["population"].alias("population"),
    )
