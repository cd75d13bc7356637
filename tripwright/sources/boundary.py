"""GeoJSON boundary (S06): FeatureCollection of Polygon / MultiPolygon -> one row per polygon, and its grid index.

Each polygon row carries its strict bounding box (outer ring) and the edges of all its rings, so the
point test (``functions.geo.within_boundary``) needs no geometry library.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

_FEATURES = "features array<struct<geometry:struct<type:string,coordinates:string>>>"
_GEOMETRY = "type string, coordinates string"
_POLYGON = "array<array<array<double>>>"
_MULTI = "array<array<array<array<double>>>>"
#: Place of a cell's anchor inside it; not a round part, so that no line of a map runs through an anchor.
ANCHOR_X, ANCHOR_Y = 0.6180339887498949, 0.3819660112501051


def _or_raise(value: Column, what: str, shown: Column) -> Column:
    return F.coalesce(value, F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(F.substring(shown, 1, 80), F.lit("nothing")))))


def _polygons_from_text(text_df: DataFrame) -> DataFrame:
    """One row per polygon. Other geometries and text that is no GeoJSON raise: a part of a map that is passed over
    would turn trips inside it into trips outside."""
    parsed = _or_raise(F.from_json("value", _FEATURES)["features"], "not a feature collection", F.col("value"))
    geoms = text_df.select(F.explode(parsed).alias("f"))
    return _polygons(geoms.select(F.col("f.geometry.type").alias("type"), F.col("f.geometry.coordinates").alias("coords")))


def _polygons(geoms: DataFrame) -> DataFrame:
    """Polygons of (type, coords)."""
    rings = F.when(F.col("type") == "Polygon", F.array(_or_raise(F.from_json("coords", _POLYGON), "unreadable polygon", F.col("coords"))))
    rings = rings.when(F.col("type") == "MultiPolygon", _or_raise(F.from_json("coords", _MULTI), "unreadable polygons", F.col("coords")))
    polys = geoms.select(F.explode(_or_raise(rings, "unsupported geometry", F.col("type"))).alias("rings"))

    def ring_edges(r: Column) -> Column:
        n = F.size(r)
        return F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(
                r[i][0].alias("x1"), r[i][1].alias("y1"),
                r[(i + 1) % n][0].alias("x2"), r[(i + 1) % n][1].alias("y2"),
            ),
        )

    outer = F.col("rings")[0]
    return polys.select(
        F.monotonically_increasing_id().alias("poly_id"),
        F.array_min(F.transform(outer, lambda p: p[0])).alias("xmin"),
        F.array_min(F.transform(outer, lambda p: p[1])).alias("ymin"),
        F.array_max(F.transform(outer, lambda p: p[0])).alias("xmax"),
        F.array_max(F.transform(outer, lambda p: p[1])).alias("ymax"),
        F.flatten(F.transform("rings", ring_edges)).alias("edges"),
    )


#: Edges that a cell lists before it is divided, and how often it is halved at most (edges that meet in one point stay together).
MOST_EDGES, DEEPEST = 64, 8


def _cells(polygons: DataFrame, base: float, depth: int = 0, wanted: DataFrame | None = None) -> DataFrame:
    """(poly_id, cx, cy, odd, edges): per grid cell that a polygon touches or covers, the edges that meet the cell and
    whether the cell's anchor point is inside (``odd``). The cells are those of the size ``base`` halved ``depth`` times;
    with ``wanted`` (poly_id, bx, by) only those within the base cells (bx, by).

    Whether a point is inside follows from its cell alone: the path from the anchor along the anchor's longitude and
    then along the point's latitude stays in the cell, so only the cell's edges can cross it. Edges are listed by
    the cells that they run through, row by row, which is linear in their number and length; the anchors of a row
    are decided by one running count of the edges that cross the row's line.
    """
    cell, parts = base / 2**depth, 2**depth
    edges = polygons.select("poly_id", F.inline("edges"))
    eps = cell * 1e-9
    at = lambda v: F.floor(v / F.lit(cell)).cast("long")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    if wanted is None:
        rows = edges.select("*", F.explode(F.sequence(at(low - eps), at(high + eps))).alias("cy"))
        grid = polygons.select("poly_id", F.explode(F.sequence(at(F.col("ymin")), at(F.col("ymax")))).alias("cy"), "xmin", "xmax")
        grid = grid.select("poly_id", "cy", F.explode(F.sequence(at(F.col("xmin")), at(F.col("xmax")))).alias("cx"))
    else:
        own = lambda v: F.floor(v / F.lit(base)).cast("long")
        rows = edges.select("*", F.explode(F.sequence(own(low - eps), own(high + eps))).alias("by"))
        rows = rows.join(wanted.select("poly_id", "by").distinct(), ["poly_id", "by"])
        first, last = F.greatest(at(low - eps), F.col("by") * parts), F.least(at(high + eps), F.col("by") * parts + (parts - 1))
        rows = rows.where(first <= last).withColumn("cy", F.explode(F.sequence(first, last))).drop("by")
        inner = lambda c: F.explode(F.sequence(F.col(c) * parts, F.col(c) * parts + (parts - 1)))
        grid = wanted.select("poly_id", "by", inner("bx").alias("cx")).select("poly_id", "cx", inner("by").alias("cy"))
    x_at = lambda y: F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))

    line = (F.col("cy") + ANCHOR_Y) * cell
    crossings = rows.where((F.col("y1") > line) != (F.col("y2") > line)).select(
        "poly_id", "cy", (F.ceil(x_at(line) / cell - ANCHOR_X) - 1).cast("long").alias("cx"))
    crossings = crossings.groupBy("poly_id", "cy", "cx").agg(F.count(F.lit(1)).alias("n"))
    to_the_right = Window.partitionBy("poly_id", "cy").orderBy(F.col("cx").desc()).rangeBetween(Window.unboundedPreceding, 0)
    both = grid.select("poly_id", "cy", "cx", F.lit(0).cast("long").alias("n"), F.lit(True).alias("is_cell")).unionByName(crossings.withColumn("is_cell", F.lit(False)))
    odd = both.withColumn("odd", F.sum("n").over(to_the_right) % 2).where("is_cell").select("poly_id", "cx", "cy", "odd")

    first, last = F.greatest(low, F.col("cy") * cell - eps), F.least(high, (F.col("cy") + 1) * cell + eps)
    left = F.coalesce(F.least(x_at(first), x_at(last)), F.least("x1", "x2"))
    right = F.coalesce(F.greatest(x_at(first), x_at(last)), F.greatest("x1", "x2"))
    listed = rows.select("poly_id", "cy", F.struct("x1", "y1", "x2", "y2").alias("e"), F.explode(F.sequence(at(left - eps), at(right + eps))).alias("cx"))
    if wanted is not None:
        here = [F.floor(F.col(c) / parts).cast("long") for c in ("cx", "cy")]
        listed = listed.withColumns({"bx": here[0], "by": here[1]}).join(wanted, ["poly_id", "bx", "by"])
    listed = listed.groupBy("poly_id", "cx", "cy").agg(F.collect_list("e").alias("edges"))
    return odd.join(listed, ["poly_id", "cx", "cy"], "left").where("odd = 1 or edges is not null")


def _index(cells: DataFrame, polygons: DataFrame) -> DataFrame:
    """(depth, cx, cy, polys) of (depth, poly_id, cx, cy, odd, edges): the polygons of each cell with their bounding box."""
    boxes = polygons.select("poly_id", "xmin", "ymin", "xmax", "ymax")
    none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")
    poly = F.struct("xmin", "ymin", "xmax", "ymax", F.col("odd").cast("int").alias("odd"), F.coalesce("edges", none).alias("edges"))
    return cells.join(boxes, "poly_id").groupBy("depth", "cx", "cy").agg(F.collect_list(poly).alias("polys"))


class Boundary:
    """Polygons of a boundary and, built on first use and stored, their grid index."""

    def __init__(self, polygons: DataFrame):
        self.polygons = polygons
        self._grid: tuple[float, DataFrame, DataFrame] | None = None

    def cells(self) -> tuple[float, DataFrame, DataFrame]:
        """(base size in degrees, index, divided): the base size gives about as many cells as there are edges. Where a map
        is more detailed than that, and a base cell lists over ``MOST_EDGES`` edges, the cell is halved until none of its parts
        does; ``divided`` has those base cells (bx, by) with their depth."""
        if self._grid is None:
            stored = materialize(self.polygons, "polygons")
            area = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
            total = stored.agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("area"), F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("n")).first()
            base = math.sqrt(total["area"] / total["n"]) if total["area"] > 0 and total["n"] else 1.0
            size = F.sum(F.coalesce(F.size("edges"), F.lit(0)))
            level = materialize(_cells(stored, base).withColumns({"bx": F.col("cx"), "by": F.col("cy")}), "cells-0")
            wanted = level.groupBy("bx", "by").agg(size.alias("n")).where(F.col("n") > MOST_EDGES)
            wanted = materialize(level.join(wanted.select("bx", "by"), ["bx", "by"]).select("poly_id", "bx", "by"), "dense-0")
            done = level.join(wanted.select("bx", "by").distinct(), ["bx", "by"], "left_anti").withColumn("depth", F.lit(0))
            divided = None
            for depth in range(1, DEEPEST + 1):
                if wanted.isEmpty():
                    break
                parent = [F.floor(F.col(c) / 2**depth).cast("long") for c in ("cx", "cy")]
                level = materialize(_cells(stored, base, depth, wanted).withColumns({"bx": parent[0], "by": parent[1]}), f"cells-{depth}")
                most = level.groupBy("bx", "by", "cx", "cy").agg(size.alias("n")).groupBy("bx", "by").agg(F.max("n").alias("n"))
                dense = most.where(F.col("n") > MOST_EDGES).select("bx", "by") if depth < DEEPEST else most.limit(0).select("bx", "by")
                ready = level.join(dense, ["bx", "by"], "left_anti").withColumn("depth", F.lit(depth))
                done = done.unionByName(ready)
                here = ready.select("bx", "by").distinct().withColumn("depth", F.lit(depth))
                divided = here if divided is None else divided.unionAll(here)
                wanted = materialize(wanted.join(dense, ["bx", "by"]).select("poly_id", "bx", "by"), f"dense-{depth}")
            if divided is None:
                divided = wanted.select("bx", "by", F.lit(0).alias("depth"))
            self._grid = base, materialize(_index(done, stored), "boundary-cells"), materialize(divided, "boundary-depths")
        return self._grid


def boundary_from_text(spark: SparkSession, geojson_text: str) -> Boundary:
    text = spark.createDataFrame([(geojson_text,)], "value string")
    return Boundary(_polygons_from_text(text))


def read_boundary(spark: SparkSession, path: str) -> Boundary:
    """Read a GeoJSON FeatureCollection (lon, lat order) from any Hadoop path.

    The file is cut at the name of its features' geometry as it is read, so a file of any size is read in parallel, a row per
    feature. Every feature's geometry must be a polygon or several; a file that names no feature collection raises.
    """
    pieces = spark.read.option("lineSep", '"geometry"').text(path)
    if not pieces.agg(F.coalesce(F.max(F.col("value").contains('"FeatureCollection"')), F.lit(False))).first()[0]:
        raise ValueError(f"not a feature collection: {path}")
    # what stands before the first feature's geometry does not begin with a colon
    found = pieces.where(F.col("value").rlike(r"^\s*:")).select(F.regexp_replace("value", r"^\s*:\s*", "").alias("value"))
    parsed = _or_raise(F.from_json("value", _GEOMETRY), "unreadable geometry", F.col("value"))
    return Boundary(_polygons(found.select(parsed.alias("g")).select("g.type", F.col("g.coordinates").alias("coords"))))
