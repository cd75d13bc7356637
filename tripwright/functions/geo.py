"""Great-circle distance and the strict point-in-boundary test, both as JVM column expressions."""

from __future__ import annotations

import uuid
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import EARTH_RADIUS_KM

if TYPE_CHECKING:  # pragma: no cover
    from ..sources.boundary import Boundary


def _d(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km, R = 6371.0, ``2 * atan2(sqrt(a), sqrt(1 - a))``."""
    p1, p2 = F.radians(_d(lat1)), F.radians(_d(lat2))
    dlat = p2 - p1
    dlon = F.radians(_d(lon2)) - F.radians(_d(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(EARTH_RADIUS_KM) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


#: How far rounding can put the sign of an orientation test in doubles in doubt, as a part of the two products' sizes; and
#: what coordinates are multiplied by to be whole: doubles of 1 degree and more are then exact (smaller ones to 2^-53).
DOUBT, WHOLE = 3.4e-16, float(2**52)


def _turn(e, x, y) -> Column:
    """On which side of the line through an edge the point lies: 1 to the left of its direction, -1 to the right, 0 on it.

    In doubles where their rounding cannot change the sign, else in whole numbers, exactly."""
    a, b = (e["x2"] - e["x1"]) * (y - e["y1"]), (e["y2"] - e["y1"]) * (x - e["x1"])
    whole = lambda v, w: ((v * WHOLE).cast("long") - (w * WHOLE).cast("long")).cast("decimal(20,0)")
    exact = whole(e["x2"], e["x1"]) * whole(y, e["y1"]) - whole(e["y2"], e["y1"]) * whole(x, e["x1"])
    sign = lambda v: F.when(v > 0, 1).when(v < 0, -1).otherwise(0)
    return F.when(F.abs(a - b) > DOUBT * (F.abs(a) + F.abs(b)), sign(a - b)).otherwise(sign(exact))


def _on_edge(e, x, y):
    return (
        x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        & (_turn(e, x, y) == 0)
    )


def _path_crosses(e, x, y, ax, ay):
    """How often an edge crosses the path from the anchor (ax, ay) along its longitude to y and then along y to x."""
    over = lambda v: _turn(e, ax, v) * F.when(e["x2"] > e["x1"], 1).otherwise(-1) < 0  # noqa: E731 - the edge is above v at ax
    right = lambda v: _turn(e, v, y) * F.when(e["y2"] > e["y1"], 1).otherwise(-1) > 0  # noqa: E731 - the edge is right of v at y
    up = ((e["x1"] > ax) != (e["x2"] > ax)) & (over(ay) != over(y))
    along = ((e["y1"] > y) != (e["y2"] > y)) & (right(ax) != right(x))
    return F.when(up, 1).otherwise(0) + F.when(along, 1).otherwise(0)


def _contains(p, q):
    """Strict containment of point ``q`` (x, y and its cell's anchor) in polygon ``p`` as the index lists it there."""
    x, y = q["x"], q["y"]
    in_box = (x > p["xmin"]) & (x < p["xmax"]) & (y > p["ymin"]) & (y < p["ymax"])
    crossed = F.aggregate(p["edges"], p["odd"], lambda n, e: n + _path_crosses(e, x, y, q["ax"], q["ay"]))
    return in_box & ~F.exists(p["edges"], lambda e: _on_edge(e, x, y)) & (crossed % 2 == 1)


def within_boundary(df: DataFrame, lat: str, lon: str, boundary: "Boundary", out: str) -> DataFrame:
    """Adds ``out``: 1 if any polygon of ``boundary`` strictly contains (lon, lat), else 0; NULL coordinate -> NULL
    (F01). Holes count, and a point on an edge is not contained.

    One left equi-join with the grid index on the point's cell, whatever the size of the map: adaptive execution
    broadcasts a small index, and splits a busy cell of a large one. Each row then tests the few edges of its cell
    in a column expression. Where the map is detailed, the cell's depth is looked up first, in a table of those cells.
    """
    from ..sources.boundary import ANCHOR_X, ANCHOR_Y

    base, index, divided = boundary.cells()
    at = lambda c, size: F.floor(_d(c) / size).cast("long")
    keyed = df.withColumns({"_bx": at(lon, F.lit(base)), "_by": at(lat, F.lit(base))})
    if divided.isEmpty():
        keyed = keyed.withColumn("_depth", F.lit(0))
    else:
        depths = divided.select(F.col("bx").alias("_dx"), F.col("by").alias("_dy"), F.col("depth").alias("_d"))
        keyed = keyed.join(depths, (F.col("_bx") == F.col("_dx")) & (F.col("_by") == F.col("_dy")), "left")
        keyed = keyed.withColumn("_depth", F.coalesce("_d", F.lit(0)))
    # halving is exact, so a point's cell lies in its base cell
    cell = F.lit(base) / F.pow(F.lit(2.0), F.col("_depth"))
    keyed = keyed.withColumns({"_cx": at(lon, cell), "_cy": at(lat, cell), "_cell": cell})
    index = index.select(F.col("depth").alias("_id"), F.col("cx").alias("_icx"), F.col("cy").alias("_icy"), F.col("polys").alias("_polys"))
    same = (F.col("_cx") == F.col("_icx")) & (F.col("_cy") == F.col("_icy")) & (F.col("_depth") == F.col("_id"))
    joined = keyed.join(index, same, "left")
    ax, ay = (F.col("_cx") + ANCHOR_X) * F.col("_cell"), (F.col("_cy") + ANCHOR_Y) * F.col("_cell")
    point = F.array(F.struct(_d(lon).alias("x"), _d(lat).alias("y"), ax.alias("ax"), ay.alias("ay")))
    inside = F.exists(point, lambda q: F.exists("_polys", lambda p: _contains(p, q)))
    value = F.when(_d(lon).isNull() | _d(lat).isNull(), F.lit(None).cast("int")).otherwise(F.coalesce(inside, F.lit(False)).cast("int"))
    return joined.withColumn(out, value).select(*df.columns, out)


def register_functions(spark: SparkSession, boundary: "Boundary | None" = None) -> None:
    """SQL names for F02 (a SQL function, inlined into plans) and, given a boundary, F01."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION haversine_distance(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) "
        "RETURNS DOUBLE RETURN "
        f"{EARTH_RADIUS_KM} * 2 * atan2(sqrt(pow(sin((radians(lat2) - radians(lat1)) / 2), 2) "
        "+ cos(radians(lat1)) * cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2)), "
        "sqrt(1 - (pow(sin((radians(lat2) - radians(lat1)) / 2), 2) "
        "+ cos(radians(lat1)) * cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2))))"
    )
    if boundary is not None:
        from ..sources.boundary import ANCHOR_X, ANCHOR_Y

        base, index, divided = boundary.cells()
        # a name of its own for each map, so that a second one does not take the first one's place in functions made before
        view, depths = (f"boundary_{x}_{uuid.uuid4().hex}" for x in ("cells", "depths"))
        index.createOrReplaceTempView(view)
        divided.createOrReplaceTempView(depths)

        def turn(x: str, y: str) -> str:
            """``_turn`` as SQL."""
            a, b = f"(e.x2 - e.x1) * ({y} - e.y1)", f"(e.y2 - e.y1) * ({x} - e.x1)"
            whole = lambda v, w: f"CAST(CAST({v} * {WHOLE!r}D AS BIGINT) - CAST({w} * {WHOLE!r}D AS BIGINT) AS DECIMAL(20,0))"
            exact = f"{whole('e.x2', 'e.x1')} * {whole(y, 'e.y1')} - {whole('e.y2', 'e.y1')} * {whole(x, 'e.x1')}"
            return f"IF(abs({a} - {b}) > {DOUBT!r}D * (abs({a}) + abs({b})), signum({a} - {b}), signum({exact}))"

        over = lambda v: f"({turn('q.ax', v)} * IF(e.x2 > e.x1, 1, -1) < 0)"
        right = lambda v: f"({turn(v, 'q.y')} * IF(e.y2 > e.y1, 1, -1) > 0)"
        crosses = (f"IF((e.x1 > q.ax) <> (e.x2 > q.ax) AND {over('q.ay')} <> {over('q.y')}, 1, 0) + "
                   f"IF((e.y1 > q.y) <> (e.y2 > q.y) AND {right('q.ax')} <> {right('q.x')}, 1, 0)")
        on_edge = ("q.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) AND q.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) "
                   f"AND {turn('q.x', 'q.y')} = 0")
        contains = (f"q.x > p.xmin AND q.x < p.xmax AND q.y > p.ymin AND q.y < p.ymax AND NOT exists(p.edges, e -> {on_edge}) "
                    f"AND aggregate(p.edges, p.odd, (n, e) -> n + {crosses}) % 2 = 1")
        kind = index.schema["polys"].dataType.simpleString()
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION any_contains(polys {kind}, lat DOUBLE, lon DOUBLE, cell DOUBLE) RETURNS BOOLEAN RETURN "
            f"exists(array(named_struct('x', lon, 'y', lat, 'ax', (floor(lon / cell) + {ANCHOR_X!r}D) * cell, "
            f"'ay', (floor(lat / cell) + {ANCHOR_Y!r}D) * cell)), q -> exists(polys, p -> {contains}))"
        )

        def found(depth: str) -> str:
            """Whether the cell of a depth holds the point: for each depth that the map has, cells of the others have no polygons."""
            cell = f"({base!r}D / {2.0 ** int(depth)!r}D)"
            polys = (f"(SELECT any_value(polys) FROM {view} WHERE depth = {depth} AND cx = CAST(floor(lon / {cell}) AS BIGINT) "
                     f"AND cy = CAST(floor(lat / {cell}) AS BIGINT))")
            return f"coalesce(any_contains({polys}, lat, lon, {cell}), false)"

        held = [str(r[0]) for r in index.select("depth").distinct().orderBy("depth").collect()]  # at most DEEPEST + 1 numbers
        spark.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION within_boundary(lat DOUBLE, lon DOUBLE) RETURNS INT RETURN "
            "CASE WHEN lat IS NULL OR lon IS NULL THEN CAST(NULL AS INT) ELSE CAST("
            f"{' OR '.join(map(found, held)) or 'false'} AS INT) END"
        )
