import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripwright.functions import haversine_km, parse_ts, shape_regex, within_boundary
from tripwright.functions.timefmt import duration_s


def test_shape_regex():
    assert shape_regex("dd/MM/yyyy HH:mm:ss") == r"^\d{2}/\d{2}/\d{4}\ \d{2}:\d{2}:\d{2}$"


def test_parse_ts_edges(spark):
    rows = [("01/02/2022 10:00:07",), ("31/02/2022 10:00:00",), ("99/99/2022 99:99:99",), ("",),
            ("2022-02-01 10:00:07",), ("01/02/2022 24:00:00",), ("01/02/2022 10:00:60",),
            ("01/02/2022 10:00:07\n",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.t for r in df.select(parse_ts("s", "dd/MM/yyyy HH:mm:ss").alias("t")).collect()]
    assert got == [datetime(2022, 2, 1, 10, 0, 7)] + [None] * 8
    assert df.select(parse_ts("s", "dd/MM/yyyy HH:mm:ss")).schema[0].dataType.typeName() == "timestamp_ntz"


def test_parse_other_patterns(spark):
    df = spark.createDataFrame([("2022-28-02 23:59:58",)], "s string")
    r = df.select(parse_ts("s", "yyyy-dd-MM HH:mm:ss").alias("t")).first()
    assert r.t == datetime(2022, 2, 28, 23, 59, 58)


def _py_hav(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    dlat, dlon = p2 - p1, math.radians(lon2) - math.radians(lon1)
    a = math.sin(dlat / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dlon / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_haversine_matches_python(spark):
    pts = [(1.3, 103.8, 1.35, 103.9), (1.22, 103.6, 1.22, 103.6), (-33.9, 151.2, 51.5, -0.12)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r.k for r in df.select(haversine_km("a", "b", "c", "d").alias("k")).collect()]
    for g, p in zip(got, pts):
        assert abs(g - _py_hav(*p)) < 1e-9


def test_duration(spark):
    df = spark.createDataFrame([(datetime(2022, 2, 1, 10), datetime(2022, 2, 1, 10, 1, 5))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(duration_s("a", "b").alias("d")).first().d == 65


def test_within_boundary_cases(spark, boundary):
    cases = [
        ((1.25, 103.65), 1),   # inside polygon 1
        ((1.32, 103.72), 0),   # inside the hole
        ((1.30, 103.72), 0),   # on the hole's edge
        ((1.35, 103.85), 0),   # on the edge shared by polygon 1 and 2
        ((1.2, 103.6), 0),     # on a vertex
        ((1.3, 103.9), 1),     # inside polygon 2
        ((1.45, 104.04), 1),   # inside the second part of the multipolygon
        ((1.41, 104.0), 0),    # in the gap between the parts
        ((1.34, 103.744), 1),  # on the line of the hole's edge, beside it
        ((1.3, 103.69), 1),
        ((1.46, 104.06), 0),   # on the slanted edge of the triangle
        ((1.0, 103.0), 0),     # far outside
        ((None, 103.7), None),
    ]
    from decimal import Decimal

    dec = lambda v: None if v is None else Decimal(str(v))
    df = spark.createDataFrame([(dec(a), dec(b)) for (a, b), _ in cases], "lat decimal(11,8), lon decimal(11,8)")
    got = [r.w for r in within_boundary(df, "lat", "lon", boundary, "w").collect()]
    assert got == [w for _, w in cases]


def test_boundary_polygons(spark, boundary):
    rows = boundary.polygons.orderBy("poly_id").collect()
    assert len(rows) == 3
    assert [len(r.edges) for r in rows] == [10, 5, 4]
    assert (rows[0].xmin, rows[0].ymax) == (103.6, 1.5)


def test_sql_function_registration(spark, boundary):
    from tripwright.functions import register_functions

    register_functions(spark, boundary)
    r = spark.sql("SELECT haversine_distance(1.3, 103.8, 1.35, 103.9) AS d, within_boundary(1.25, 103.65) AS w").first()
    assert abs(r.d - _py_hav(1.3, 103.8, 1.35, 103.9)) < 1e-9 and r.w == 1


def _py_inside(px, py, polys):
    """Strict even-odd containment in any polygon (list of rings of (x, y)); edges count as outside. Exact, in fractions."""
    from fractions import Fraction

    px, py = Fraction(px), Fraction(py)
    for rings in polys:
        rings = [[(Fraction(x), Fraction(y)) for x, y in ring] for ring in rings]
        xs = [x for x, _ in rings[0]]
        ys = [y for _, y in rings[0]]
        if not (min(xs) < px < max(xs) and min(ys) < py < max(ys)):
            continue
        crossings, on_edge = 0, False
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) == 0 and min(x1, x2) <= px <= max(x1, x2) \
                        and min(y1, y2) <= py <= max(y1, y2):
                    on_edge = True
                if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                    crossings += 1
        if not on_edge and crossings % 2 == 1:
            return 1
    return 0


def test_large_boundary_matches_brute_force(spark):
    import json
    import math
    import random
    from decimal import Decimal

    from tripwright.sources import boundary_from_text

    rnd = random.Random(7)
    n = 600
    outer = [(round(103.8 + (0.1 + 0.08 * rnd.random()) * math.cos(2 * math.pi * i / n), 6),
              round(1.35 + (0.1 + 0.08 * rnd.random()) * math.sin(2 * math.pi * i / n), 6)) for i in range(n)]
    hole = [(103.79, 1.34), (103.81, 1.34), (103.81, 1.36), (103.79, 1.36)]
    polys = [[outer, hole]]
    gj = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {
        "type": "Polygon", "coordinates": [[list(p) for p in r + r[:1]] for r in polys[0]]}}]}
    b = boundary_from_text(spark, json.dumps(gj))
    pts = [(round(1.35 + rnd.uniform(-0.2, 0.2), 6), round(103.8 + rnd.uniform(-0.2, 0.2), 6)) for _ in range(3000)]
    pts += [(y, x) for x, y in outer[:50]] + [((y1 + y2) / 2, (x1 + x2) / 2) for (x1, y1), (x2, y2) in zip(outer, outer[1:])][:50]
    df = spark.createDataFrame([(Decimal(repr(a)), Decimal(repr(o))) for a, o in pts], "lat decimal(11,8), lon decimal(11,8)")
    rows = within_boundary(df, "lat", "lon", b, "w").collect()
    expect = [_py_inside(float(r.lon), float(r.lat), polys) for r in rows]
    assert [r.w for r in rows] == expect
    assert 0 < sum(expect) < len(expect)


def test_many_polygons_and_shared_edges(spark):
    """Cells with several polygons, edges along cell borders and vertices on the points' lines."""
    import json
    import random
    from decimal import Decimal

    from tripwright.sources import boundary_from_text

    rnd = random.Random(3)
    polys = []
    for i in range(30):
        x, y = 103 + round(rnd.uniform(0, 1), 2), 1 + round(rnd.uniform(0, 1), 2)
        w, h = rnd.choice([0.01, 0.1, 0.3]), rnd.choice([0.01, 0.1, 0.3])
        polys.append([[(x, y), (round(x + w, 2), y), (round(x + w, 2), round(y + h, 2)), (x, round(y + h, 2))]] if i % 2 else
                     [[(x, y), (round(x + w, 2), round(y + h, 2)), (round(x - w, 2), round(y + h, 2))]])
    gj = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {
        "type": "MultiPolygon", "coordinates": [[[list(p) for p in r + r[:1]] for r in poly] for poly in polys]}}]}
    pts = [(round(rnd.uniform(0.9, 2.4), 2), round(rnd.uniform(102.6, 104.4), 2)) for _ in range(4000)]
    pts += [(round(rnd.uniform(0.9, 2.4), 6), round(rnd.uniform(102.6, 104.4), 6)) for _ in range(4000)]
    df = spark.createDataFrame([(Decimal(repr(a)), Decimal(repr(o))) for a, o in pts], "lat decimal(11,8), lon decimal(11,8)")
    rows = within_boundary(df, "lat", "lon", boundary_from_text(spark, json.dumps(gj)), "w").collect()
    expect = [_py_inside(float(r.lon), float(r.lat), polys) for r in rows]
    assert [r.w for r in rows] == expect and 0 < sum(expect) < len(expect)


@pytest.mark.parametrize("geometry", ['{"type": "LineString", "coordinates": [[1, 2], [3, 4]]}', '{"type": "Polygon", "coordinates": "x"}', "7"])
def test_unreadable_geometry_raises(spark, geometry):
    from tripwright.sources import boundary_from_text

    text = '{"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": %s}]}' % geometry
    with pytest.raises(Exception):
        boundary_from_text(spark, text).polygons.collect()
    with pytest.raises(Exception):
        boundary_from_text(spark, "no map").polygons.collect()


def test_detailed_cells_are_divided(spark):
    """Nine edges in ten in a hundredth of the area: no cell lists more than the bound, and every point is judged right."""
    from tripwright.functions import register_functions
    from tripwright.sources import boundary as B, boundary_from_text, fixtures

    b = boundary_from_text(spark, fixtures.detailed_boundary_geojson())
    _, index, divided = b.cells()
    most = index.selectExpr("depth", "aggregate(polys, 0, (n, p) -> n + size(p.edges)) AS n").groupBy("depth").max("n").collect()
    assert len(most) > 1 and max(r["max(n)"] for r in most) <= B.MOST_EDGES and divided.count() > 0
    (left, tooth, teeth, tip, bar, top) = fixtures.DETAILED[1]
    rows = [(1.4405 + 0.001 * (i % 23), round(left + tooth * (i * 37 % 9100) + tooth / 2, 8)) for i in range(4000)] + [(1.3, 103.65), (2.0, 50.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")

    def want(lat, lon):
        if lat is None:
            return None
        inside = lambda c: c[0] < lon < c[0] + 2 * c[2] * c[1] and c[3] < lat < c[5] and (lat > c[4] or int((lon - c[0]) / c[1]) % 2 == 0)
        return int(any(map(inside, fixtures.DETAILED)))

    assert [r.w for r in within_boundary(df, "lat", "lon", b, "w").collect()] == [want(*r) for r in rows]
    register_functions(spark, b)
    got = spark.sql("SELECT within_boundary(lat, lon) AS w FROM {df}", df=df).collect()
    assert [r.w for r in got] == [want(*r) for r in rows]


def test_read_boundary_in_parallel(spark, tmp_path):
    """A file is read a feature at a time, whatever its layout, and what is no map raises."""
    import json

    from tripwright.sources import fixtures, read_boundary

    collection = json.loads(fixtures.BOUNDARY_GEOJSON)
    collection["features"] += [
        {"geometry": {"coordinates": [[[i, 0], [i + 0.5, 0], [i, 0.5], [i, 0]]], "type": "Polygon"}, "type": "Feature", "properties": {"name": "x" * 500}}
        for i in range(2000)
    ]
    for name, text in (("compact", json.dumps(collection, separators=(",", ":"))), ("pretty", json.dumps(collection, indent=1))):
        (tmp_path / name).write_text(text)
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        try:
            polygons = read_boundary(spark, str(tmp_path / name)).polygons
            assert polygons.rdd.getNumPartitions() > 4
            rows = polygons.collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert len(rows) == 2003 and max(len(r.edges) for r in rows) == 10
        assert len({r.poly_id for r in rows}) == 2003 and sum(r.xmin == 103.6 for r in rows) == 1
    (tmp_path / "none").write_text('{"type": "Feature", "geometry": null}')
    with pytest.raises(Exception):
        read_boundary(spark, str(tmp_path / "none"))
    (tmp_path / "line").write_text('{"type": "FeatureCollection", "features": [{"geometry": {"type": "Point", "coordinates": [1, 2]}}]}')
    with pytest.raises(Exception):
        read_boundary(spark, str(tmp_path / "line")).polygons.collect()


def test_points_on_sloping_edges(spark):
    """Points as near to sloping edges as doubles come, on both sides and on the line, against fractions."""
    import json
    import math
    import random

    from tripwright.functions import register_functions
    from tripwright.sources import boundary_from_text

    rnd = random.Random(11)
    poly = [[(103.7, 1.2), (103.93, 1.31), (103.81, 1.47), (103.66, 1.39)], [(103.8, 1.3), (103.82, 1.33), (103.78, 1.34)]]
    gj = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {
        "type": "Polygon", "coordinates": [[list(p) for p in r + r[:1]] for r in poly]}}]}
    rows = []
    for ring in poly:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            for _ in range(150):
                t = rnd.random()
                x, y = x1 + (x2 - x1) * t, y1 + (y2 - y1) * t
                for _ in range(rnd.randrange(3)):
                    x = math.nextafter(x, rnd.choice([0, 200]))
                rows.append((y, x))
            rows += [((y1 + y2) / 2, (x1 + x2) / 2), (y1, x1)]
    want = [_py_inside(x, y, [poly]) for y, x in rows]
    b = boundary_from_text(spark, json.dumps(gj))
    df = spark.createDataFrame(rows, "lat double, lon double")
    assert [r.w for r in within_boundary(df, "lat", "lon", b, "w").collect()] == want and 100 < sum(want) < len(want) - 100
    register_functions(spark, b)
    assert [r.w for r in spark.sql("SELECT within_boundary(lat, lon) AS w FROM {df}", df=df).collect()] == want
