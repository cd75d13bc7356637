"""Deterministic trip inputs derived from the ``events`` table (see FIXTURES.md).

The same SQL text runs in Spark and, with the dialect tokens swapped, in DuckDB, so every oracle can
start from the identical fixture. All arithmetic is on integers until the final cast.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..schema import CLEAN_COLUMNS
from .boundary import Boundary, boundary_from_text

SPARK_TOKENS = {
    "{STR}": "STRING", "{TS}": "TIMESTAMP_NTZ",
    "{FMT}": "date_format", "{F}": "'dd/MM/yyyy HH:mm:ss'",
}
DUCKDB_TOKENS = {
    "{STR}": "VARCHAR", "{TS}": "TIMESTAMP",
    "{FMT}": "strftime", "{F}": "'%d/%m/%Y %H:%M:%S'",
}

# Fixed fixture definitions (FIXTURES.md section 2); the constants decide which edge cases occur.
TRIPS_SQL = """
WITH e AS (
  SELECT event_id, user_id,
         (EXTRACT(DAY FROM ts) - 1) * 86400 + EXTRACT(HOUR FROM ts) * 3600 + EXTRACT(MINUTE FROM ts) * 60
           + CAST(floor(EXTRACT(SECOND FROM ts)) AS BIGINT) AS x
  FROM __EVENTS__),
p AS (SELECT *, CAST((x - x % 30) / 30 AS BIGINT) AS s FROM e),
q AS (
  SELECT event_id, user_id,
         s + CAST((s - s % 14400) / 14400 AS BIGINT) * 864000 + (user_id % 7) * 86400 AS a,
         12200 + 100 * ((event_id * 7919) % 26) AS la, 1036000 + 100 * ((event_id * 104729) % 45) AS lo
  FROM p),
n AS (SELECT *, lead(a) OVER (PARTITION BY user_id ORDER BY a, event_id) - a AS g FROM q),
r AS (
  SELECT *, CASE WHEN event_id % 3 = 0 AND g BETWEEN 100 AND 3600 THEN g - event_id % 80
                 ELSE 60 + (event_id * 37) % 1500 END AS d
  FROM n)
SELECT concat('veh', CAST(user_id AS {STR})) AS vehicle_id, concat('drv', CAST((user_id * 3 + event_id % 2) AS {STR})) AS driver_id,
  concat('req', CAST(event_id AS {STR})) AS request_id, event_id,
  CAST('2022-02-01 00:00:00' AS {TS}) + INTERVAL '1' SECOND * a AS start_time,
  CAST('2022-02-01 00:00:00' AS {TS}) + INTERVAL '1' SECOND * (a + d) AS end_time,
  CAST(CAST(la AS DOUBLE) / 10000 AS DECIMAL(11,8)) AS latitude_pickup,
  CAST(CAST(lo AS DOUBLE) / 10000 AS DECIMAL(11,8)) AS longitude_pickup,
  CAST(CAST(la + 40 * ((event_id * 31) % 21 - 10) AS DOUBLE) / 10000 AS DECIMAL(11,8)) AS latitude_end,
  CAST(CAST(lo + 40 * ((event_id * 59) % 19 - 9) AS DOUBLE) / 10000 AS DECIMAL(11,8)) AS longitude_end
FROM r
"""

RAW_SQL = """
SELECT CASE event_id % 50
  WHEN 1 THEN concat(l9, ',extra') WHEN 2 THEN l8 ELSE l9 END AS line FROM (
 SELECT event_id, concat_ws(',', vehicle_id, driver_id, request_id, s, t, la, lo, la2) AS l8,
        concat_ws(',', vehicle_id, driver_id, request_id, s, t, la, lo, la2, lo2) AS l9 FROM (
  SELECT event_id, vehicle_id, driver_id, request_id,
   CASE event_id % 50 WHEN 3 THEN CAST(start_time AS {STR}) WHEN 4 THEN '31/02/2022 10:00:00'
        WHEN 7 THEN '01/01/1970 00:00:00' ELSE {FMT}(start_time, {F}) END AS s,
   {FMT}(end_time, {F}) AS t,
   CASE event_id % 50 WHEN 5 THEN '' WHEN 6 THEN '1000.5' ELSE CAST(latitude_pickup AS {STR}) END AS la,
   CAST(longitude_pickup AS {STR}) AS lo, CAST(latitude_end AS {STR}) AS la2, CAST(longitude_end AS {STR}) AS lo2
  FROM __TRIPS__) z) y
UNION ALL SELECT 'VEHICLE_ID,DRIVER_ID,REQUEST_ID,DT_START,DT_END,LATITUDE_PICKUP,LONGITUDE_PICKUP,LATITUDE_END,LONGITUDE_END'
"""

# Fixed fixture boundary (FIXTURES.md 2.3), lon/lat: a polygon with a hole, and a two-part multipolygon
# sharing the edge lon = 103.85 with it.
BOUNDARY_POLYGONS = [
    [[(103.6, 1.2), (103.85, 1.2), (103.85, 1.5), (103.6, 1.5)],
     [(103.7, 1.3), (103.74, 1.3), (103.74, 1.34), (103.7, 1.34)]],
    [[(103.85, 1.2), (104.0, 1.2), (104.0, 1.4), (103.85, 1.4)]],
    [[(104.0, 1.42), (104.08, 1.42), (104.04, 1.5)]],
]


def _closed(ring):
    return [list(p) for p in ring] + [list(ring[0])]


BOUNDARY_GEOJSON = json.dumps({
    "type": "FeatureCollection",
    "features": [
        {"type": "Feature", "properties": {"name": "A"},
         "geometry": {"type": "Polygon", "coordinates": [_closed(r) for r in BOUNDARY_POLYGONS[0]]}},
        {"type": "Feature", "properties": {"name": "B"},
         "geometry": {"type": "MultiPolygon",
                      "coordinates": [[_closed(r) for r in BOUNDARY_POLYGONS[1]],
                                      [_closed(r) for r in BOUNDARY_POLYGONS[2]]]}},
    ],
})


def dialect(sql: str, tokens: dict[str, str]) -> str:
    for k, v in tokens.items():
        sql = sql.replace(k, v)
    return sql


def duckdb_trips_cte() -> str:
    """``trips AS (...), raw AS (...)`` for the head of a DuckDB oracle."""
    trips = dialect(TRIPS_SQL, DUCKDB_TOKENS).replace("__EVENTS__", "events")
    raw = dialect(RAW_SQL, DUCKDB_TOKENS).replace("__TRIPS__", "trips")
    return f"trips AS ({trips}), raw AS ({raw})"


def duckdb_boundary_edges_cte() -> str:
    """``bnd_edges(poly, x1, y1, x2, y2)`` with the closing edge of every ring, as the Spark parser makes them."""
    rows = []
    for poly_id, rings in enumerate([BOUNDARY_POLYGONS[0], BOUNDARY_POLYGONS[1], BOUNDARY_POLYGONS[2]]):
        for ring in rings:
            pts = _closed(ring)
            n = len(pts)
            for i in range(n):
                (x1, y1), (x2, y2) = pts[i], pts[(i + 1) % n]
                rows.append(f"({poly_id}, {x1!r}::DOUBLE, {y1!r}::DOUBLE, {x2!r}::DOUBLE, {y2!r}::DOUBLE)")
    return f"bnd_edges(poly, x1, y1, x2, y2) AS (VALUES {', '.join(rows)})"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture ``trips`` (lower-case columns plus ``event_id``)."""
    sql = dialect(TRIPS_SQL, SPARK_TOKENS).replace("__EVENTS__", "{ev}")
    return spark.sql(sql, ev=events(spark, sf_dir))


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture trips in the clean-trip schema of the cleaning plan."""
    t = trips(spark, sf_dir)
    return t.select(*[t[c.lower()].alias(c) for c in CLEAN_COLUMNS])


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture raw text lines, as ``spark.read.text`` would give them (one ``value`` column)."""
    sql = dialect(RAW_SQL, SPARK_TOKENS).replace("__TRIPS__", "{tr}")
    return spark.sql(sql, tr=trips(spark, sf_dir)).withColumnRenamed("line", "value")


def boundary(spark: SparkSession) -> Boundary:
    return boundary_from_text(spark, BOUNDARY_GEOJSON)


#: A comb along a latitude: teeth of this width and gaps of the same width, hanging from a bar.
TEETH, TOOTH, BAR, TIP, LEFT = 5_000, 0.00002, 1.45, 1.25, 103.700003


def large_boundary_geojson() -> str:
    """A polygon with four edges per tooth (20,001 in all), for which containment is also plain arithmetic."""
    ring = [[LEFT, BAR + 0.05]]
    for i in range(TEETH):
        x = LEFT + 2 * i * TOOTH
        ring += [[x, TIP], [x + TOOTH, TIP], [x + TOOTH, BAR], [x + 2 * TOOTH, BAR]]
    ring[-1:] = [[LEFT + 2 * TEETH * TOOTH, BAR], [LEFT + 2 * TEETH * TOOTH, BAR + 0.05]]
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring + ring[:1]]}}]})


#: The same test in the oracle's dialect: in the bar, or below it in a tooth.
LARGE_BOUNDARY_TEST = (
    f"CAST(LONGITUDE_END > {LEFT} AND LONGITUDE_END < {LEFT + 2 * TEETH * TOOTH} AND LATITUDE_END > {TIP} AND LATITUDE_END < {BAR + 0.05} "
    f"AND (LATITUDE_END > {BAR} OR (LATITUDE_END < {BAR} OR LATITUDE_END = {BAR}) "
    f"AND floor((CAST(LONGITUDE_END AS DOUBLE) - {LEFT}) / {TOOTH}) % 2 = 0) AS INTEGER)"
)


#: A map of which nine edges in ten lie in a hundredth of its area: a wide comb, and a fine one (left, tooth, teeth, tip, bar, top).
DETAILED = ((103.600005, 0.0004, 450, 1.22, 1.40, 1.42), (103.7, 0.000001, 4_500, 1.445, 1.455, 1.46))


def _comb(left: float, tooth: float, teeth: int, tip: float, bar: float, top: float) -> list:
    ring = [[left, top]]
    for i in range(teeth):
        x = left + 2 * i * tooth
        ring += [[x, tip], [x + tooth, tip], [x + tooth, bar], [x + 2 * tooth, bar]]
    return ring + [[left + 2 * teeth * tooth, top], [left, top]]


def detailed_boundary_geojson() -> str:
    return json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [_comb(*c)]}} for c in DETAILED]})


#: Ends of trips (number n), half of them moved into the fine comb, in the middle of its teeth and gaps. Both dialects.
DETAILED_POINTS = """
SELECT REQUEST_ID, CAST(CASE WHEN n % 2 = 0 THEN 1.4405 + 0.001 * (n % 23) ELSE LATITUDE_END END AS DECIMAL(11,8)) AS lat,
  CAST(CASE WHEN n % 2 = 0 THEN 103.7000005 + 0.000001 * ((n * 7919) % 9100) ELSE LONGITUDE_END + 0.00000013 END AS DECIMAL(11,8)) AS lon
FROM placed"""


def detailed_boundary_test() -> str:
    """Whether a point is in one of the combs, as plain arithmetic in the oracle's dialect."""
    tests = [
        f"(lon > {left} AND lon < {left + 2 * teeth * tooth} AND lat > {tip} AND lat < {top} "
        f"AND (lat > {bar} OR floor((CAST(lon AS DOUBLE) - {left}) / {tooth}) % 2 = 0))"
        for left, tooth, teeth, tip, bar, top in DETAILED
    ]
    return f"CAST({' OR '.join(tests)} AS INTEGER)"
