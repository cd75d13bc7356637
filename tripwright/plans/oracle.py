"""DuckDB SQL for the oracle side of the correctness check: the fixture CTEs plus plain-SQL versions
of the per-vehicle folds (recursive CTEs over ``row_number`` per vehicle) and of the model build."""

from __future__ import annotations

from ..sources.fixtures import duckdb_boundary_edges_cte, duckdb_trips_cte

ORDER = ("START_TIME, END_TIME, REQUEST_ID, DRIVER_ID, LATITUDE_PICKUP, LONGITUDE_PICKUP, "
         "LATITUDE_END, LONGITUDE_END")

CT = ("ct AS (SELECT vehicle_id AS VEHICLE_ID, request_id AS REQUEST_ID, driver_id AS DRIVER_ID, "
      "start_time AS START_TIME, end_time AS END_TIME, latitude_pickup AS LATITUDE_PICKUP, "
      "longitude_pickup AS LONGITUDE_PICKUP, latitude_end AS LATITUDE_END, longitude_end AS LONGITUDE_END FROM trips)")

COLS = ("VEHICLE_ID, REQUEST_ID, DRIVER_ID, START_TIME, END_TIME, LATITUDE_PICKUP, LONGITUDE_PICKUP, "
        "LATITUDE_END, LONGITUDE_END")


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin((radians(CAST({lat2} AS DOUBLE)) - radians(CAST({lat1} AS DOUBLE))) / 2), 2) + "
         f"cos(radians(CAST({lat1} AS DOUBLE))) * cos(radians(CAST({lat2} AS DOUBLE))) * "
         f"pow(sin((radians(CAST({lon2} AS DOUBLE)) - radians(CAST({lon1} AS DOUBLE))) / 2), 2))")
    return f"(6371.0 * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"


def enrich(src: str, out: str) -> str:
    return (f"{out} AS (SELECT *, {hav('LATITUDE_PICKUP', 'LONGITUDE_PICKUP', 'LATITUDE_END', 'LONGITUDE_END')} AS distance, "
            f"CAST(epoch(END_TIME) - epoch(START_TIME) AS BIGINT) AS duration_s FROM {src})")


def d01(src: str, out: str) -> list[str]:
    return [
        f"{out}_n AS (SELECT *, row_number() OVER (PARTITION BY VEHICLE_ID ORDER BY {ORDER}) AS rn FROM {src})",
        f"{out}_r(VEHICLE_ID, rn, last_end, keep) AS ("
        f"SELECT VEHICLE_ID, rn, END_TIME, true FROM {out}_n WHERE rn = 1 UNION ALL "
        f"SELECT n.VEHICLE_ID, n.rn, CASE WHEN r.last_end > n.START_TIME THEN r.last_end ELSE n.END_TIME END, "
        f"NOT coalesce(r.last_end > n.START_TIME, false) FROM {out}_r r JOIN {out}_n n "
        f"ON n.VEHICLE_ID = r.VEHICLE_ID AND n.rn = r.rn + 1)",
        f"{out} AS (SELECT n.* EXCLUDE (rn) FROM {out}_n n JOIN {out}_r r USING (VEHICLE_ID, rn) WHERE r.keep)",
    ]


def d02(src: str, out: str, gap_s: int = 60, max_km: float = 6.0) -> list[str]:
    j = f"(epoch(n.START_TIME) - epoch(p.END_TIME) <= {gap_s} AND g.km < {max_km})"
    return [
        f"{out}_n AS (SELECT *, row_number() OVER (PARTITION BY VEHICLE_ID ORDER BY {ORDER}) AS rn FROM {src})",
        f"{out}_g(VEHICLE_ID, rn, gid, km, dur) AS ("
        f"SELECT VEHICLE_ID, rn, rn, distance, duration_s FROM {out}_n WHERE rn = 1 UNION ALL "
        f"SELECT n.VEHICLE_ID, n.rn, CASE WHEN {j} THEN g.gid ELSE n.rn END, "
        f"CASE WHEN {j} THEN g.km + n.distance ELSE n.distance END, "
        f"CASE WHEN {j} THEN g.dur + n.duration_s ELSE n.duration_s END "
        f"FROM {out}_g g JOIN {out}_n p ON p.VEHICLE_ID = g.VEHICLE_ID AND p.rn = g.rn "
        f"JOIN {out}_n n ON n.VEHICLE_ID = g.VEHICLE_ID AND n.rn = g.rn + 1)",
        f"{out}_last AS (SELECT VEHICLE_ID, gid, max(rn) AS lr FROM {out}_g GROUP BY VEHICLE_ID, gid)",
        f"{out} AS (SELECT f.VEHICLE_ID, f.REQUEST_ID, f.DRIVER_ID, f.START_TIME, l.END_TIME, f.LATITUDE_PICKUP, "
        f"f.LONGITUDE_PICKUP, l.LATITUDE_END, l.LONGITUDE_END, g.km AS distance, g.dur AS duration_s "
        f"FROM {out}_last x JOIN {out}_n f ON f.VEHICLE_ID = x.VEHICLE_ID AND f.rn = x.gid "
        f"JOIN {out}_n l ON l.VEHICLE_ID = x.VEHICLE_ID AND l.rn = x.lr "
        f"JOIN {out}_g g ON g.VEHICLE_ID = x.VEHICLE_ID AND g.rn = x.lr)",
    ]


def inside_points(src_points: str, out: str) -> list[str]:
    """``out(lat, lon, w)``: strict even-odd containment of each distinct point in any polygon, in exact arithmetic."""
    x, y = "CAST(p.lon AS DOUBLE)", "CAST(p.lat AS DOUBLE)"
    # coordinates times 2^52 are whole, so the side of an edge that a point is on is exact
    whole = lambda v: f"CAST(CAST({v} * 4503599627370496 AS BIGINT) AS HUGEINT)"
    turn = (f"(({whole('e.x2')} - {whole('e.x1')}) * ({whole(y)} - {whole('e.y1')}) "
            f"- ({whole('e.y2')} - {whole('e.y1')}) * ({whole(x)} - {whole('e.x1')}))")
    crosses = f"((e.y1 > {y}) <> (e.y2 > {y})) AND (({turn} > 0) = (e.y2 > e.y1))"
    on_edge = (f"{turn} = 0 "
               f"AND {x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
               f"AND {y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)")
    return [
        duckdb_boundary_edges_cte(),
        "bnd_box AS (SELECT poly, min(x1) AS xmin, max(x1) AS xmax, min(y1) AS ymin, max(y1) AS ymax FROM bnd_edges GROUP BY poly)",
        f"{out}_pe AS (SELECT p.lat, p.lon, e.poly, sum(CASE WHEN {crosses} THEN 1 ELSE 0 END) AS nx, "
        f"sum(CASE WHEN {on_edge} THEN 1 ELSE 0 END) AS non FROM {src_points} p, bnd_edges e "
        f"WHERE p.lat IS NOT NULL AND p.lon IS NOT NULL GROUP BY p.lat, p.lon, e.poly)",
        f"{out} AS (SELECT q.lat, q.lon, CAST(max(CASE WHEN CAST(q.lon AS DOUBLE) > b.xmin AND CAST(q.lon AS DOUBLE) < b.xmax "
        f"AND CAST(q.lat AS DOUBLE) > b.ymin AND CAST(q.lat AS DOUBLE) < b.ymax AND q.non = 0 AND q.nx % 2 = 1 "
        f"THEN 1 ELSE 0 END) AS INTEGER) AS w FROM {out}_pe q JOIN bnd_box b USING (poly) GROUP BY q.lat, q.lon)",
    ]


def typed_from_raw() -> list[str]:
    """V01..V11 on the raw fixture lines -> ``typed`` (clean columns)."""
    parts = ["VEHICLE_ID", "DRIVER_ID", "REQUEST_ID", "DT_START", "DT_END", "LATITUDE_PICKUP", "LONGITUDE_PICKUP",
             "LATITUDE_END", "LONGITUDE_END"]
    sel = ", ".join(f"string_split(line, ',')[{i + 1}] AS {c}" for i, c in enumerate(parts))
    shape = r"'\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}'"
    return [
        f"w9 AS (SELECT line AS value FROM raw WHERE len(string_split(line, ',')) = 9)",
        f"c9 AS (SELECT {sel} FROM raw WHERE len(string_split(line, ',')) = 9)",
        f"v3 AS (SELECT * FROM c9 WHERE regexp_full_match(DT_START, {shape}) AND regexp_full_match(DT_END, {shape}))",
        "v4 AS (SELECT * EXCLUDE (DT_START, DT_END), try_strptime(DT_START, '%d/%m/%Y %H:%M:%S') AS START_TIME, "
        "try_strptime(DT_END, '%d/%m/%Y %H:%M:%S') AS END_TIME FROM v3)",
        "v8 AS (SELECT VEHICLE_ID, DRIVER_ID, REQUEST_ID, START_TIME, END_TIME, "
        "TRY_CAST(LATITUDE_PICKUP AS DECIMAL(11,8)) AS LATITUDE_PICKUP, TRY_CAST(LONGITUDE_PICKUP AS DECIMAL(11,8)) AS LONGITUDE_PICKUP, "
        "TRY_CAST(LATITUDE_END AS DECIMAL(11,8)) AS LATITUDE_END, TRY_CAST(LONGITUDE_END AS DECIMAL(11,8)) AS LONGITUDE_END FROM v4)",
        "v9 AS (SELECT * FROM v8 WHERE START_TIME > TIMESTAMP '1970-01-01 00:00:00' AND END_TIME > TIMESTAMP '1970-01-01 00:00:00')",
        "v9pts AS (SELECT LATITUDE_PICKUP AS lat, LONGITUDE_PICKUP AS lon FROM v9 UNION SELECT LATITUDE_END, LONGITUDE_END FROM v9)",
        *inside_points("v9pts", "v9in"),
        f"typed AS (SELECT {', '.join('v9.' + c for c in COLS.split(', '))} FROM v9 "
        "JOIN v9in a ON a.lat = v9.LATITUDE_PICKUP AND a.lon = v9.LONGITUDE_PICKUP "
        "JOIN v9in b ON b.lat = v9.LATITUDE_END AND b.lon = v9.LONGITUDE_END WHERE a.w = 1 AND b.w = 1)",
    ]


def obt_chain() -> list[str]:
    """Fixture trips -> D01 -> distance/duration -> D02 -> distance > 1 -> wide table ``obt``."""
    return [CT, *d01("ct", "k1"), enrich("k1", "e1"), *d02("e1", "g2"),
            "obt AS (SELECT VEHICLE_ID, REQUEST_ID, DRIVER_ID, START_TIME AS DT_START, END_TIME AS DT_END, LATITUDE_PICKUP, "
            "LONGITUDE_PICKUP, LATITUDE_END, LONGITUDE_END, distance AS distance_km, duration_s FROM g2 WHERE distance > 1)"]


def star_chain() -> list[str]:
    rn = "row_number() OVER (ORDER BY {})"
    return obt_chain() + [
        "dim_vehicle AS (SELECT DISTINCT VEHICLE_ID FROM obt)",
        "dim_driver AS (SELECT DISTINCT DRIVER_ID FROM obt)",
        "dim_pickup_location AS (SELECT LATITUDE_PICKUP, LONGITUDE_PICKUP, "
        + rn.format("LATITUDE_PICKUP NULLS FIRST, LONGITUDE_PICKUP NULLS FIRST")
        + " AS PICKUP_LOCATION_ID FROM (SELECT DISTINCT LATITUDE_PICKUP, LONGITUDE_PICKUP FROM obt))",
        "dim_dropoff_location AS (SELECT LATITUDE_END AS LATITUDE_DROPOFF, LONGITUDE_END AS LONGITUDE_DROPOFF, "
        + rn.format("LATITUDE_END NULLS FIRST, LONGITUDE_END NULLS FIRST")
        + " AS DROPOFF_LOCATION_ID FROM (SELECT DISTINCT LATITUDE_END, LONGITUDE_END FROM obt))",
        "dim_pickup_time AS (SELECT DT_START AS PICKUP_DT, CAST(year(DT_START) AS INTEGER) AS year, "
        "CAST(month(DT_START) AS INTEGER) AS month, CAST(day(DT_START) AS INTEGER) AS day, "
        + rn.format("DT_START NULLS FIRST") + " AS PICKUP_TIME_ID FROM (SELECT DISTINCT DT_START FROM obt))",
        "dim_dropoff_time AS (SELECT DT_END AS DROPOFF_DT, CAST(year(DT_END) AS INTEGER) AS year, "
        "CAST(month(DT_END) AS INTEGER) AS month, CAST(day(DT_END) AS INTEGER) AS day, "
        + rn.format("DT_END NULLS FIRST") + " AS DROPOFF_TIME_ID FROM (SELECT DISTINCT DT_END FROM obt))",
        "fact_trips AS (SELECT " + rn.format("o.REQUEST_ID NULLS FIRST, o.VEHICLE_ID NULLS FIRST, o.DT_START NULLS FIRST")
        + " AS TRIP_ID, o.REQUEST_ID, o.VEHICLE_ID, o.DRIVER_ID, o.duration_s, o.distance_km, pt.PICKUP_TIME_ID, "
        "dt.DROPOFF_TIME_ID, pl.PICKUP_LOCATION_ID, dl.DROPOFF_LOCATION_ID FROM obt o "
        "LEFT JOIN dim_pickup_location pl ON o.LATITUDE_PICKUP = pl.LATITUDE_PICKUP AND o.LONGITUDE_PICKUP = pl.LONGITUDE_PICKUP "
        "LEFT JOIN dim_dropoff_location dl ON o.LATITUDE_END = dl.LATITUDE_DROPOFF AND o.LONGITUDE_END = dl.LONGITUDE_DROPOFF "
        "LEFT JOIN dim_pickup_time pt ON o.DT_START = pt.PICKUP_DT LEFT JOIN dim_dropoff_time dt ON o.DT_END = dt.DROPOFF_DT)",
        "trip_records AS (SELECT f.*, pt.PICKUP_DT, pt.year AS pickup_year, pt.month AS pickup_month, pt.day AS pickup_day, "
        "dt.DROPOFF_DT, dt.year AS dropoff_year, dt.month AS dropoff_month, dt.day AS dropoff_day, pl.LATITUDE_PICKUP, "
        "pl.LONGITUDE_PICKUP, dl.LATITUDE_DROPOFF, dl.LONGITUDE_DROPOFF FROM fact_trips f "
        "JOIN dim_pickup_time pt ON f.PICKUP_TIME_ID = pt.PICKUP_TIME_ID JOIN dim_dropoff_time dt ON f.DROPOFF_TIME_ID = dt.DROPOFF_TIME_ID "
        "JOIN dim_pickup_location pl ON f.PICKUP_LOCATION_ID = pl.PICKUP_LOCATION_ID "
        "JOIN dim_dropoff_location dl ON f.DROPOFF_LOCATION_ID = dl.DROPOFF_LOCATION_ID)",
    ]


def sql(ctes: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([duckdb_trips_cte(), *ctes]) + "\n" + select
