"""The named analytic queries, each on the wide table (``*_obt``) and on the star schema (``*_star``).

Grouped results are sorted as the reference sorts them, with the grouping keys added as tie-breaks so
the order is total. Filters stay declarative so they reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ids import every_nth
from ..operators.validate import by_prefix, trips_of_vehicle, trips_on_day

Star = dict[str, DataFrame]

TRIP_RECORD_COLUMNS = [
    "TRIP_ID", "REQUEST_ID", "VEHICLE_ID", "DRIVER_ID", "duration_s", "distance_km",
    "PICKUP_TIME_ID", "DROPOFF_TIME_ID", "PICKUP_LOCATION_ID", "DROPOFF_LOCATION_ID",
    "PICKUP_DT", "pickup_year", "pickup_month", "pickup_day",
    "DROPOFF_DT", "dropoff_year", "dropoff_month", "dropoff_day",
    "LATITUDE_PICKUP", "LONGITUDE_PICKUP", "LATITUDE_DROPOFF", "LONGITUDE_DROPOFF",
]


def top(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows of a sorted result (O04); planned as ``TakeOrderedAndProject``."""
    return df.limit(n)


# ------------------------------------------------------------------ wide table

def q1_obt(t: DataFrame) -> DataFrame:
    """Mean distance and duration per vehicle and month."""
    return (t.groupBy("VEHICLE_ID", F.month("DT_START").alias("Month"))
            .agg(F.avg("distance_km").alias("average_distance_per_month"),
                 F.avg("duration_s").alias("average_duration_per_month"))
            .orderBy("VEHICLE_ID", "Month"))


def _count_by(t: DataFrame, keys: list, name: str) -> DataFrame:
    out = t.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.col(name).desc(), *[F.col(c) for c in out.columns if c != name])


def q2_obt(t: DataFrame) -> DataFrame:
    """Most common pickup points."""
    return _count_by(t, [F.col("LATITUDE_PICKUP").alias("latitude_pickup"),
                         F.col("LONGITUDE_PICKUP").alias("longitude_pickup")], "num_pickups")


def q3_obt(t: DataFrame) -> DataFrame:
    """Most common drop-off points."""
    return _count_by(t, [F.col("LATITUDE_END").alias("latitude_end"),
                         F.col("LONGITUDE_END").alias("longitude_end")], "num_dropoffs")


def q4_obt(t: DataFrame) -> DataFrame:
    """Most common pickup hour."""
    return _count_by(t, [F.hour("DT_START").alias("pickup_hour")], "num_hour_pickups")


def q5_obt(t: DataFrame) -> DataFrame:
    """Most common drop-off hour."""
    return _count_by(t, [F.hour("DT_END").alias("dropoff_hour")], "num_hour_dropoffs")


def q6_obt(t: DataFrame) -> DataFrame:
    """All trips of every second vehicle (ranked by id). The distinct vehicle list is a semi-join side."""
    sampled = every_nth(t.select("VEHICLE_ID"), "VEHICLE_ID", 2)
    return t.join(sampled, "VEHICLE_ID", "left_semi").select(*t.columns)


def q7_obt(t: DataFrame, day: int = 12) -> DataFrame:
    """All trips starting on day ``day`` of a month."""
    return trips_on_day(t, day, "DT_START")


def q8_obt(t: DataFrame, vehicle_id: str) -> DataFrame:
    """All trips of one vehicle."""
    return trips_of_vehicle(t, vehicle_id)


def q10_obt(t: DataFrame, prefix: str) -> DataFrame:
    """Trips whose request id starts with ``prefix``."""
    return by_prefix(t, "REQUEST_ID", prefix)


# ------------------------------------------------------------------ star schema

def trip_records(s: Star, how: str = "inner") -> DataFrame:
    """Fact joined to its four location / time dimensions, one column per name."""
    f = s["fact_trips"]
    pt = s["dim_pickup_time"].select("PICKUP_TIME_ID", "PICKUP_DT", *[F.col(c).alias(f"pickup_{c}") for c in ("year", "month", "day")])
    dt = s["dim_dropoff_time"].select("DROPOFF_TIME_ID", "DROPOFF_DT", *[F.col(c).alias(f"dropoff_{c}") for c in ("year", "month", "day")])
    out = (f.join(pt, "PICKUP_TIME_ID", how).join(dt, "DROPOFF_TIME_ID", how)
           .join(s["dim_pickup_location"], "PICKUP_LOCATION_ID", how)
           .join(s["dim_dropoff_location"], "DROPOFF_LOCATION_ID", how))
    return out.select(*TRIP_RECORD_COLUMNS)


def _mean(total: str, n: str):
    return F.try_divide(F.sum(total).cast("double"), F.sum(n))


def q1_star(s: Star) -> DataFrame:
    """Sums per vehicle and time id are made before the join, so it sees one row for each of them."""
    sums = s["fact_trips"].groupBy("VEHICLE_ID", "PICKUP_TIME_ID").agg(
        F.sum("distance_km").alias("_km"), F.count("distance_km").alias("_n_km"),
        F.sum("duration_s").alias("_s"), F.count("duration_s").alias("_n_s"))
    return (sums.join(s["dim_pickup_time"], "PICKUP_TIME_ID").groupBy("VEHICLE_ID", F.col("month").alias("Month"))
            .agg(_mean("_km", "_n_km").alias("average_distance_per_month"), _mean("_s", "_n_s").alias("average_trip_duration"))
            .orderBy("VEHICLE_ID", "Month"))


def _count_through(s: Star, dim: str, key: str, by: list, name: str) -> DataFrame:
    """Trips per attribute of a dimension. They are counted by the dimension's key first (combined before the
    shuffle, so a busy key is one row) and the small result is joined."""
    counts = s["fact_trips"].groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    out = counts.join(s[dim], key).groupBy(*by).agg(F.sum("_n").alias(name))
    return out.orderBy(F.col(name).desc(), *[F.col(c) for c in out.columns if c != name])


def q2_star(s: Star) -> DataFrame:
    by = [F.col("LATITUDE_PICKUP").alias("latitude_pickup"), F.col("LONGITUDE_PICKUP").alias("longitude_pickup")]
    return _count_through(s, "dim_pickup_location", "PICKUP_LOCATION_ID", by, "num_pickups")


def q3_star(s: Star) -> DataFrame:
    by = [F.col("LATITUDE_DROPOFF").alias("latitude_dropoff"), F.col("LONGITUDE_DROPOFF").alias("longitude_dropoff")]
    return _count_through(s, "dim_dropoff_location", "DROPOFF_LOCATION_ID", by, "num_dropoffs")


def q4_star(s: Star) -> DataFrame:
    return _count_through(s, "dim_pickup_time", "PICKUP_TIME_ID", [F.hour("PICKUP_DT").alias("pickup_hour")], "num_hour_pickups")


def q5_star(s: Star) -> DataFrame:
    return _count_through(s, "dim_dropoff_time", "DROPOFF_TIME_ID", [F.hour("DROPOFF_DT").alias("dropoff_hour")], "num_hour_dropoffs")


def q6_star(s: Star) -> DataFrame:
    sampled = every_nth(s["dim_vehicle"], "VEHICLE_ID", 2)
    return trip_records(s).join(sampled, "VEHICLE_ID", "left_semi").select(*TRIP_RECORD_COLUMNS)


def q7_star(s: Star, day: int = 12) -> DataFrame:
    return trip_records(s).filter(F.col("pickup_day") == day)


def q8_star(s: Star, vehicle_id: str) -> DataFrame:
    return trip_records(s).filter(F.col("VEHICLE_ID") == vehicle_id)


def q9_driver_means(s: Star) -> DataFrame:
    """Mean duration and distance per driver of the dimension; trips of no known driver form one group.

    The query is defined over the fact left-joined to all six dimensions. Their keys are unique, so the other five
    joins neither add nor drop a row and are left out; the driver's joins the sums per driver.
    """
    sums = s["fact_trips"].groupBy("DRIVER_ID").agg(
        F.sum("duration_s").alias("_s"), F.count("duration_s").alias("_n_s"),
        F.sum("distance_km").alias("_km"), F.count("distance_km").alias("_n_km"))
    known = s["dim_driver"].select(F.col("DRIVER_ID").alias("_known"))
    joined = sums.join(known, sums["DRIVER_ID"] == known["_known"], "left")
    return joined.groupBy(F.col("_known").alias("DRIVER_ID")).agg(
        _mean("_s", "_n_s").alias("average_trip_duration"), _mean("_km", "_n_km").alias("average_trip_distance"))
