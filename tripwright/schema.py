"""Column lists, schemas and fixed formats of the trip data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that define the reference's data model and must stay as they are.
RAW_COLUMNS = [
    "VEHICLE_ID", "DRIVER_ID", "REQUEST_ID", "DT_START", "DT_END",
    "LATITUDE_PICKUP", "LONGITUDE_PICKUP", "LATITUDE_END", "LONGITUDE_END",
]
RAW_TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"
EPOCH = "1970-01-01 00:00:00"
COORD_TYPE = T.DecimalType(11, 8)
EARTH_RADIUS_KM = 6371.0
CONNECT_GAP_S = 60
CONNECT_MAX_KM = 6.0
MIN_TRIP_KM = 1.0

# Business columns of a clean trip, in the order the cleaning plan emits them.
CLEAN_COLUMNS = [
    "VEHICLE_ID", "REQUEST_ID", "DRIVER_ID", "START_TIME", "END_TIME",
    "LATITUDE_PICKUP", "LONGITUDE_PICKUP", "LATITUDE_END", "LONGITUDE_END",
]
COORD_COLUMNS = ["LATITUDE_PICKUP", "LONGITUDE_PICKUP", "LATITUDE_END", "LONGITUDE_END"]
ENRICHED_COLUMNS = CLEAN_COLUMNS + ["distance", "duration_s"]

# Total order inside one vehicle: start, then end, then the remaining columns as tie-breaks.
TRIP_ORDER = ["START_TIME", "END_TIME", "REQUEST_ID", "DRIVER_ID"] + COORD_COLUMNS

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("VEHICLE_ID", T.StringType()),
        T.StructField("REQUEST_ID", T.StringType()),
        T.StructField("DRIVER_ID", T.StringType()),
        T.StructField("START_TIME", T.TimestampNTZType()),
        T.StructField("END_TIME", T.TimestampNTZType()),
    ]
    + [T.StructField(c, COORD_TYPE) for c in COORD_COLUMNS]
)
ENRICHED_SCHEMA = T.StructType(
    CLEAN_SCHEMA.fields + [T.StructField("distance", T.DoubleType()), T.StructField("duration_s", T.LongType())]
)

# Cleaning output -> wide table ("OBT") names used by the model build and the queries.
OBT_RENAME = {"START_TIME": "DT_START", "END_TIME": "DT_END", "distance": "distance_km"}
OBT_COLUMNS = [
    "VEHICLE_ID", "REQUEST_ID", "DRIVER_ID", "DT_START", "DT_END",
    "LATITUDE_PICKUP", "LONGITUDE_PICKUP", "LATITUDE_END", "LONGITUDE_END", "distance_km", "duration_s",
]
OBT_SCHEMA = T.StructType(
    [
        T.StructField("VEHICLE_ID", T.StringType()),
        T.StructField("REQUEST_ID", T.StringType()),
        T.StructField("DRIVER_ID", T.StringType()),
        T.StructField("DT_START", T.TimestampNTZType()),
        T.StructField("DT_END", T.TimestampNTZType()),
    ]
    + [T.StructField(c, COORD_TYPE) for c in COORD_COLUMNS]
    + [T.StructField("distance_km", T.DoubleType()), T.StructField("duration_s", T.LongType())]
)
