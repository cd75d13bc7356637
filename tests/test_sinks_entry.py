import os
import re
import tempfile

from pyspark.sql import functions as F

from tripwright.operators import sessions
from tripwright.plans import model
from tripwright.sinks import register, with_year_month, write_csv, write_star
from tripwright.sources import combine_csv, load_star, read_tolerant_csv, read_trips_csv
from tripwright.schema import OBT_SCHEMA
from tripwright.sources import fixtures

from conftest import SF0001


def test_csv_round_trip(spark):
    d = tempfile.mkdtemp(prefix="tripwright-sink-")
    df = with_year_month(fixtures.clean_trips(spark, SF0001))
    write_csv(df, os.path.join(d, "many"))
    write_csv(df, os.path.join(d, "parts"), partition_by=["year_month"])
    back = read_trips_csv(spark, os.path.join(d, "many"))
    assert back.count() == df.count() and set(back.columns) == set(df.columns)
    assert sorted(p for p in os.listdir(os.path.join(d, "parts")) if p.startswith("year_month=")) == [
        "year_month=2022-02", "year_month=2022-03"]
    assert combine_csv(spark, os.path.join(d, "parts", "year_month=*")).count() == df.count()


def test_star_parquet_round_trip(spark):
    d = tempfile.mkdtemp(prefix="tripwright-star-")
    t = fixtures.clean_trips(spark, SF0001)
    obt = model.build_obt(sessions.add_distance_duration(t))
    write_star(model.build_star(obt), d)
    star = load_star(spark, d)
    register(star)
    for name, key in (("dim_driver", "DRIVER_ID"), ("dim_vehicle", "VEHICLE_ID")):
        assert spark.sql(f"SELECT count(*) AS n FROM {name}").first().n == t.select(key).distinct().count()
    assert star["fact_trips"].count() == t.count()


def test_typed_csv_schema(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="tripwright-obt-"), "obt")
    spark.createDataFrame([("v", "r", "d", None, None, None, None, None, None, 1.5, 3)], OBT_SCHEMA) \
        .write.option("header", True).csv(d)
    back = read_trips_csv(spark, d, schema=OBT_SCHEMA)
    assert back.schema == OBT_SCHEMA and back.first().distance_km == 1.5


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["VEHICLE_ID", "Month", "average_distance_per_month", "average_duration_per_month"]
    assert df.count() > 0
    trips = {k for k in E.queries() if not re.match(r"op[0-9]+_|pipeline$", k)}
    assert trips == {k for k in E.oracle_sql() if not re.match(r"op[0-9]+_|pipeline$", k)}
    assert set(E.oracle_sql()) <= set(E.queries())


def test_tolerant_csv(spark):
    d = tempfile.mkdtemp(prefix="tripwright-tolerant-")
    with open(os.path.join(d, "x.csv"), "w") as f:
        f.write("a,b,c\n1,2,3\n1,2,3,4\n\n5\n6,,7\n1,2,3,\n")
    got = read_tolerant_csv(spark, d, ["a", "b", "c"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("1", "2", "3"), ("5", None, None), ("6", None, "7")], key=repr)
    assert got.count() == got.select("a").count() == 3


def test_fields_with_a_value(spark):
    from tripwright.operators import validate

    lines = spark.createDataFrame([(",".join(x),) for x in (
        ["v"] * 9, ["v"] * 5 + [""] + ["v"] * 3, ["v"] * 9 + [""], ["v"] * 5 + [""] + ["v"] * 4, ["v"] * 10, ["v"] * 4)], "value string")
    nine = validate.to_columns(validate.keep_width(lines, 9))
    assert validate.keep_non_null_count(nine, "==", 9).count() == 1
    ten = validate.to_columns(lines, [f"c{i}" for i in range(10)])
    assert validate.keep_non_null_count(ten, "<=", 9).count() == 5


def test_typed_trip_stream(spark, boundary):
    from tripwright.plans.cleaning import typed_trips
    from tripwright.streaming import typed_trip_stream

    d = tempfile.mkdtemp(prefix="tripwright-stream-")
    lines = fixtures.raw_lines(spark, SF0001)
    lines.write.mode("overwrite").text(os.path.join(d, "in"))
    out = os.path.join(d, "out")
    q = (typed_trip_stream(spark, os.path.join(d, "in"), boundary).writeStream.format("parquet")
         .option("checkpointLocation", os.path.join(d, "chk")).trigger(availableNow=True).start(out))
    q.awaitTermination(300)
    assert spark.read.parquet(out).count() == typed_trips(lines, boundary).count()
