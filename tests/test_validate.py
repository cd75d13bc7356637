from pyspark.sql import functions as F

from tripwright.operators import validate as V
from tripwright.schema import RAW_COLUMNS

HEADER = ",".join(RAW_COLUMNS)
GOOD = "v1,d1,r1,01/02/2022 10:00:00,01/02/2022 10:10:00,1.25,103.65,1.26,103.66"


def _lines(spark, lines):
    return spark.createDataFrame([(l,) for l in lines], "value string")


def test_width_and_shape(spark):
    lines = _lines(spark, [GOOD, GOOD + ",x", ",".join(GOOD.split(",")[:8]), HEADER, ""])
    assert V.keep_width(lines).count() == 2
    assert sorted(r.n_fields for r in V.bad_width_rows(lines).collect()) == [1, 8, 10]
    cols = V.to_columns(V.keep_width(lines))
    assert V.keep_timestamp_shape(cols).count() == 1  # header dropped


def test_cast_epoch_and_nulls(spark):
    bad = ["v2,d2,r2,01/01/1970 00:00:00,01/02/2022 10:10:00,1.25,103.65,1.26,103.66",
           "v3,d3,r3,01/02/2022 10:00:00,01/02/2022 10:10:00,,103.65,1.26,103.66",
           "v4,d4,r4,01/02/2022 10:00:00,01/02/2022 10:10:00,1000.5,103.65,1.26,103.66"]
    df = V.to_columns(_lines(spark, [GOOD] + bad))
    df = V.parse_timestamps(df, {"DT_START": "dd/MM/yyyy HH:mm:ss", "DT_END": "dd/MM/yyyy HH:mm:ss"},
                            rename={"DT_START": "START_TIME", "DT_END": "END_TIME"})
    df = V.cast_coords(df)
    assert V.after_epoch(df).count() == 3
    assert V.drop_any_null(df).count() == 2
    assert V.keep_non_null_count(df, "==", 9).count() == 2
    assert V.keep_non_null_count(df, "<=", 9).count() == 4


def test_boundary_filter(spark, boundary):
    outside = GOOD.replace("1.26,103.66", "1.32,103.72")  # drop-off in the hole
    df = V.to_columns(_lines(spark, [GOOD, outside]))
    df = V.parse_timestamps(df, {"DT_START": "dd/MM/yyyy HH:mm:ss", "DT_END": "dd/MM/yyyy HH:mm:ss"},
                            rename={"DT_START": "START_TIME", "DT_END": "END_TIME"})
    out = V.keep_inside(V.cast_coords(df), boundary)
    assert [r.REQUEST_ID for r in out.collect()] == ["r1"]


def test_small_filters(spark):
    df = spark.createDataFrame([("a1", "x 26/02"), ("b2", "y"), ("a3", None)], "REQUEST_ID string, DT_START string")
    assert V.by_prefix(df, "REQUEST_ID", "a").count() == 2
    assert V.find_text(df, "26/02", cols=("DT_START",)).count() == 1
    assert V.drop_null(df, ["DT_START"]).count() == 2
    wide = spark.createDataFrame([(1, 2, 3)], "`Unnamed: 0` int, a int, `Unnamed: 1` int")
    assert V.drop_columns_like(wide).columns == ["a"]
    lines = _lines(spark, ["p", "q", "r", "q"])
    assert sorted(r.value for r in V.exclude_lines(lines, _lines(spark, ["q"])).collect()) == ["p", "r"]
