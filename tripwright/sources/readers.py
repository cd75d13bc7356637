"""Readers for trip text lines, trip CSV files and the Parquet star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

STAR_TABLES = [
    "fact_trips", "dim_vehicle", "dim_driver", "dim_pickup_location",
    "dim_dropoff_location", "dim_pickup_time", "dim_dropoff_time",
]


def read_raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per text line, column ``value`` (S01). Any Hadoop path or glob, e.g. ``s3a://``."""
    return spark.read.text(path)


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, file, line_in_file and line_no of every text line: numbers from 1, in the order of the lines within a file and
    of the files' paths. They do not depend on how the input is split.

    A line's place in its block of the file (what one read covers) is its scan position; blocks are counted per file and
    files in order of their paths, so what is summed is a row per block and a row per file.
    """
    scan = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    blocks = scan.groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_in_file", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    files = blocks.groupBy("file").agg(F.sum("_n").alias("_lines"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_before"))
    blocks = blocks.join(files, "file").select(F.col("file").alias("_f"), F.col("_block").alias("_b"), "_first", "_in_file", "_before")
    placed = scan.join(blocks, (F.col("file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    place = F.col("_at") - F.col("_first") + F.col("_in_file") + 1
    return placed.select("value", "file", place.alias("line_in_file"), (place + F.col("_before")).alias("line_no"))


def read_trips_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """CSV with header (S02). Without a schema every column is a string; with one the types are pinned,
    which replaces inference and its extra pass over the data (S03)."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


#: A field with the comma before it: in quotes (two of them stand for one inside), with what follows them, or plain.
_FIELD = r',("(?:[^"]|"")*(?:"[^,]*|$)|[^,]*)'


def _unquoted(field: Column) -> Column:
    """A field without its quotes."""
    inner = F.replace(F.regexp_extract(field, r'(?s)^"((?:[^"]|"")*)', 1), F.lit('""'), F.lit('"'))
    rest = F.regexp_extract(field, r'(?s)^"(?:[^"]|"")*"(.*)$', 1)
    return F.when(field.startswith('"'), F.concat(inner, rest)).otherwise(field)


def csv_fields(line: str | Column) -> Column:
    """The fields of a line, as a CSV parser sees them: a comma in a quoted field does not end it. A quote counts only at
    the beginning of a field, and one that is not closed holds until the end of the line."""
    text = F.col(line) if isinstance(line, str) else line
    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(_FIELD), F.lit(1)), _unquoted)
    return F.when(text.contains('"'), quoted).otherwise(F.split(text, ",", -1))


def read_tolerant_csv(spark: SparkSession, path: str | list[str], columns: list[str], header: bool = True) -> DataFrame:
    """Text columns of comma-separated lines that may be broken (S13): a line with more fields than ``columns`` is
    skipped, a shorter one is filled up with NULL, an empty field is NULL and an empty line is no row. Commas in quoted
    fields belong to the field. With ``header``, lines that repeat the column names are dropped.

    The rule looks at whole lines, so the rows do not depend on which columns a query selects.
    """
    lines = spark.read.text(path).where("value <> ''")
    if header:
        lines = lines.where(F.col("value") != ",".join(columns))
    fields = lines.select(F.explode(F.array(csv_fields("value"))).alias("_f")).where(F.size("_f") <= len(columns))
    return fields.select(*[F.nullif(F.get("_f", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)])


_LONG = r"^[+-]?\d{1,18}$"
_DECIMAL = r"^[+-]?\d{1,20}\.\d{1,18}$"
_DOUBLE = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
_TIME = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$"


def infer_schema(texts: DataFrame) -> StructType:
    """Types of columns of text (S03), from one aggregation over all rows in which every column keeps what its values
    have been: whole numbers, numbers of one fixed number of decimals, any numbers, times, or texts. What two parts of
    the data have been joins without looking at the data again.

    A column of numbers is long if all are whole, decimal if all have the same number of decimals, else double; columns of
    one number of decimals get the precision of the widest of them. Times are TIMESTAMP_NTZ; empty and missing values
    say nothing, and a column without any other is text.
    """
    stats = []
    for i, c in enumerate(texts.columns):
        v = F.nullif(F.col(f"`{c}`"), F.lit(""))
        scale = F.when(v.rlike(_DECIMAL), F.length(F.substring_index(v, ".", -1))).when(v.rlike(_LONG), F.lit(0))
        whole = F.length(F.regexp_replace(F.substring_index(v, ".", 1), "[+-]", ""))
        parses = v.rlike(_TIME) & F.expr(f"try_cast(`{c}` as timestamp_ntz)").isNotNull()
        stats += [F.count(v).alias(f"n{i}"), F.count_if(v.rlike(_DOUBLE)).alias(f"number{i}"), F.count(scale).alias(f"fixed{i}"),
                  F.min(scale).alias(f"low{i}"), F.max(scale).alias(f"high{i}"), F.max(F.when(scale.isNotNull(), whole)).alias(f"whole{i}"),
                  F.count_if(parses).alias(f"time{i}")]
    seen = texts.agg(*stats).first()
    kinds, widest = [], {}
    for i, c in enumerate(texts.columns):
        n = seen[f"n{i}"]
        if n and seen[f"fixed{i}"] == n and seen[f"low{i}"] == seen[f"high{i}"]:
            scale = seen[f"high{i}"]
            widest[scale] = max(widest.get(scale, 1), seen[f"whole{i}"])
            kinds.append(("fixed", scale))
        else:
            kinds.append(("number" if n and seen[f"number{i}"] == n else "time" if n and seen[f"time{i}"] == n else "text", None))
    out = []
    for (kind, scale), c in zip(kinds, texts.columns):
        fixed = LongType() if scale == 0 else DoubleType() if kind == "fixed" and widest[scale] + scale > 38 else None
        if kind == "fixed" and fixed is None:
            fixed = DecimalType(widest[scale] + scale, scale)
        out.append(StructField(c, {"fixed": fixed, "number": DoubleType(), "time": TimestampNTZType(), "text": StringType()}[kind]))
    return StructType(out)


def read_inferred_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with header whose types are inferred from all of its rows."""
    return read_trips_csv(spark, path, infer_schema(read_trips_csv(spark, path)))


def combine_csv(spark: SparkSession, pattern: str) -> DataFrame:
    """All CSV files matched by a glob as one DataFrame (S07); the union is the multi-file scan itself."""
    return read_trips_csv(spark, pattern)


def load_star(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The seven Parquet tables of the star schema."""
    return {name: spark.read.parquet(f"{directory}/{name}.parquet") for name in STAR_TABLES}
