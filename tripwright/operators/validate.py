"""Row validation, projections and filters (V01-V23). All are narrow DataFrame transformations:
no shuffle, predicates reach the Parquet scan where the source allows it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.geo import within_boundary
from ..functions.timefmt import format_ts, parse_ts, shape_regex
from ..schema import CLEAN_COLUMNS, COORD_COLUMNS, COORD_TYPE, EPOCH, MIN_TRIP_KM, RAW_COLUMNS, RAW_TIMESTAMP_FORMAT
from ..sources.boundary import Boundary


def _width(line_col: str) -> Column:
    """Fields of a line: its commas and one more, counted without cutting the line up."""
    line = F.col(line_col)
    return F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) + 1


def keep_width(lines: DataFrame, width: int = 9, line_col: str = "value") -> DataFrame:
    """Lines with exactly ``width`` comma-separated fields."""
    return lines.filter(_width(line_col) == width)


def bad_width_rows(lines: DataFrame, width: int = 9, line_col: str = "value", number_col: str | None = None) -> DataFrame:
    """Lines with another field count, with that count (V16), and with their number if ``lines`` has it
    (``sources.read_numbered_lines``)."""
    number = [number_col] if number_col else []
    rows = lines.select(*number, F.col(line_col).alias("line"), _width(line_col).alias("n_fields"))
    return rows.filter(F.col("n_fields") != width)


def to_columns(lines: DataFrame, names: list[str] = RAW_COLUMNS, line_col: str = "value") -> DataFrame:
    """Name the fields of each line by position.

    The split stands in a generator: as a plain column it would be merged into every filter and field above it and worked
    out again in each. Limit -1 keeps trailing empty fields, as a plain comma split does; ``get`` gives NULL past the
    end of a short line instead of raising under ANSI mode.
    """
    parts = lines.select(F.explode(F.array(F.split(F.col(line_col), ",", -1))).alias("_fields"))
    return parts.select(*[F.get(F.col("_fields"), i).alias(n) for i, n in enumerate(names)])


def exclude_lines(lines: DataFrame, bad: DataFrame, line_col: str = "value") -> DataFrame:
    """Drop lines equal to any line of ``bad`` (V17, keyed by content)."""
    keys = bad.select(F.col(bad.columns[0]).alias(line_col)).distinct()
    return lines.join(keys, on=line_col, how="left_anti")


def exclude_line_numbers(lines: DataFrame, bad: DataFrame, number_col: str = "line_no") -> DataFrame:
    """Drop the lines whose number (``sources.read_numbered_lines``) is among the first column of ``bad``."""
    numbers = bad.select(F.col(bad.columns[0]).cast("long").alias(number_col)).distinct()
    return lines.join(numbers, on=number_col, how="left_anti").select(*lines.columns)


def keep_timestamp_shape(df: DataFrame, cols=("DT_START", "DT_END"), fmt: str = RAW_TIMESTAMP_FORMAT) -> DataFrame:
    """Rows whose timestamp columns fully match the digit shape of ``fmt``."""
    regex = shape_regex(fmt)
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).rlike(regex)
    return df.filter(cond)


def parse_timestamps(df: DataFrame, formats: dict[str, str], rename: dict[str, str] | None = None) -> DataFrame:
    """Parse each column with its own pattern, NULL on failure (V04, V06); optional rename."""
    rename = rename or {}
    out = df
    for c, fmt in formats.items():
        out = out.withColumn(rename.get(c, c), parse_ts(c, fmt))
        if rename.get(c, c) != c:
            out = out.drop(c)
    return out


def normalise_timestamps(df: DataFrame, cols=("DT_START", "DT_END"), fmt: str = RAW_TIMESTAMP_FORMAT) -> DataFrame:
    """Timestamp columns back to text in ``fmt``."""
    out = df
    for c in cols:
        out = out.withColumn(c, format_ts(c, fmt))
    return out


def cast_coords(df: DataFrame, cols=COORD_COLUMNS) -> DataFrame:
    """Latitude / longitude text to DECIMAL(11,8); unparsable or too many integer digits -> NULL."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.col(c).try_cast(COORD_TYPE))
    return out


def after_epoch(df: DataFrame, cols=("START_TIME", "END_TIME")) -> DataFrame:
    """Both timestamps strictly after 1970-01-01 00:00:00; NULL drops."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) > F.lit(EPOCH).cast("timestamp_ntz"))
    return df.filter(cond)


def keep_inside(df: DataFrame, boundary: Boundary) -> DataFrame:
    """Trips whose pickup and drop-off both lie strictly inside the boundary, projected to the clean
    columns (V10, V11)."""
    out = within_boundary(df, "LATITUDE_PICKUP", "LONGITUDE_PICKUP", boundary, "_in_pickup").filter("_in_pickup = 1")
    out = within_boundary(out, "LATITUDE_END", "LONGITUDE_END", boundary, "_in_end").filter("_in_end = 1")
    return out.select(*CLEAN_COLUMNS)


def drop_any_null(df: DataFrame) -> DataFrame:
    """Rows without a NULL in any column."""
    return df.dropna(how="any")


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """Rows without a NULL in ``subset``."""
    return df.dropna(how="any", subset=subset)


def _non_null_count(df: DataFrame, cols: list[str]) -> Column:
    """Fields that hold a value; an empty text is a missing one, as in the text files the rows come from."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    total = F.lit(0)
    for c in cols:
        value = F.nullif(F.col(c), F.lit("")) if c in texts else F.col(c)
        total = total + value.isNotNull().cast("int")
    return total


def keep_non_null_count(df: DataFrame, op: str = "==", n: int = 9, cols: list[str] | None = None) -> DataFrame:
    """Rows whose count of fields with a value compares to ``n`` with ``op`` (V14 ``==``, V15 ``<=``); meant for the
    text columns as they were read, before any cast."""
    cnt = _non_null_count(df, cols or df.columns)
    cond = {"==": cnt == n, "<=": cnt <= n, "<": cnt < n, ">=": cnt >= n, ">": cnt > n}[op]
    return df.filter(cond)


def find_text(df: DataFrame, text: str, cols=("DT_START", "DT_END")) -> DataFrame:
    """Rows where any of ``cols`` contains ``text`` literally."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.coalesce(F.col(c).contains(text), F.lit(False))
    return df.filter(cond)


def drop_columns_like(df: DataFrame, pattern: str = "^Unnamed") -> DataFrame:
    """Drop columns whose name matches ``pattern``."""
    rx = re.compile(pattern)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not rx.search(c)])


def drop_short(df: DataFrame, min_km: float = MIN_TRIP_KM, col: str = "distance") -> DataFrame:
    """Trips strictly longer than ``min_km``."""
    return df.filter(F.col(col) > F.lit(min_km))


def trips_of_vehicle(df: DataFrame, vehicle_id: str, col: str = "VEHICLE_ID") -> DataFrame:
    """Equality filter on the vehicle, pushed to the scan."""
    return df.filter(F.col(col) == F.lit(vehicle_id))


def trips_on_day(df: DataFrame, day: int, col: str = "DT_START") -> DataFrame:
    """Trips whose timestamp falls on day-of-month ``day``."""
    return df.filter(F.dayofmonth(col) == F.lit(day))


def by_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """``col LIKE 'prefix%'`` as a pushed ``StringStartsWith``."""
    return df.filter(F.col(col).startswith(prefix))
