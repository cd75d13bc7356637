"""The cleaning plan (M06): raw text lines -> typed, in-boundary, de-overlapped, connected trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import sessions, validate
from ..schema import RAW_TIMESTAMP_FORMAT
from ..session import materialize
from ..sources.boundary import Boundary


class StageCounts:
    """Rows after each stage, collected in the same pass that computes the result."""

    def __init__(self):
        self._obs: list[tuple[str, Observation]] = []

    def tap(self, df: DataFrame, stage: str) -> DataFrame:
        obs = Observation(stage)
        self._obs.append((stage, obs))
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def tap_sum(self, df: DataFrame, column: str, stage: str) -> DataFrame:
        """Rows of a stage that is not a table of its own, as the sum of a column."""
        obs = Observation(stage)
        self._obs.append((stage, obs))
        return df.observe(obs, F.coalesce(F.sum(column), F.lit(0)).alias("rows"))

    def as_dict(self) -> dict[str, int]:
        return {stage: int(obs.get["rows"]) for stage, obs in self._obs}

    def table(self, spark: SparkSession) -> DataFrame:
        """(stage, rows_before, rows_after, removed), a row per stage; to be asked for when the result was computed."""
        after = list(self.as_dict().items())
        rows = [(s, after[max(i - 1, 0)][1], n) for i, (s, n) in enumerate(after)]
        return spark.createDataFrame([(s, b, n, b - n) for s, b, n in rows], "stage string, rows_before long, rows_after long, removed long")


def typed_trips(lines: DataFrame, boundary: Boundary, counts: StageCounts | None = None) -> DataFrame:
    """Width, timestamp shape, parse, coordinates, epoch, boundary; clean columns."""
    tap = counts.tap if counts else (lambda d, _s: d)
    df = tap(lines, "input")
    df = tap(validate.keep_width(df, 9), "v01_width")
    df = validate.to_columns(df)
    df = tap(validate.keep_timestamp_shape(df, ("DT_START", "DT_END"), RAW_TIMESTAMP_FORMAT), "v03_shape")
    df = validate.parse_timestamps(
        df, {"DT_START": RAW_TIMESTAMP_FORMAT, "DT_END": RAW_TIMESTAMP_FORMAT},
        rename={"DT_START": "START_TIME", "DT_END": "END_TIME"})
    df = validate.cast_coords(df)
    df = tap(validate.after_epoch(df), "v09_epoch")
    return tap(validate.keep_inside(df, boundary), "v10_boundary")


def clean_trips(lines: DataFrame, boundary: Boundary, counts: StageCounts | None = None,
                stage: bool = False) -> DataFrame:
    """M06 = V01..V11 -> F02/F03 -> D01+D02 (over one sort of the trips) -> V20.

    Text parsing and the boundary test run once, in front of the exchange that counts copies. ``stage`` writes the typed,
    enriched trips under the checkpoint folder before that, for a caller that wants a point to start again from.
    """
    typed = sessions.add_distance_duration(typed_trips(lines, boundary, counts))
    if stage:
        typed = materialize(typed, "typed")
    if counts is None:
        return validate.drop_short(sessions.remove_overlaps_and_connect(typed))
    folded = sessions.remove_overlaps_and_connect(typed, count_col="_trips")
    folded = counts.tap(counts.tap_sum(folded, "_trips", "d01_no_overlaps").drop("_trips"), "d02_connected")
    return counts.tap(validate.drop_short(folded), "v20_min_distance")


def clean_sample_csv(df: DataFrame, boundary: Boundary,
                     formats: dict[str, str] | None = None, stage: bool = False) -> DataFrame:
    """The CSV-sample variant of M06: a headed CSV whose start and end use their own patterns (V06),
    stray ``Unnamed`` columns dropped (V19), coordinates cast, rows with a NULL in any column dropped
    (V12) instead of the width / shape / epoch checks, then boundary, folds and minimum distance."""
    formats = formats or {"DT_START": "yyyy-MM-dd HH:mm:ss", "DT_END": "yyyy-dd-MM HH:mm:ss"}
    out = validate.drop_columns_like(df, "^Unnamed")
    out = validate.parse_timestamps(out, formats, rename={"DT_START": "START_TIME", "DT_END": "END_TIME"})
    out = validate.drop_any_null(validate.cast_coords(out))
    typed = sessions.add_distance_duration(validate.keep_inside(out, boundary))
    if stage:
        typed = materialize(typed, "typed-sample")
    return validate.drop_short(sessions.remove_overlaps_and_connect(typed))


def stage_count_table(lines: DataFrame, boundary: Boundary) -> DataFrame:
    """Rows before and after each stage of M06 and what it removed, from the pass that makes the result."""
    counts = StageCounts()
    materialize(clean_trips(lines, boundary, counts), "counted")
    return counts.table(lines.sparkSession)
