"""The row-level cleaning steps (V01-V11) on a stream of text lines.

The reference is batch only; nothing here adds an operator. New raw files landing in a folder are
typed, validated and boundary-filtered by the same expressions as the batch plan. The order-dependent
folds (D01, D02) stay batch steps over the written result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.cleaning import typed_trips
from ..sources.boundary import Boundary


def typed_trip_stream(spark: SparkSession, path: str, boundary: Boundary, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of clean, in-boundary trips from text files arriving under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed_trips(reader.load(path), boundary)
