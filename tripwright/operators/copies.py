"""Rows that stand for several equal ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Copies that are made of a row at a time.
CHUNK = 1 << 16


def chunks(df: DataFrame, count: str, part: str = "_part") -> DataFrame:
    """Each row once for every ``CHUNK`` of its ``count`` copies: ``part`` is the chunk's number from 0, ``count`` becomes
    the copies in it. No array holds more than a number per chunk."""
    n = F.col(count)
    many = df.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / CHUNK))))
    return many.withColumn(count, F.least(n - F.col(part) * CHUNK, F.lit(CHUNK).cast("long")))


def repeat_rows(df: DataFrame, count: str) -> DataFrame:
    """Each row as often as ``count`` says, without that column. Copies of one row are made in chunks, as they are read."""
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(count)))
    return chunks(df, count).withColumn(count, each).drop(count, "_part")
