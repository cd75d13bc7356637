"""Dense surrogate keys without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY k)`` with no partition funnels every row into one task. ``dense_ids``
range-partitions by the keys instead (Spark samples the split points), records each row's partition and its
position inside the sorted partition, and writes that to the checkpoint folder. Each partition's offset is a running
sum of the partitions' counts, joined back without a hint: the table has a row per partition.

A row's place depends on nothing but its values, so a task that runs again gives the same ids: ties in the keys are
broken by the other columns, and equal rows, which no order can tell apart, are counted first and numbered as one. Their
numbers are written out in chunks, which are dealt over the tasks where a row has many.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import copies
from .copies import chunks


def dense_ids(df: DataFrame, keys: list[str], id_col: str, partitions: int | None = None,
              with_total: bool = False, unique: bool = False) -> DataFrame:
    """Adds ``id_col`` = 1..N in ascending key order, NULLs first, as ``row_number`` would give.
    ``with_total`` also adds ``_total`` = N. ``unique`` says that no two rows have equal keys, which saves the
    counting of equal rows."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = list(df.columns)
    order = [F.col(k).asc_nulls_first() for k in keys]
    if unique:
        rows = df.withColumn("_n", F.lit(1).cast("long"))
    else:
        order += [F.col(c).asc_nulls_first() for c in columns if c not in keys]
        rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    ranged = (
        rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
        .withColumn("_i", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("long"), 33))
    )
    staged = materialize(ranged, "ids")
    blocks = staged.groupBy("_p").agg(F.sum("_n").alias("_rows"), F.max("_n").alias("_most"))
    ahead = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    numbered = staged.join(blocks.select("_p", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_before")), "_p")
    if unique:
        numbered = numbered.withColumn(id_col, F.col("_before") + F.col("_i") + 1)
    else:
        before = F.sum("_n").over(Window.partitionBy("_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1))
        numbered = numbered.withColumn("_first", F.col("_before") + F.coalesce(before, F.lit(0)) + 1)
        numbered = chunks(numbered, "_n")
        if (blocks.agg(F.max("_most")).first()[0] or 0) > copies.CHUNK:
            numbered = numbered.repartition("_p", "_i", "_part")
        start = F.col("_first") + F.col("_part") * copies.CHUNK
        numbered = numbered.withColumn(id_col, F.explode(F.sequence(start, start + F.col("_n") - 1)))
    if with_total:
        numbered = numbered.withColumn("_total", F.lit(staged.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]))
    return numbered.select(*columns, F.col(id_col).cast("long").alias(id_col), *["_total"] * with_total)


def every_nth(df: DataFrame, key: str, n: int = 2, remainder: int = 0) -> DataFrame:
    """Distinct ``key`` values whose rank in key order is ``remainder`` mod ``n`` (W03: every second)."""
    ranked = dense_ids(df.select(key).distinct(), [key], "_rn", unique=True)
    return ranked.filter(F.col("_rn") % n == remainder).select(key)


def trip_ids(df: DataFrame, id_col: str = "TRIP_ID", keys=("REQUEST_ID", "VEHICLE_ID", "DT_START"),
             method: str = "dense") -> DataFrame:
    """Trip key (W04).

    ``dense``: 1..N in natural-key order; costs a range shuffle of the whole table, the result does not
    depend on file layout. ``scan``: unique 64-bit id from the scan position (partition index, row index),
    no shuffle; stable as long as ``df`` is a stored table read with the same file layout, which is what
    the model build reads.
    """
    if method == "scan":
        return df.withColumn(id_col, F.monotonically_increasing_id())
    if method != "dense":
        raise ValueError(f"unknown trip id method {method!r}")
    return dense_ids(df, list(keys), id_col)


def split_halves(df: DataFrame, keys: list[str], col: str = "half") -> DataFrame:
    """Tag each row ``1`` (first half by position in key order) or ``2`` (O07); odd N puts the middle
    row in the second half, as splitting at ``N // 2`` does."""
    ranked = dense_ids(df, keys, "_pos", with_total=True)
    half = F.when(F.col("_pos") <= F.floor(F.col("_total") / 2), F.lit(1)).otherwise(F.lit(2))
    return ranked.withColumn(col, half).drop("_pos", "_total")
