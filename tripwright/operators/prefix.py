"""Running totals over blocks that are already in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Blocks whose totals are summed first.
GROUP = 1024


def block_offsets(totals: DataFrame, block: str, *sums: str) -> DataFrame:
    """For one row per ``block`` (consecutive numbers from 0, any not present counting as 0) with the totals
    ``sums``: the sum of each total over all lower blocks, as ``before_<column>``.

    Two levels: totals of groups of ``GROUP`` blocks are summed, running sums of those (a table smaller by the
    factor ``GROUP``) are joined back, and each group has a window of its own, so no task sees all blocks.
    """
    group = F.floor(F.col(block) / GROUP).alias("_group")
    t = totals.select(F.col(block).cast("long").alias(block), *sums, group)
    groups = t.groupBy("_group").agg(*(F.sum(c).alias(f"_{c}") for c in sums))
    over = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("_group", *(F.coalesce(F.sum(f"_{c}").over(over), F.lit(0)).alias(f"_{c}") for c in sums))
    inside = Window.partitionBy("_group").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    running = t.withColumns({f"_in_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    return running.join(groups, "_group").select(
        block, *((F.col(f"_in_{c}") + F.col(f"_{c}")).cast("long").alias(f"before_{c}") for c in sums)
    )
