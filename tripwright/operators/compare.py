"""Row comparison of two outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def missing_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` with no equal row in ``right`` on all shared columns; NULL equals NULL and
    duplicates keep their multiplicity. ``right`` is reduced to distinct rows first, so copies on that
    side are combined before the shuffle."""
    shared = [c for c in left.columns if c in set(right.columns)]
    r = right.select(*shared).distinct()
    r = r.select(*[r[c].alias(f"_r_{i}") for i, c in enumerate(shared)])
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(r[f"_r_{i}"]) for i, c in enumerate(shared)])
    return left.join(r, cond, "left_anti")
