"""The named queries as SQL views (O06), for users who work in SQL strings.

Each view is the plan of the DataFrame query, so ``SELECT ... FROM q6_star`` runs what ``queries.q6_star`` runs;
filters on a view reach the scan as they do there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sinks import register
from . import queries as Q


def query_frames(obt: DataFrame, star: Q.Star, day: int = 12, vehicle_id: str = "", prefix: str = "") -> dict[str, DataFrame]:
    """The named queries over a wide table and a star schema, by name."""
    wide = {f"q{i}_obt": getattr(Q, f"q{i}_obt")(obt) for i in range(1, 7)}
    stars = {f"q{i}_star": getattr(Q, f"q{i}_star")(star) for i in range(1, 7)}
    chosen = {
        "q7_obt": Q.q7_obt(obt, day), "q7_star": Q.q7_star(star, day),
        "q8_obt": Q.q8_obt(obt, vehicle_id), "q8_star": Q.q8_star(star, vehicle_id),
        "q9_driver_means": Q.q9_driver_means(star), "q10_obt": Q.q10_obt(obt, prefix),
    }
    return wide | stars | chosen


def register_queries(spark: SparkSession, obt: DataFrame, star: Q.Star, day: int = 12, vehicle_id: str = "",
                     prefix: str = "") -> list[str]:
    """A temp view per named query; returns the views' names."""
    frames = query_frames(obt, star, day, vehicle_id, prefix)
    register(frames)
    return sorted(frames)
