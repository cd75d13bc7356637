"""Bench: cleaning plan, model build and the named queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.
Inputs are derived from the scale factor's ``events`` table once, untimed: the raw trip lines are
written as text (what the cleaning plan reads in production). Every timed step ends in a sink that
computes the whole result (Parquet for the hand-offs, ``noop`` for query results); one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tripwright.functions import within_boundary  # noqa: E402
from tripwright.operators import sessions  # noqa: E402
from tripwright.plans import model, queries as Q  # noqa: E402
from tripwright.plans.cleaning import clean_trips  # noqa: E402
from tripwright.session import local_session, materialize  # noqa: E402
from tripwright.sinks import write_star  # noqa: E402
from tripwright.sources import boundary_from_text, fixtures, load_star, read_raw_lines  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def timed(fn, repeat: int = REPEAT) -> float:
    fn()  # warm-up
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return statistics.median(runs)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=int(CPUS) * 2)
    work = tempfile.mkdtemp(prefix="tripwright-bench-")
    spark.sparkContext.setCheckpointDir(os.path.join(work, "ckpt"))
    raw_dir, obt_dir, star_dir = (os.path.join(work, d) for d in ("raw", "obt", "star"))
    fixtures.raw_lines(spark, SF_DIR).write.mode("overwrite").text(raw_dir)
    boundary = fixtures.boundary(spark)
    n_lines = spark.read.text(raw_dir).count()

    out: dict[str, float] = {}

    def run_clean():
        clean = clean_trips(read_raw_lines(spark, raw_dir), boundary)
        model.build_obt(clean).write.mode("overwrite").parquet(obt_dir)

    out["m06_clean_to_parquet"] = timed(run_clean, repeat=max(1, REPEAT))
    obt = spark.read.parquet(obt_dir)

    def run_model():
        write_star(model.build_star(obt), star_dir)

    out["m02_m04_build_star"] = timed(run_model, repeat=max(1, REPEAT))
    star = load_star(spark, star_dir)
    single = materialize(sessions.add_distance_duration(sessions.remove_overlaps(fixtures.clean_trips(spark, SF_DIR))), "single")
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    out["d02_connect_trips"] = timed(lambda: noop(sessions.connect_trips(single)))
    out["d03_connect_pairs"] = timed(lambda: noop(sessions.connect_pairs(single)))
    large = boundary_from_text(spark, fixtures.large_boundary_geojson())
    out["f01_large_boundary"] = timed(lambda: noop(within_boundary(single, "LATITUDE_END", "LONGITUDE_END", large, "w")))
    vehicle = obt.select("VEHICLE_ID").orderBy("VEHICLE_ID").first()[0]
    prefix = "req12"
    cases = {
        "q1_obt": lambda: Q.q1_obt(obt), "q1_star": lambda: Q.q1_star(star),
        "q2_obt": lambda: Q.q2_obt(obt), "q2_star": lambda: Q.q2_star(star),
        "q3_obt": lambda: Q.q3_obt(obt), "q3_star": lambda: Q.q3_star(star),
        "q4_obt": lambda: Q.q4_obt(obt), "q4_star": lambda: Q.q4_star(star),
        "q5_obt": lambda: Q.q5_obt(obt), "q5_star": lambda: Q.q5_star(star),
        "q6_obt": lambda: Q.q6_obt(obt), "q6_star": lambda: Q.q6_star(star),
        "q7_obt": lambda: Q.q7_obt(obt), "q7_star": lambda: Q.q7_star(star),
        "q8_obt": lambda: Q.q8_obt(obt, vehicle), "q8_star": lambda: Q.q8_star(star, vehicle),
        "q9_driver_means": lambda: Q.q9_driver_means(star),
        "q10_obt": lambda: Q.q10_obt(obt, prefix),
    }
    for name, make in cases.items():
        out[name] = timed(lambda make=make: make().write.format("noop").mode("overwrite").save())

    total = sum(out.values())
    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "total_sec", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in out.items()},
        "sf": float(sf.group(1)) if sf else SF_DIR,
        "raw_lines": n_lines,
        "clean_lines_per_sec": round(n_lines / out["m06_clean_to_parquet"], 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
