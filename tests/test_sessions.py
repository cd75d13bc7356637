"""Per-vehicle folds against a plain-Python statement of the same rules, on hand-made edge cases and
on random trips under several bucket sizes and partition counts."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripwright.operators import sessions as S
from tripwright.schema import CLEAN_SCHEMA, ENRICHED_SCHEMA

T0 = datetime(2022, 2, 1, 8, 0, 0)


def trip(v, req, start_s, end_s, lat=1.25, lon=103.65, lat2=1.26, lon2=103.66, drv="d"):
    return (v, req, drv, T0 + timedelta(seconds=start_s), T0 + timedelta(seconds=end_s),
            Decimal(str(lat)), Decimal(str(lon)), Decimal(str(lat2)), Decimal(str(lon2)))


def enriched(v, req, start_s, end_s, km):
    return trip(v, req, start_s, end_s)[:9] + (float(km), int(end_s - start_s))


def order_key(r):
    return (r[3], r[4], r[1], r[2], r[5], r[6], r[7], r[8])


def py_remove_overlaps(rows):
    out, by_v = [], {}
    for r in rows:
        by_v.setdefault(r[0], []).append(r)
    for v, rs in by_v.items():
        last_end = None
        for r in sorted(rs, key=order_key):
            if last_end is not None and last_end > r[3]:
                continue
            last_end = r[4]
            out.append(r)
    return out


def py_connect(rows, gap=60, max_km=6.0):
    out, by_v = [], {}
    for r in rows:
        by_v.setdefault(r[0], []).append(r)
    for v, rs in by_v.items():
        grp = None
        for r in sorted(rs, key=order_key):
            if grp and (r[3] - grp["prev_end"]).total_seconds() <= gap and grp["km"] < max_km:
                grp.update(prev_end=r[4], lat2=r[7], lon2=r[8], km=grp["km"] + r[9], dur=grp["dur"] + r[10])
                continue
            if grp:
                out.append(grp["first"][:4] + (grp["prev_end"],) + grp["first"][5:7] + (grp["lat2"], grp["lon2"], grp["km"], grp["dur"]))
            grp = dict(first=r, prev_end=r[4], lat2=r[7], lon2=r[8], km=r[9], dur=r[10])
        if grp:
            out.append(grp["first"][:4] + (grp["prev_end"],) + grp["first"][5:7] + (grp["lat2"], grp["lon2"], grp["km"], grp["dur"]))
    return out


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_overlap_edge_cases(spark):
    rows = [
        trip("A", "a1", 0, 100), trip("A", "a2", 50, 400),    # overlaps a1 -> dropped
        trip("A", "a3", 100, 200),                            # touches a1 (end == start) -> kept
        trip("A", "a4", 300, 350),                            # overlaps dropped a2 only -> kept
        trip("B", "b1", 0, 10), trip("B", "b2", 0, 5),        # start tie: (start, end) order keeps b2 first
    ]
    df = spark.createDataFrame(rows, CLEAN_SCHEMA)
    got = sorted(r.REQUEST_ID for r in S.remove_overlaps(df).collect())
    assert got == ["a1", "a3", "a4", "b2"]


def test_connect_edge_cases(spark):
    rows = [
        enriched("A", "a1", 0, 100, 2.0), enriched("A", "a2", 160, 200, 2.0),    # gap 60 -> joins
        enriched("A", "a3", 261, 300, 1.0),                                     # gap 61 -> new group
        enriched("B", "b1", 0, 10, 5.9), enriched("B", "b2", 10, 20, 3.0),      # 5.9 < 6 -> joins (total 8.9)
        enriched("B", "b3", 20, 30, 1.0),                                       # total 8.9 >= 6 -> new group
    ]
    df = spark.createDataFrame(rows, ENRICHED_SCHEMA)
    got = {r.REQUEST_ID: (r.END_TIME, r.duration_s, round(r.distance, 9)) for r in S.connect_trips(df).collect()}
    assert got == {
        "a1": (T0 + timedelta(seconds=200), 140, 4.0), "a3": (T0 + timedelta(seconds=300), 39, 1.0),
        "b1": (T0 + timedelta(seconds=20), 20, 8.9), "b3": (T0 + timedelta(seconds=30), 10, 1.0),
    }


def test_empty_input(spark):
    df = spark.createDataFrame([], ENRICHED_SCHEMA)
    assert S.remove_overlaps_and_connect(df).count() == 0
    assert S.connect_pairs(df).count() == 0


trip_lists = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 20000), st.integers(-30, 3000),
              st.floats(0, 5, allow_nan=False)),
    min_size=0, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(trip_lists, st.sampled_from([60, 600, 3600, 86400]), st.sampled_from([1, 3, 8]))
def test_folds_match_python(spark, data, bucket_s, parts):
    rows = [enriched(v, f"r{i}", s, s + d, km) for i, (v, s, d, km) in enumerate(data)]
    df = spark.createDataFrame(rows, ENRICHED_SCHEMA).repartition(parts)
    assert _rows(S.remove_overlaps(df, bucket_s=bucket_s)) == sorted(py_remove_overlaps(rows))
    expect = sorted(py_connect(py_remove_overlaps(rows)))
    got = _rows(S.remove_overlaps_and_connect(df, bucket_s=bucket_s))
    assert [r[:9] + (r[10],) for r in got] == [r[:9] + (r[10],) for r in expect]
    assert all(abs(a[9] - b[9]) < 1e-9 for a, b in zip(got, expect))


def test_overlap_output_is_idempotent_and_disjoint(spark):
    rows = [trip("A", f"r{i}", (i * 37) % 900, (i * 37) % 900 + 50 + i % 7) for i in range(80)]
    once = S.remove_overlaps(spark.createDataFrame(rows, CLEAN_SCHEMA))
    kept = sorted(tuple(r) for r in once.collect())
    assert sorted(tuple(r) for r in S.remove_overlaps(once).collect()) == kept
    ordered = sorted(kept, key=order_key)
    assert all(b[3] >= a[4] for a, b in zip(ordered, ordered[1:]))


def test_connect_pairs_small(spark):
    rows = [enriched("A", "a1", 0, 100, 2.0), enriched("A", "a2", 130, 200, 2.0), enriched("A", "a3", 230, 300, 1.0),
            enriched("A", "a4", 1000, 1100, 1.0)]
    out = S.connect_pairs(spark.createDataFrame(rows, ENRICHED_SCHEMA))
    got = sorted((r.START_TIME, r.END_TIME, r.duration_s) for r in out.collect())
    # pairs (a1,a2) and (a2,a3); the second starts where the first's t2 starts and is dropped;
    # a3 touches no surviving pair (its start / end differ from a1's and a2's) and stays.
    assert got == [(T0, T0 + timedelta(seconds=200), 170), (T0 + timedelta(seconds=230), T0 + timedelta(seconds=300), 70),
                   (T0 + timedelta(seconds=1000), T0 + timedelta(seconds=1100), 100)]


def test_folds_across_small_arrow_batches(spark):
    """Groups straddling Arrow batch boundaries: only the open group's first/last rows are carried."""
    rows = [enriched("A" if i % 5 else "B", f"r{i:03d}", i * 50 - (i % 3) * 40, i * 50 + 45, 0.5 + (i % 7))
            for i in range(200)]
    df = spark.createDataFrame(rows, ENRICHED_SCHEMA).repartition(2)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = _rows(S.remove_overlaps_and_connect(df, bucket_s=86400))
        kept = _rows(S.remove_overlaps(df, bucket_s=86400))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    expect = sorted(py_connect(py_remove_overlaps(rows)))
    assert kept == sorted(py_remove_overlaps(rows))
    assert [r[:9] + (r[10],) for r in got] == [r[:9] + (r[10],) for r in expect]
    assert all(abs(a[9] - b[9]) < 1e-9 for a, b in zip(got, expect))


def test_folds_with_copies(spark):
    """Exact copies are combined before the shuffle; the folds still see every copy."""
    base = [enriched("A", "a1", 0, 100, 2.0), enriched("A", "a2", 130, 130, 0.0), enriched("A", "a3", 150, 150, 2.5),
            enriched("A", "a4", 400, 500, 1.0), enriched("B", "b1", 0, 0, 0.0), enriched("B", "b2", 10, 10, 7.0)]
    rows = base[:1] * 5 + base[1:2] * 4 + base[2:3] * 6 + base[3:4] + base[4:5] * 50 + base[5:6] * 3
    df = spark.createDataFrame(rows, ENRICHED_SCHEMA).repartition(3)
    assert _rows(S.remove_overlaps(df)) == sorted(py_remove_overlaps(rows))
    expect = sorted(py_connect(py_remove_overlaps(rows)))
    got = _rows(S.remove_overlaps_and_connect(df))
    assert [r[:9] + (r[10],) for r in got] == [r[:9] + (r[10],) for r in expect]
    assert all(abs(a[9] - b[9]) < 1e-9 for a, b in zip(got, expect))
    got2 = _rows(S.connect_trips(df))
    expect2 = sorted(py_connect(rows))
    assert [r[:9] + (r[10],) for r in got2] == [r[:9] + (r[10],) for r in expect2]


def test_folds_independent_of_partitioning(spark):
    rows = [enriched("ABCDE"[i % 5], f"r{i:03d}", (i * 7919) % 20000, (i * 7919) % 20000 + 30 + (i * 31) % 900,
                     (i % 9) * 0.8) for i in range(400)]
    expect = sorted(py_connect(py_remove_overlaps(rows)))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for parts, aqe in ((1, "true"), (7, "false"), (200, "false")):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            spark.conf.set("spark.sql.adaptive.enabled", aqe)
            df = spark.createDataFrame(rows[::-1], ENRICHED_SCHEMA).repartition(parts)
            got = _rows(S.remove_overlaps_and_connect(df))
            assert [r[:9] + (r[10],) for r in got] == [r[:9] + (r[10],) for r in expect], parts
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_null_vehicle_is_one_sequence(spark):
    rows = [enriched(None, "n1", 0, 100000, 1.0), enriched(None, "n2", 90000, 90100, 1.0),
            enriched(None, "n3", 200000, 200100, 1.0)]
    df = spark.createDataFrame(rows, ENRICHED_SCHEMA)
    assert sorted(r.REQUEST_ID for r in S.remove_overlaps(df).collect()) == ["n1", "n3"]
