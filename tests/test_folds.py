"""Array kernels of the folds, and chunks of one vehicle, against a row-by-row statement of the rules."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import numpy as np
import pytest

from tripwright.operators import copies, folds, sessions as S
from tripwright.schema import ENRICHED_SCHEMA

GAP, LIMIT = 60, 6.0


def py_keep(rows):
    """Rows (vehicle, start, end) in order -> mask."""
    out, last, vehicle = [], None, object()
    for v, s, e in rows:
        if v != vehicle:
            vehicle, last = v, None
        stays = not (last is not None and s is not None and last > s)
        last = e if stays else last
        out.append(stays)
    return out


def py_connect(rows, state=None):
    """Rows (vehicle, start, end, km, copies) in order -> groups [first, last, km, trips], every copy on its own."""
    out, open_, prev, vehicle = [], None, None, object()
    for i, (v, s, e, km, n) in enumerate(rows):
        for _ in range(n):
            joins = open_ and v == vehicle and s is not None and prev is not None and s - prev <= GAP and open_[2] < LIMIT
            if joins:
                open_[1], open_[2], open_[3] = i, open_[2] + km, open_[3] + 1
            else:
                open_ = [i, i, km, 1]
                out.append(open_)
            vehicle, prev = v, e
    return [tuple(x) for x in out]


def random_rows(rng, n, vehicles=3):
    rows = []
    for _ in range(n):
        s = rng.choice([None, *[rng.randrange(0, 3000)] * 30])
        e = None if rng.random() < 0.03 else (s or 0) + rng.choice([0, 0, -5, rng.randrange(1, 200), rng.randrange(1, 2000)])
        km = rng.choice([0.0, 0.0, 2.0, 3.0, 0.1, rng.random() * 5, 1e-3])
        rows.append((rng.randrange(vehicles), s, e, km, rng.choice([1, 1, 1, 1, 2, 3, 40, 400])))
    low = folds.LOW
    return sorted(rows, key=lambda r: (r[0], low if r[1] is None else r[1], low if r[2] is None else r[2], r[3]))


def columns(rows):
    v, s, e, km, n = (list(x) for x in zip(*rows))
    times = lambda x: np.array([folds.LOW if y is None else y for y in x], np.int64)
    return folds.segments(np.array(v)), times(s), times(e), np.array(km), np.array(n, np.int64)


def spread(groups):
    """Groups with their multiplicity, sorted."""
    return sorted((f, l, round(km, 9), t) for f, l, km, t, n in groups for _ in range(n))


def as_rows(*found):
    return [(int(f), int(l), float(km), int(t), int(n)) for g in found if g is not None
            for f, l, km, t, n in zip(g.first, g.last, g.km, g.trips, g.times)]


@pytest.mark.parametrize("seed", range(40))
def test_keep(seed):
    rng = random.Random(seed)
    rows = random_rows(rng, rng.randrange(1, 120))
    segment, start, end, _, _ = columns(rows)
    assert folds.keep(segment, start, end).tolist() == py_keep([r[:3] for r in rows])


@pytest.mark.parametrize("seed", range(40))
def test_connect_with_copies(seed):
    rng = random.Random(100 + seed)
    rows = random_rows(rng, rng.randrange(1, 80))
    segment, start, end, km, n = columns(rows)
    items, more = folds.expand(start, end, km, np.ones(len(km), np.int64), n, GAP, LIMIT)
    found = folds.connect(segment[items.row], items, GAP, LIMIT)
    want = sorted((f, l, round(d, 9), t) for f, l, d, t in py_connect(rows))
    assert spread(as_rows(found, more)) == want
    assert len(items.row) <= len(rows) * 200  # copies that move are cut to a few groups


@pytest.mark.parametrize("seed", range(60))
def test_chunks_of_any_size(seed):
    """A vehicle cut anywhere: maps give the entry states, and chunks folded from them give the whole."""
    rng = random.Random(200 + seed)
    rows = random_rows(rng, rng.randrange(2, 120), vehicles=1)
    segment, start, end, km, n = columns(rows)
    cuts = sorted({0, len(rows), *(rng.randrange(len(rows)) for _ in range(rng.randrange(0, 9)))})
    state, stay = folds.OverlapState(), []
    for a, b in zip(cuts, cuts[1:]):
        stay += folds.keep(np.zeros(b - a, np.int64), start[a:b], end[a:b], [state.end]).tolist()
        state.follow(*folds.overlap_map(start[a:b], end[a:b]))
    assert stay == py_keep([r[:3] for r in rows])

    connect, done, pieces = folds.ConnectState(GAP, LIMIT), [], {}
    for c, (a, b) in enumerate(zip(cuts, cuts[1:])):
        items, more = folds.expand(start[a:b], end[a:b], km[a:b], np.ones(b - a, np.int64), n[a:b], GAP, LIMIT)
        m = folds.connect_map(items, GAP, LIMIT)
        joins = connect.joins(m["start"])
        found = as_rows(folds.connect(np.zeros(len(items.row), np.int64), items, GAP, LIMIT, connect.km if joins else None))
        found = [(f + a, l + a, d, t, k) for f, l, d, t, k in found]
        done += [(f + a, l + a, d, t, k) for f, l, d, t, k in as_rows(more)]
        if joins:
            pieces.setdefault(connect.origin, []).append(found.pop(0))
        if found:
            pieces.setdefault(c, []).append(found.pop())
        done += found
        connect.follow(c, m)
        assert not pieces.get(c) or connect.origin != c or abs(connect.km - pieces[c][-1][2]) < 1e-9
    done += [(p[0][0], p[-1][1], p[-1][2], sum(x[3] for x in p), 1) for p in pieces.values()]
    assert spread(done) == sorted((f, l, round(d, 9), t) for f, l, d, t in py_connect(rows))


T0 = datetime(2022, 2, 1)


def trip(v, i, start, seconds, km):
    a = Decimal("1.25")
    return (v, f"r{i:06d}", "d", T0 + timedelta(seconds=start), T0 + timedelta(seconds=start + seconds), a, a, a, a, float(km), seconds)


def plain(df):
    return sorted((r.VEHICLE_ID or "", r.REQUEST_ID, r.END_TIME, round(r.distance, 9), r.duration_s) for r in df.collect())


def expected(rows, overlap, connect):
    rows = sorted(rows, key=lambda r: (r[0] or "", r[3], r[4], r[1]))
    if overlap:
        rows = [r for r, ok in zip(rows, py_keep([(r[0], r[3], r[4]) for r in rows])) if ok]
    if not connect:
        return sorted((r[0] or "", r[1], r[4], round(r[9], 9), r[10]) for r in rows)
    at = [(r[0], (r[3] - T0).total_seconds(), (r[4] - T0).total_seconds(), r[9], 1) for r in rows]
    groups = py_connect(at)
    return sorted((rows[f][0] or "", rows[f][1], rows[l][4], round(d, 9), sum(x[10] for x in rows[f : f + t])) for f, l, d, t in groups)


@pytest.mark.parametrize("partitions", [1, 2, 7, 40])
def test_one_hot_vehicle(spark, partitions):
    """One vehicle in one island, beside small ones and rows without a vehicle, over any number of partitions."""
    rng = random.Random(partitions)
    rows = [trip("hot", i, i * 40, rng.randrange(0, 95), rng.choice([0, 0, 0.2, 0.7])) for i in range(1500)]
    rows += [trip(rng.choice(["a", "b", "z", None]), 2000 + i, rng.randrange(40000), rng.randrange(1, 900), rng.random() * 4) for i in range(300)]
    rows += [trip("copies", 5000, 0, 0, 0.5)] * 90 + [trip("copies", 5001, 30, 30, 0)] * 50
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, ENRICHED_SCHEMA)
    assert plain(S.remove_overlaps(df, partitions=partitions)) == expected(rows, True, False)
    assert plain(S.connect_trips(df, partitions=partitions)) == expected(rows, False, True)
    assert plain(S.remove_overlaps_and_connect(df, partitions=partitions)) == expected(rows, True, True)
    counted = S.remove_overlaps_and_connect(df, count_col="n", partitions=partitions)
    assert counted.agg({"n": "sum"}).first()[0] == len(expected(rows, True, False))


def test_hot_vehicle_is_spread(spark):
    """Every chunk of a vehicle is at most a range partition, and two exchanges carry the rows."""
    rows = [trip("hot", i, i * 40, 50, 0.1) for i in range(4000)]
    df = spark.createDataFrame(rows, ENRICHED_SCHEMA)
    written = []
    real = S.materialize
    S.materialize = lambda d, name="stage": written.append((name, real(d, name))) or written[-1][1]
    try:
        out = S.remove_overlaps_and_connect(df, partitions=16)
        assert out.count() == len(expected(rows, True, True))
    finally:
        S.materialize = real
    first = dict(written)["fold"].where("_kind = 1").groupBy("_c").count().collect()
    assert len(first) > 8 and max(r["count"] for r in first) < 1000


def test_exchanges(spark):
    """Rows cross the network for the count of copies, for the sort, and, those of vehicles at borders, by chunk."""
    df = spark.createDataFrame([trip("a", i, i * 40, 50, 0.1) for i in range(100)], ENRICHED_SCHEMA)
    plans = []
    real = S.materialize
    S.materialize = lambda d, name="stage": plans.append(d._jdf.queryExecution().executedPlan().toString()) or real(d, name)
    try:
        out = S.remove_overlaps(df)
    finally:
        S.materialize = real
    assert plans[0].count("Exchange hashpartitioning") == 1 and plans[0].count("Exchange rangepartitioning") == 1
    last = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in last and "SinglePartition" not in last
    assert last.count("Exchange hashpartitioning") == 2  # maps by vehicle, rows by chunk


def test_many_copies_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(copies, "CHUNK", 10)
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), ("d", 35)], "k string, n long")
    assert {r.k: r["count"] for r in copies.repeat_rows(df, "n").groupBy("k").count().collect()} == {"a": 1, "b": 10, "c": 11, "d": 35}
    assert max(r.n for r in copies.chunks(df, "n").collect()) == 10
