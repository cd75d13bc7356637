"""Wide table and star schema answer Q1-Q8 alike; the cleaning plan reproduces the fixture stage counts."""

import pytest
from pyspark.sql import functions as F

from tripwright.operators import sessions, validate
from tripwright.plans import model, queries as Q
from tripwright.plans.cleaning import StageCounts, clean_trips, typed_trips
from tripwright.session import materialize
from tripwright.sources import fixtures

from conftest import SF0001, SF001


@pytest.fixture(scope="module")
def obt(spark):
    folded = sessions.remove_overlaps_and_connect(sessions.add_distance_duration(fixtures.clean_trips(spark, SF0001)))
    return materialize(model.build_obt(validate.drop_short(folded)), "test-obt")


@pytest.fixture(scope="module")
def star(obt):
    return {k: materialize(v, f"test-{k}") for k, v in model.build_star(obt, trip_id="dense").items()}


def _set(df, cols=None, digits=6):
    cols = cols or df.columns
    return sorted(tuple(round(x, digits) if isinstance(x, float) else x for x in r)
                  for r in df.select(*cols).collect())


def test_grouped_queries_agree(obt, star):
    assert _set(Q.q1_obt(obt)) == _set(Q.q1_star(star))
    for a, b in [(Q.q2_obt, Q.q2_star), (Q.q3_obt, Q.q3_star), (Q.q4_obt, Q.q4_star), (Q.q5_obt, Q.q5_star)]:
        assert _set(a(obt)) == _set(b(star))
    assert Q.q2_obt(obt).first().num_pickups >= Q.q2_obt(obt).collect()[-1].num_pickups


def test_trip_queries_agree(obt, star):
    cols = ["REQUEST_ID", "VEHICLE_ID", "DRIVER_ID", "duration_s", "distance_km"]
    vid = obt.select(F.min("VEHICLE_ID")).first()[0]
    assert _set(Q.q6_obt(obt), cols) == _set(Q.q6_star(star), cols)
    assert _set(Q.q7_obt(obt), cols) == _set(Q.q7_star(star), cols)
    assert _set(Q.q8_obt(obt, vid), cols) == _set(Q.q8_star(star, vid), cols) and Q.q8_obt(obt, vid).count() > 0


def test_star_shape(obt, star):
    fact = star["fact_trips"]
    assert fact.count() == obt.count()
    assert fact.filter(F.col("PICKUP_TIME_ID").isNull() | F.col("DROPOFF_LOCATION_ID").isNull()).count() == 0
    ids = sorted(r.TRIP_ID for r in fact.collect())
    assert ids == list(range(1, len(ids) + 1))
    assert Q.q9_driver_means(star).count() == star["dim_driver"].count()


def test_plan_shape(spark):
    """Maps of the chunks go by vehicle, rows by chunk (tests/test_folds.py counts the exchanges); no single-partition funnel."""
    folded = sessions.remove_overlaps_and_connect(sessions.add_distance_duration(fixtures.clean_trips(spark, SF0001)))
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "hashpartitioning(VEHICLE_ID" in plan


def test_stage_counts_sf001(spark):
    counts = StageCounts()
    out = clean_trips(fixtures.raw_lines(spark, SF001), fixtures.boundary(spark), counts)
    out.write.format("noop").mode("overwrite").save()
    assert counts.as_dict() == {
        "input": 10001, "v01_width": 9601, "v03_shape": 9400, "v09_epoch": 9000, "v10_boundary": 5667,
        "d01_no_overlaps": counts.as_dict()["d01_no_overlaps"], "d02_connected": 4007, "v20_min_distance": 3798,
    }
    single = sessions.remove_overlaps(typed_trips(fixtures.raw_lines(spark, SF001), fixtures.boundary(spark)))
    assert counts.as_dict()["d01_no_overlaps"] == single.count()
    last = counts.table(spark).collect()[-1]
    assert (last.rows_before, last.rows_after, last.removed) == (4007, 3798, 209)


def test_counts_lie_below_the_joins(star):
    """Star aggregates: the fact is aggregated by its key before it is joined."""
    for make in (Q.q1_star, Q.q2_star, Q.q3_star, Q.q4_star, Q.q5_star, Q.q9_driver_means):
        plan = make(star)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        join = next(i for i, x in enumerate(plan) if "Join" in x)
        assert any("Aggregate" in x for x in plan[join + 1 :]), make.__name__
        assert sum("Join" in x for x in plan) == 1


def test_pair_connection_reads_stored_tables(spark):
    trips = sessions.add_distance_duration(sessions.remove_overlaps(fixtures.clean_trips(spark, SF0001)))
    plan = sessions.connect_pairs(trips)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("LeftAnti") <= 4
