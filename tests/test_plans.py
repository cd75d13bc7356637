"""Physical-plan properties: filters and projections reach the Parquet scan."""

import os
import tempfile

import pytest

from tripwright.operators import sessions, validate
from tripwright.plans import model, queries as Q
from tripwright.sources import fixtures

from conftest import SF0001


@pytest.fixture(scope="module")
def obt(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="tripwright-plan-"), "obt")
    folded = sessions.remove_overlaps_and_connect(sessions.add_distance_duration(fixtures.clean_trips(spark, SF0001)))
    model.build_obt(validate.drop_short(folded)).write.parquet(d)
    return spark.read.parquet(d)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_vehicle_filter_pushed(obt):
    plan = _plan(Q.q8_obt(obt, "veh7"))
    assert "PushedFilters: [IsNotNull(VEHICLE_ID), EqualTo(VEHICLE_ID,veh7)]" in plan


def test_prefix_filter_pushed(obt):
    assert "StringStartsWith(REQUEST_ID,req12)" in _plan(Q.q10_obt(obt, "req12"))


def test_q1_reads_only_needed_columns(obt):
    plan = _plan(Q.q1_obt(obt))
    assert "ReadSchema: struct<VEHICLE_ID:string,DT_START:timestamp_ntz,distance_km:double,duration_s:bigint>" in plan


def test_q2_reads_two_columns(obt):
    assert "ReadSchema: struct<LATITUDE_PICKUP:decimal(11,8),LONGITUDE_PICKUP:decimal(11,8)>" in _plan(Q.q2_obt(obt))
