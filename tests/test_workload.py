"""Every registered query against its SQL, and the shape of its plan."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare

from workload.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert compare(name, spark, db, SF).startswith(("ok", "rows-only"))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


STORING = ("a1_", "a2_", "a3_list_hours", "a10_", "i2_compacted", "k3_", "k6_", "k7_", "k8_ledger")


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.startswith(STORING)])
def test_building_a_query_runs_no_job(spark, name):
    """Only queries about stored tables write them first."""
    tracker, group = spark.sparkContext.statusTracker(), f"build {name}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        entry.queries()[name](spark, SF)
        assert not list(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.startswith(("k6", "k7", "k8_ledger"))])
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
