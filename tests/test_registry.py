"""Every registered query against its SQL on whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from changeflow.plans.oracles import ORACLES
from changeflow.plans.registry import QUERIES
from check_oracles import compare, connect

from .helpers import plan_of


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, db, sf_dir, name):
    good, note = compare(spark, db, name, sf_dir)
    assert good, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 441 and df.columns[:3] == ["activity_date", "namespace_id", "namespace_name"]


@pytest.mark.parametrize(
    "name", ["mart_daily", "stg_events", "record_status", "raw_insert", "quarantine", "top_namespaces", "assigned_general_windows"]
)
def test_plans_stay_on_the_jvm_and_join_by_equality(spark, sf_dir, name):
    plan = plan_of(queries()[name](spark, sf_dir))
    for word in ("BatchEvalPython", "ArrowEvalPython", "PythonMapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
