"""Bloom filters of stored keys: nothing stored is ever denied, and days without a key stay closed."""

from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.operators import key_filters as kf
from changeflow.plans import jobs
from changeflow.sources.tables import Warehouse

from .helpers import DAY, page, plan_of, record
from .test_jobs import Place

SCHEMA = "_key long, event_date string"


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, str(tmp_path))


def filters_of(keys):
    sizes = keys.groupBy("event_date").agg(F.count("_key").alias("keys"))
    return kf.key_filters(keys, sizes, "_key")


def asked(keys, filters):
    levels = [r["level"] for r in filters.select("level").distinct().collect()]
    return {(r["_key"], r["event_date"]) for r in kf.possible_days(keys, filters, "_key", levels).collect()}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)), st.sampled_from("abc")), min_size=1, max_size=40))
def test_a_stored_key_passes_the_filter_of_its_day(spark, rows):
    keys = spark.createDataFrame(rows, SCHEMA)
    found = asked(keys, filters_of(keys))
    assert {r for r in rows if r[0] is not None} <= found
    assert all(k is not None for k, _ in found)


def test_few_unknown_keys_pass_at_any_size(spark):
    sized = {"a": 10, "b": 3_000, "c": 40_000}
    parts = [spark.range(n).select((F.col("id") * 48271).alias("_key"), F.lit(d).alias("event_date")) for d, n in sized.items()]
    filters = filters_of(parts[0].union(parts[1]).union(parts[2])).cache()
    blocks = {r["event_date"]: (r["level"], r["n"]) for r in filters.groupBy("event_date", "level").agg(F.count("*").alias("n")).collect()}
    assert blocks == {"a": (0, 1), "b": (1, 2), "c": (5, 32)}
    others = spark.range(10_000).select((-F.col("id") * 16807 - 1).alias("_key"))
    passed = asked(others, filters)
    for day in sized:
        assert sum(d == day for _, d in passed) < 100
    filters.unpersist()


def test_copies_and_no_keys(spark):
    keys = spark.createDataFrame([(7, "a")] * 500 + [(None, "b")], SCHEMA)
    filters = filters_of(keys).collect()
    assert [(r["event_date"], r["level"], r["block"]) for r in filters] == [("a", 0, 0)]
    empty = spark.createDataFrame([], SCHEMA)
    assert filters_of(empty).count() == 0
    assert asked(empty, filters_of(keys)) == set()


def test_asking_is_an_equality_on_the_block(spark):
    keys = spark.createDataFrame([(1, "a")], SCHEMA)
    plan = plan_of(kf.possible_days(keys, filters_of(keys), "_key", [0]))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def land_days(place, days):
    """Daily loads whose keys lie between one another: day n has n, n + 10, n + 20, ..."""
    for n in range(days):
        day = DAY + timedelta(days=n)
        place.land((day, 1, page([record(n + 10 * i, day=day) for i in range(20)])))
        place.run(day.date())


def test_only_days_that_may_hold_a_key_are_opened(place, spark):
    land_days(place, 4)
    warehouse, days = place.warehouse, [(DAY + timedelta(days=n)).date() for n in range(4)]
    keys = spark.createDataFrame([(52,), (105,)], "_key long")
    loads = warehouse.loads()
    assert jobs.days_of_keys(loads, [(52, 105)]) == days
    assert jobs.days_with_keys(warehouse, keys, loads, days) == [days[2]]
    assert jobs.days_with_keys(warehouse, keys.filter("_key = 105"), loads, days) == []
    assert jobs.days_with_keys(warehouse, keys, loads, []) == []


def test_keys_of_other_days_are_still_found(place):
    land_days(place, 3)
    day = DAY + timedelta(days=3)
    place.land((day, 1, page([record(k, day=day) for k in (3, 11, 42, 43, 190)])))
    assert place.counters(place.run(day.date()))["inserted"] == 2
    assert len(place.keys()) == len(set(place.keys())) == 62


def test_a_load_without_a_filter_is_read_whole(place, spark):
    land_days(place, 2)
    days = [DAY.date(), (DAY + timedelta(days=1)).date()]

    class Older(Warehouse):
        def key_filters(self, days=None):
            return super().key_filters(days).filter(F.col("event_date") != F.lit(DAY.date()))

    older, keys = Older(spark, place.root), spark.createDataFrame([(105,)], "_key long")
    assert jobs.days_with_keys(older, keys, older.loads(), days) == [DAY.date()]


def test_a_day_hit_by_its_own_keys_is_not_asked_again(place, spark, monkeypatch):
    land_days(place, 3)
    days, asked_days, ask = [(DAY + timedelta(days=n)).date() for n in range(3)], [], jobs.possible_days

    def noting(keys, filters, *more):
        asked_days.append((keys.count(), {r["event_date"] for r in filters.select("event_date").distinct().collect()}))
        return ask(keys, filters, *more)

    monkeypatch.setattr(jobs, "possible_days", noting)
    rows = [(10, days[0]), (11, days[1]), (42, days[0])]
    keys = spark.createDataFrame(rows, "_key long, event_date date")
    assert jobs.days_with_keys(place.warehouse, keys, place.warehouse.loads(), days) == days
    assert asked_days == [(3, {days[2]})]


def test_some_of_many_keys_ask_before_all_do(place, spark, monkeypatch):
    land_days(place, 2)
    days, counts, ask = [(DAY + timedelta(days=n)).date() for n in range(2)], [], jobs.possible_days

    def noting(keys, *more):
        counts.append(keys.count())
        return ask(keys, *more)

    monkeypatch.setattr(jobs, "possible_days", noting)
    monkeypatch.setattr(jobs, "SOME_KEYS", 100)
    keys = spark.range(10_000).select((F.col("id") * 10 + 1).alias("_key"))
    assert jobs.days_with_keys(place.warehouse, keys, place.warehouse.loads(), days, 10_000) == [days[1]]
    assert 20 < counts[0] < 500 and counts[-1] == 10_000
