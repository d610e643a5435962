from datetime import date, datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.operators import windows
from changeflow.sources.landing import source_request

from .helpers import DAY, optimized, plan_of

WINDOW = "_window_start timestamp, _window_end timestamp"


def test_guard_normalizes_and_refuses(spark):
    day = timedelta(days=1)
    asked = spark.createDataFrame(
        [(DAY, DAY + day), (DAY, DAY), (DAY, DAY - day), (DAY - 40 * day, DAY - 39 * day), (DAY - 30 * day, DAY)], WINDOW
    )
    got = windows.guard_windows(asked, DAY).collect()
    assert [r["status"] for r in got] == ["ok", "ok", "invalid_order", "beyond_retention", "ok"]
    assert got[1]["_window_end"] - got[1]["_window_start"] == day


def test_windows_between_are_whole_utc_days(spark):
    got = windows.windows_between(spark, date(2024, 2, 28), date(2024, 3, 1))
    texts = [tuple(r) for r in got.select(F.date_format("_window_start", "MM-dd HH:mm"), F.date_format("_window_end", "MM-dd")).collect()]
    assert texts == [("02-28 00:00", "02-29"), ("02-29 00:00", "03-01"), ("03-01 00:00", "03-02")]


_times = st.datetimes(datetime(2024, 5, 1), datetime(2024, 5, 4)).map(lambda t: t.replace(tzinfo=timezone.utc))
_spans = st.tuples(_times, st.timedeltas(timedelta(0), timedelta(days=2)))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_times, min_size=1, max_size=25), st.lists(_spans, min_size=1, max_size=6))
def test_assignment_agrees_with_testing_all_pairs(spark, times, spans):
    events = spark.createDataFrame(list(enumerate(times)), "id int, t timestamp")
    bounds = [(n, s, s + d) for n, (s, d) in enumerate(spans)]
    spread = spark.createDataFrame(bounds, "w int, " + WINDOW)
    got = sorted((r["id"], r["w"]) for r in windows.assign_windows(events, spread, "t").collect())
    assert got == sorted((i, n) for i, t in enumerate(times) for n, s, e in bounds if s <= t < e)


def test_assignment_is_an_equality_join(spark):
    events = spark.createDataFrame([(DAY,)], "t timestamp")
    spread = spark.createDataFrame([(DAY, DAY + timedelta(days=1))], WINDOW)
    plan = plan_of(windows.assign_windows(events, spread, "t"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Join" not in plan_of(windows.assign_daily(events, "t"))


_lengths = st.sampled_from([timedelta(0), timedelta(microseconds=1), timedelta(seconds=90), timedelta(days=3), timedelta(days=900), -timedelta(hours=1)])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_times, min_size=1, max_size=25), st.lists(st.tuples(_times, _lengths), min_size=1, max_size=6))
def test_cells_agree_with_testing_all_pairs(spark, times, spans):
    events = spark.createDataFrame([*enumerate(times), (-1, None)], "id int, t timestamp")
    bounds = [(n, s, s + d) for n, (s, d) in enumerate(spans)]
    mixed = spark.createDataFrame(bounds, "w int, " + WINDOW)
    got = sorted((r["id"], r["w"]) for r in windows.assign_windows_by_cells(events, mixed, "t").collect())
    assert got == sorted((i, n) for i, t in enumerate(times) for n, s, e in bounds if s <= t < e)


def test_a_window_of_any_length_takes_few_cells(spark):
    lengths = [timedelta(minutes=1), timedelta(days=1), timedelta(days=366), timedelta(days=36600)]
    odd = DAY + timedelta(seconds=12345, microseconds=7)
    mixed = spark.createDataFrame([(odd, odd + n) for n in lengths], WINDOW)
    cells = windows.window_cells(mixed["_window_start"], mixed["_window_end"])
    sizes = [r[0] for r in mixed.select(F.size(cells)).collect()]
    assert max(sizes) <= 240 and sizes[0] <= 60
    before_the_epoch = spark.createDataFrame([(datetime(1960, 1, 1, tzinfo=timezone.utc), DAY)], WINDOW)
    events = spark.createDataFrame([(datetime(1965, 3, 4, 5, 6, 7, tzinfo=timezone.utc),), (DAY,)], "t timestamp")
    joined = windows.assign_windows_by_cells(events, before_the_epoch, "t")
    assert joined.count() == 1 and "NestedLoop" not in plan_of(joined) and "Cartesian" not in plan_of(joined)


def test_requests_carry_interval_types_and_properties(spark):
    row = source_request(spark.createDataFrame([(DAY, DAY + timedelta(days=1))], WINDOW)).first()
    assert (row["rcstart"], row["rcend"], row["rcdir"]) == ("2024-05-01T00:00:00Z", "2024-05-02T00:00:00Z", "newer")
    assert row["rctype"] == "edit|new|log|categorize|external" and row["rcprop"].startswith("title|ids|sizes")


def test_source_predicate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "events")
    df = spark.createDataFrame([(DAY + timedelta(hours=h), k) for h, k in [(0, "edit"), (5, "log"), (24, "edit"), (25, "edit")]], "t timestamp, k string")
    df.write.parquet(path)
    asked = windows.source_predicate(spark.read.parquet(path), "t", "k", DAY, DAY + timedelta(days=1), ["edit"])
    assert asked.count() == 2
    assert "PushedFilters: [IsNotNull(t)" in plan_of(asked) and "GreaterThanOrEqual(t" in plan_of(asked)
    assert "Sort [t" in optimized(asked)
