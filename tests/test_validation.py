import json
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.operators.validation import classify, error_rows, valid_records

from .helpers import optimized, raw_table, record


def judge(spark, *payloads):
    rows = classify(raw_table(spark, payloads)).orderBy("_raw_id").collect()
    return [(r["status"], r["error_type"], r["error_message"]) for r in rows]


def test_first_failing_rule_names_the_error(spark):
    assert judge(
        spark,
        record(1),
        {"timestamp": "nonsense"},
        {"rcid": None, "timestamp": "x"},
        {"rcid": "abc"},
        {"rcid": 7},
        {"rcid": 7, "timestamp": None},
        {"rcid": 7, "timestamp": "2024-05-01T01:00:00"},
        {"rcid": 7, "timestamp": "yesterday"},
        "[1]",
        "5",
        "null",
        "{broken",
        "",
    ) == [
        ("ok", None, None),
        ("error", "invalid_natural_key", "'rcid'"),
        (
            "error",
            "invalid_natural_key",
            "int() argument must be a string, a bytes-like object or a real number, not 'NoneType'",
        ),
        ("error", "invalid_natural_key", "invalid literal for int() with base 10: 'abc'"),
        ("error", "invalid_timestamp", "'timestamp'"),
        ("error", "invalid_timestamp", "Invalid isoformat string: 'None'"),
        ("error", "invalid_timestamp", "Timestamp has no timezone: 2024-05-01T01:00:00"),
        ("error", "invalid_timestamp", "Invalid isoformat string: 'yesterday'"),
        ("error", "invalid_natural_key", "record is not a JSON object"),
        ("error", "invalid_natural_key", "record is not a JSON object"),
        ("error", "invalid_natural_key", "record is not a JSON object"),
        ("error", "invalid_record", "Unknown validation error"),
        ("error", "invalid_record", "Unknown validation error"),
    ]


def test_windows_are_half_open(spark):
    stamps = ["2024-04-30T23:59:59Z", "2024-05-01T00:00:00Z", "2024-05-01T23:59:59.999999Z", "2024-05-02T00:00:00Z"]
    stamps += ["2024-05-02T05:00:00+07:00", "2024-05-01T05:00:00+07:00"]
    got = judge(spark, *[{"rcid": i, "timestamp": t} for i, t in enumerate(stamps)])
    assert [g[0] for g in got] == ["outside_window", "ok", "ok", "outside_window", "ok", "outside_window"]


def test_numbers_that_are_no_plain_integers_are_refused(spark):
    texts = ["12.0", "1e3", "true", "99999999999999999999", '"12"', '" 12 "', '"1_000"', "-5", '"+5"']
    got = classify(raw_table(spark, [f'{{"rcid":{t},"timestamp":"2024-05-01T01:00:00Z"}}' for t in texts]))
    assert [r["_key"] for r in got.orderBy("_raw_id").collect()] == [None] * 4 + [12, 12, 1000, -5, 5]


def test_messages_are_cut(spark):
    rows = error_rows(classify(raw_table(spark, [{"rcid": "a" * 5000}]))).collect()
    assert len(rows[0]["_error_message"]) == 2000


#: Parts of a record with the fate they lead to; a bad key decides before the time does.
_keys = st.one_of(
    st.integers(-10, 10**12).map(lambda k: ({"rcid": k}, True)),
    st.sampled_from(["7", " 12 ", "1_000"]).map(lambda k: ({"rcid": k}, True)),
    st.sampled_from(["x", None, [1], "", "1.5"]).map(lambda k: ({"rcid": k}, False)),
    st.just(({}, False)),
)
_inside = st.datetimes(datetime(2024, 5, 1), datetime(2024, 5, 1, 23, 59, 59))
_outside = st.one_of(st.datetimes(datetime(2024, 4, 20), datetime(2024, 4, 30, 23)), st.datetimes(datetime(2024, 5, 2), datetime(2024, 5, 9)))
_times = st.one_of(
    _inside.map(lambda t: ({"timestamp": f"{t.isoformat()}Z"}, "ok")),
    _outside.map(lambda t: ({"timestamp": f"{t.isoformat()}Z"}, "outside_window")),
    _inside.map(lambda t: ({"timestamp": f"{(t + timedelta(hours=7)).isoformat()}+07:00"}, "ok")),
    _outside.map(lambda t: ({"timestamp": f"{(t - timedelta(hours=4)).isoformat()}-04:00"}, "outside_window")),
    _inside.map(lambda t: ({"timestamp": t.isoformat()}, "error")),
    st.sampled_from([({"timestamp": None}, "error"), ({"timestamp": "junk"}, "error"), ({}, "error")]),
)


def _made(key, time):
    """A record, and the route it was made for."""
    (key_part, key_good), (time_part, fate) = key, time
    if not key_good:
        return {**key_part, **time_part}, ("error", "invalid_natural_key")
    return {**key_part, **time_part}, (fate, "invalid_timestamp" if fate == "error" else None)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.builds(_made, _keys, _times), min_size=1, max_size=40))
def test_records_take_the_route_they_were_made_for(spark, made):
    got = [(s, t) for s, t, _ in judge(spark, *[json.dumps(r) for r, _ in made])]
    assert got == [route for _, route in made]


def test_routing_parses_each_payload_once(spark):
    plan = optimized(valid_records(classify(raw_table(spark, [record()]))).select("_key"))
    assert plan.count("from_json") == 1
    # once for the key and once per accepted clock form: no filter repeats them
    assert plan.count("regexp_replace") == 5


def test_every_record_gets_one_route(spark, sf_dir):
    from changeflow.plans.registry import judged

    rows = judged(spark, sf_dir)
    counts = {r["status"]: r["count"] for r in rows.groupBy("status").count().collect()}
    assert counts == {"ok": 1031, "error": 50, "outside_window": 19}
    types = {r[0]: r[1] for r in rows.filter("status = 'error'").groupBy("error_type").count().collect()}
    assert types == {"invalid_natural_key": 23, "invalid_timestamp": 27}
    assert rows.filter(F.col("status").isNull()).count() == 0
