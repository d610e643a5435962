from datetime import timedelta

from pyspark.sql import functions as F

from changeflow.operators.rollup import daily_rollup, distinct_users, namespace_name, user_sketches
from changeflow.operators.staging import staging, staging_of_unique, type_records
from changeflow.schemas import MART, STAGING

from .helpers import DAY, one, optimized, plan_of, raw_table, record


def first(spark, payload):
    return staging(raw_table(spark, [payload])).first()


def test_all_columns_are_typed(spark):
    row = first(
        spark,
        {
            "rcid": 9,
            "type": "log",
            "ns": -1,
            "title": "Tiêu đề",
            "pageid": 11,
            "revid": "12",
            "old_revid": 0,
            "user": "ann",
            "userid": 14,
            "comment": "c",
            "timestamp": "2024-05-01T08:30:00+07:00",
            "oldlen": 5,
            "newlen": -6,
            "bot": False,
            "redirect": None,
            "userhidden": "",
            "tags": ["a", "b"],
        },
    )
    assert row.asDict() == {
        "change_id": 9,
        "change_type": "log",
        "namespace_id": -1,
        "page_title": "Tiêu đề",
        "page_id": 11,
        "revision_id": 12,
        "old_revision_id": 0,
        "user_name": "ann",
        "user_id": 14,
        "change_comment": "c",
        "changed_at_utc": row["changed_at_utc"],
        "old_length": 5,
        "new_length": -6,
        "is_bot": True,
        "is_minor": False,
        "is_anonymous": False,
        "is_redirect": True,
        "is_user_hidden": True,
        "is_user_missing": False,
        "tag_count": 2,
        "_window_start": row["_window_start"],
        "_window_end": row["_window_end"],
        "_ingested_at": row["_ingested_at"],
    }
    frame = staging(raw_table(spark, [record()]))
    assert frame.select(F.date_format("changed_at_utc", "HH:mm")).first()[0] == "01:00"
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in STAGING]


def test_blank_and_bad_values_become_null(spark):
    row = first(spark, {"rcid": 1, "type": "", "ns": "x", "title": "", "pageid": -3, "user": "", "oldlen": "1.5", "ns ": 3})
    assert row["change_type"] is None and row["namespace_id"] is None and row["page_title"] is None
    assert row["page_id"] is None and row["old_length"] is None and row["changed_at_utc"] is None
    assert row["user_name"] == "unknown" and row["is_user_missing"] is True
    assert first(spark, {"rcid": 1, "user": "unknown"})["is_user_missing"] is False


def test_the_newest_row_wins_and_ids_break_ties(spark):
    later = DAY + timedelta(days=3)
    raw = raw_table(
        spark,
        [
            (record(1, comment="late"), later),
            (record(1, comment="early"), DAY),
            (record(2, comment="low id"), DAY),
            (record(2, comment="high id"), DAY),
        ],
    )
    assert {r["change_id"]: r["change_comment"] for r in staging(raw).collect()} == {1: "late", 2: "high id"}


def test_rows_without_a_typed_key_leave_one_survivor(spark):
    raw = raw_table(spark, [record(-5, comment="a"), record(" 12 ", comment="b"), record(7), record("x", comment="c")])
    got = [(r["change_id"], r["change_comment"]) for r in staging(raw).collect()]
    assert sorted(got, key=str) == [(7, None), (None, "c")]


def test_deduplication_shuffles_typed_columns_only(spark):
    plan = plan_of(staging(raw_table(spark, [record()])).select("change_id", "namespace_id"))
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below
    shuffled = plan[: plan.index("Exchange hashpartitioning")]
    assert "_raw#" not in shuffled


def test_a_unique_raw_table_needs_no_shuffle(spark):
    raw = raw_table(spark, [record(1), record(2)])
    assert "Exchange" not in plan_of(staging_of_unique(raw))
    assert sorted(staging_of_unique(raw).drop("_raw_id").collect()) == sorted(staging(raw).collect())


def test_namespace_names(spark):
    assert one(spark, namespace_name, 0, 15, 8, -1, None, schema="int") == [
        "Bài viết",
        "Thảo luận thể loại",
        "Namespace 8",
        "Namespace -1",
        None,
    ]


def test_rollup_counts_per_day_and_namespace(spark):
    raw = raw_table(
        spark,
        [
            record(1, bot=True, oldlen=10, newlen=4),
            record(2, type="new", user="", anon=False),
            record(3, type="log", user="bob", minor=None, newlen=9),
            record(4, type="categorize", user="bob"),
            record(5, user="unknown", oldlen=1, newlen=2),
            record(6, ns="x"),
            record(7, hour=23, ns=1),
            record(8, hour=24, ns=1),
        ],
    )
    mart = daily_rollup(staging(raw))
    rows = {(str(r["activity_date"]), r["namespace_id"]): r for r in mart.collect()}
    assert set(rows) == {("2024-05-01", 0), ("2024-05-01", None), ("2024-05-01", 1), ("2024-05-02", 1)}
    busy = rows[("2024-05-01", 0)].asDict()
    assert {k: busy[k] for k in MART.fieldNames()[3:13]} == {
        "total_changes": 5,
        "edit_count": 2,
        "new_page_count": 1,
        "log_count": 1,
        "bot_changes": 1,
        "anonymous_changes": 1,
        "minor_changes": 1,
        "missing_user_changes": 1,
        "unique_users": 3,
        "net_bytes_change": -5,
    }
    assert str(busy["bot_rate"]) == "0.2000" and busy["namespace_name"] == "Bài viết"
    assert rows[("2024-05-01", None)]["namespace_name"] is None
    assert [(f.name, f.dataType) for f in mart.schema] == [(f.name, f.dataType) for f in MART]


def test_sketches_count_a_user_of_several_namespaces_and_days_once(spark):
    raw = raw_table(
        spark,
        [record(1, user="ann"), record(2, user="ann", ns=1), record(3, user="bob"), record(4, hour=25, user="ann"), record(5, hour=50, user="")]
        + [record(100 + n, hour=49, user=f"u{n}") for n in range(2000)],
    )
    sketches = user_sketches(staging(raw))
    days = {str(r["activity_date"]): r["distinct_users"] for r in distinct_users(sketches, "activity_date").collect()}
    assert (days["2024-05-01"], days["2024-05-02"]) == (2, 1)
    assert abs(days["2024-05-03"] - 2000) <= 60
    assert abs(distinct_users(sketches).first()["distinct_users"] - 2002) <= 60
    assert distinct_users(sketches.filter("false"), "activity_date").count() == 0


def test_rollup_does_not_expand_rows_for_the_distinct_count(spark):
    mart = daily_rollup(staging(raw_table(spark, [record()])))
    assert "Expand" not in optimized(mart)
    plan = plan_of(mart)
    assert plan.count("partial_count") > 0 and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_users_are_spread_before_the_grain_is_shuffled(spark):
    plan = plan_of(daily_rollup(staging(raw_table(spark, [record()]))))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "user_name" in exchanges[1] and "user_name" not in exchanges[0]


def test_every_accepted_clock_form_keeps_its_event_time(spark):
    stamps = ["2024-05-01T10:00Z", "20240501T100000Z", "2024-05-01 10:00:00,0+00", "2024-05-01T10:00:00", "2024-05-01T17:00:00+0700"]
    staged = staging(raw_table(spark, [{"rcid": i, "timestamp": t} for i, t in enumerate(stamps)]))
    assert [r[0] for r in staged.select(F.date_format("changed_at_utc", "HH:mm")).collect()] == ["10:00"] * 5


def test_only_the_keys_behind_the_columns_are_parsed(spark):
    raw = raw_table(spark, [record(1)])
    plan = optimized(type_records(raw, ["change_id", "is_bot"]))
    assert "rcid" in plan and "bot" in plan and not any(k in plan for k in ("comment", "title", "oldlen", "tags", "userhidden"))
    narrow = staging(raw, ["changed_at_utc", "namespace_id"])
    assert narrow.columns[:3] == ["change_id", "namespace_id", "changed_at_utc"]
    wide = staging(raw).select(narrow.columns)
    assert narrow.collect() == wide.collect()
