import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changeflow.operators import audits, quality, reports
from changeflow.operators.rollup import GRAIN, daily_rollup
from changeflow.operators.staging import staging

from .helpers import DAY, optimized, plan_of, raw_table, record


@pytest.fixture(scope="module")
def clean(spark):
    raw = raw_table(spark, [record(i, ns=i % 3, hour=i % 24, user=f"u{i % 5}", **({"bot": 1} if i % 4 == 0 else {})) for i in range(60)])
    staged = staging(raw)
    return raw, staged, daily_rollup(staged)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_a_clean_warehouse_passes_all_seventeen_checks(clean):
    report = quality.quality_report(*clean)
    got = report.collect()
    assert len(got) == 17 and all(r["passed"] and r["violations"] == 0 for r in got)
    quality.require_quality(report)


def test_the_grain_check_finds_a_doubled_row_and_fails_the_run(clean):
    raw, staged, mart = clean
    damaged = audits.inject_duplicate(mart)
    assert [r["row_count"] for r in quality.grain(damaged, GRAIN).collect()] == [2]
    with pytest.raises(quality.QualityError, match="daily grain"):
        quality.require_quality(quality.quality_report(raw, staged, damaged))


def test_not_null_names_row_and_column(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 5, None), (3, None, None)], "id int, a int, b string")
    assert rows(quality.not_null(df, ["a", "b"], ["id"])) == [(1, "a"), (2, "b"), (3, "a"), (3, "b")]
    assert rows(quality.null_counts(df, ["id", "a", "b"])) == [("a", 3, 2), ("b", 3, 2), ("id", 3, 0)]


def test_unique_and_grain_treat_missing_values_differently(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert rows(quality.unique(df, "k")) == [(1, 2)]
    assert rows(quality.grain(df, ["k"])) == [(1, 2), (None, 2)]


def test_accepted_values_let_missing_ones_pass(spark):
    df = spark.createDataFrame([("edit",), ("move",), ("move",), (None,)], "t string")
    assert rows(quality.accepted_values(df, "t", ["edit"])) == [("move", 2)]


def test_inside_window_lets_missing_times_pass(spark):
    raw = raw_table(spark, [record(1, hour=0), record(2, hour=24), record(3, hour=-1), {"rcid": 4}])
    assert sorted(r["change_id"] for r in quality.inside_window(staging(raw)).collect()) == [2, 3]


def test_ranges(spark):
    df = spark.createDataFrame(
        [(1, Decimal("0.5")), (-1, Decimal("0")), (2, Decimal("1.0001")), (3, Decimal("-0.1")), (None, None)],
        "n int, r decimal(9,4)",
    )
    assert [r["n"] for r in quality.ranges(df, ["n"], ["r"]).collect()] == [-1, 2, 3]


def test_reconciliation_pairs_missing_keys_only_if_asked(spark):
    left = spark.createDataFrame([(1, 5), (2, 6), (None, 7), (4, 1)], "k int, e long")
    right = spark.createDataFrame([(1, 5), (2, 9), (None, 7), (3, 2)], "k int, a long")
    strict = rows(quality.reconcile(left, right, ["k"], "e", "a"))
    assert strict == sorted([(2, 6, 9), (3, None, 2), (4, 1, None), (None, 7, None), (None, None, 7)], key=str)
    safe = rows(quality.reconcile(left, right, ["k"], "e", "a", null_safe_keys=True))
    assert safe == sorted([(2, 6, 9), (3, None, 2), (4, 1, None)], key=str)


def test_no_check_plans_a_product_of_rows(clean):
    raw, staged, mart = clean
    for df in (quality.staging_mart_reconciliation(staged, mart), quality.quality_report(raw, staged, mart)):
        assert "CartesianProduct" not in plan_of(df) and "BroadcastNestedLoopJoin" not in plan_of(df)


def test_reports(spark, clean):
    mart = clean[2]
    total = reports.daily_total_changes(mart).collect()
    assert [(str(r[0]), r[1]) for r in total] == [("2024-05-01", 60)]
    assert str(reports.daily_rates(mart).first()["bot_rate"]) == "0.2500"
    kpis = reports.latest_day_kpis(mart).first()
    assert kpis["namespace_user_occurrences"] == 15 and kpis["total_changes"] == 60
    assert {(r["change_type"], r["changes"]) for r in reports.change_types_long(mart).collect()} == {
        ("edit_count", 60),
        ("new_page_count", 0),
        ("log_count", 0),
    }


def test_top_namespaces_merge_equal_labels_and_break_ties_by_name(spark):
    mart = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1), ("c", 2), (None, 2)], "namespace_name string, total_changes long")
    assert [r[0] for r in reports.top_namespaces(mart, 4).collect()] == ["c", "a", "b", None]
    assert "TakeOrderedAndProject" in plan_of(reports.top_namespaces(mart))


def test_weighted_rates_are_no_mean_of_rates(spark):
    mart = spark.createDataFrame(
        [(DAY.date(), 1, 1, 0), (DAY.date(), 9, 0, 0)],
        "activity_date date, total_changes long, bot_changes long, anonymous_changes long",
    )
    assert str(reports.daily_rates(mart).first()["bot_rate"]) == "0.1000"


def test_audit_tells_changed_from_vanished(spark):
    before = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", "d"), (4, None, "e")], "id int, x string, y string")
    after = spark.createDataFrame([(1, "a", None), (2, None, "b"), (4, "e", None), (9, "n", None)], "id int, x string, y string")
    assert rows(audits.append_only_audit(before, after, "id")) == [(2, "changed"), (3, "vanished"), (4, "changed")]
    assert audits.append_only_audit(before, before.union(after.filter("id = 9")), "id").count() == 0
    assert sorted(r["id"] for r in audits.vanished_rows(before, after).collect()) == [2, 3, 4]


def test_audit_moves_no_payload(spark):
    before = raw_table(spark, [record(1)])
    plan = optimized(audits.append_only_audit(before, before, "_raw_id"))
    sides = [line for line in plan.splitlines() if "xxhash64" in line]
    assert len(sides) == 2
    assert all(re.search(r"Project \[_raw_id#\d+L, struct\(col1, xxhash64\(", s) for s in sides)


def test_comparing_runs(spark):
    a = spark.createDataFrame([(1, 5), (2, 6), (None, 1)], "k int, v int")
    b = spark.createDataFrame([(1, 5), (2, 7), (None, 1), (3, 8)], "k int, v int")
    assert rows(audits.compare_runs(a, b, ["k"], ["v"])) == sorted(
        [(1, 5, 5, True), (2, 6, 7, False), (3, None, 8, False), (None, 1, 1, True)], key=str
    )


def test_checks_work_on_other_tables(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert quality.ranges(items, ["l_quantity"], ["l_discount", "l_tax"]).count() == 0
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    assert quality.unique(orders, "o_orderkey").count() == 0
    assert quality.accepted_values(orders, "o_orderstatus", ["O", "F", "P"]).count() == 0
    assert quality.null_counts(orders, orders.columns).agg(F.sum("violations")).first()[0] == 0
