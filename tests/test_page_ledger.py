from datetime import timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.operators import digests
from changeflow.operators.page_ledger import ledger_violations, merged_intervals, page_intervals
from changeflow.plans import jobs
from changeflow.sources import landing
from changeflow.sources.tables import Warehouse

from .helpers import DAY, page, pages_frame, plan_of, raw_table, record

SCHEMA = "_window_start timestamp, _window_end timestamp, first_page long, last_page long, has_more boolean"
END = DAY + timedelta(days=1)


def intervals_of(df):
    return sorted((r["first_page"], r["last_page"], r["has_more"]) for r in df.collect())


def test_pages_that_land_in_reverse_over_three_batches_close_their_window(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/w")
    asked = spark.createDataFrame([(DAY, END), (END, END + timedelta(days=1))], "_window_start timestamp, _window_end timestamp")
    more = {"rccontinue": "x"}
    batches = [[(5, None), (4, more)], [(2, more)], [(3, more), (1, more)]]
    seen = []
    for n, batch in enumerate(batches):
        land = f"{tmp_path}/{n}"
        landing.write_pages(pages_frame(spark, [(DAY, k, page([record(k)], more=m)) for k, m in batch]), land)
        jobs.load_pages(warehouse, landing.read_lines(spark, land), complete=False)
        found = jobs.open_windows(warehouse, asked, 4).filter("reason <> 'missing_window'").collect()
        seen.append(sorted((r["reason"], r["page_no"]) for r in found))
    assert seen == [[("page_gap", 1), ("page_limit", 5)], [("page_gap", 1), ("page_gap", 3), ("page_limit", 5)], [("page_limit", 5)]]
    assert [r["_window_start"].day for r in jobs.open_windows(warehouse, asked).collect()] == [END.day]
    assert intervals_of(merged_intervals(warehouse.page_intervals([DAY.date()]))) == [(1, 5, False)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.integers(1, 30), max_size=8), min_size=1, max_size=4))
def test_merged_intervals_hold_the_same_pages_in_any_division(spark, batches):
    rows = [(DAY, END, n, n, True) for batch in batches for n in batch]
    parts = [spark.createDataFrame([(DAY, END, n, n, True) for n in batch], SCHEMA) for batch in batches]
    merged = [merged_intervals(p) for p in parts]
    together = merged[0]
    for m in merged[1:]:
        together = together.unionByName(m)
    got = intervals_of(merged_intervals(together))
    assert got == intervals_of(merged_intervals(spark.createDataFrame(rows, SCHEMA)))
    assert sorted({n for batch in batches for n in batch}) == [n for a, b, _ in got for n in range(a, b + 1)]
    assert all(b + 1 < c for (_, b, _), (c, _, _) in zip(got, got[1:], strict=False))


def test_bad_pages_are_gaps_and_a_refetched_last_page_has_the_word(spark):
    rows = [(DAY, END, 1, True, False, True), (DAY, END, 2, True, True, True), (DAY, END, 3, True, False, True), (DAY, END, 3, True, False, False)]
    pages = spark.createDataFrame(rows, "_window_start timestamp, _window_end timestamp, page_no long, readable boolean, has_error boolean, has_more boolean")
    ledger = page_intervals(pages)
    assert intervals_of(ledger) == [(1, 1, True), (3, 3, False)]
    assert [(r["reason"], r["page_no"]) for r in ledger_violations(ledger).collect()] == [("page_gap", 2)]


def snapshot(spark, path, payloads):
    raw = raw_table(spark, payloads).withColumn("day", F.date_add(F.lit(DAY.date()), (F.col("_raw_id") % 5).cast("int")))
    raw.write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def test_the_audit_reads_only_days_that_differ(spark, tmp_path):
    payloads = [record(n) for n in range(40)]
    before = snapshot(spark, f"{tmp_path}/a", payloads)
    after = snapshot(spark, f"{tmp_path}/b", [record(n, title="other") if n == 12 else record(n) for n in range(40)])
    found = digests.snapshot_drilldown(before, after.filter("_raw_id <> 33"), "_raw_id", "day")
    assert sorted((r["_raw_id"], r["violation"]) for r in found.collect()) == [(13, "changed"), (33, "vanished")]
    days = [r["day"] for r in found.select("day").distinct().collect()]
    (day,) = set(days)
    assert plan_of(found).count(f"PartitionFilters: [isnotnull(day") + plan_of(found).count("PartitionFilters: [day") >= 2 and str(day) in plan_of(found)
    assert digests.snapshot_drilldown(before, before, "_raw_id", "day").count() == 0


def test_digests_add_up_and_see_repeats_nulls_and_order(spark):
    raw = raw_table(spark, [record(1), record(1), None, record(2)]).drop("_raw_id")
    parts = raw.withColumn("part", F.monotonically_increasing_id() % 3)
    columns = raw.columns
    whole = digests.digests(raw, []).first()
    assert digests.added(digests.digests(parts, ["part"], columns), []).first() == whole
    assert digests.digests(raw.orderBy(F.desc("_raw")), []).first() == whole
    assert digests.digests(raw.distinct(), []).first() != whole
    assert digests.digests(raw.fillna("", ["_raw"]), []).first() != whole
