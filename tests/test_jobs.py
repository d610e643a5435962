import json
import os
import sys
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from changeflow.__main__ import main
from changeflow.operators import audits, gates, quality
from changeflow.operators.inserts import COUNTERS, total_stats
from changeflow.operators.quality import QualityError
from changeflow.operators.rollup import daily_rollup
from changeflow.operators.staging import staging
from changeflow.plans import jobs
from changeflow.session import materialize, shared_dir
from changeflow.sources import fixture, landing
from changeflow.sources.tables import Warehouse

from .helpers import DAY, optimized, page, pages_frame, plan_of, record

NEXT = DAY + timedelta(days=1)


class Place:
    def __init__(self, spark, path):
        self.spark, self.landing, self.root = spark, f"{path}/landing", f"{path}/warehouse"
        self.warehouse = Warehouse(spark, self.root)

    def land(self, *triples):
        landing.write_pages(pages_frame(self.spark, triples), self.landing)

    def run(self, *dates, **options):
        return jobs.run(self.spark, self.landing, self.root, list(dates) or None, **options)

    def counters(self, stats):
        return {k: v for k, v in total_stats(stats).first().asDict().items() if k in COUNTERS}

    def mart(self):
        return sorted((tuple(r) for r in self.warehouse.mart().collect()), key=str)

    def keys(self):
        return sorted(r["_key"] for r in self.warehouse.raw().collect())


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, str(tmp_path))


def test_a_run_loads_transforms_and_checks_and_a_rerun_changes_nothing(place):
    place.land(
        (DAY, 1, page([record(1), record(2, hour=30), {"rcid": "x"}, record(1, comment="again")], {"c": "1"})),
        (DAY, 2, page([record(2), {"rcid": "x"}, record(3)])),
    )
    first = place.counters(place.run())
    assert first == {"fetched": 7, "inserted": 3, "duplicates": 1, "quarantined": 1, "outside_window": 1, "pages": 2}
    raw = place.warehouse.raw()
    assert json.loads(raw.filter("_key = 1").first()["_raw"]).get("comment") is None
    assert raw.select("_raw_id").distinct().count() == 3
    order = [r["_key"] for r in raw.orderBy("_raw_id").collect()]
    assert order == [1, 2, 3]
    before, mart = materialize(raw, "before"), place.mart()

    again = place.counters(place.run())
    assert again == {"fetched": 7, "inserted": 0, "duplicates": 4, "quarantined": 0, "outside_window": 1, "pages": 2}
    after = place.warehouse.raw()
    assert audits.append_only_audit(before, after, "_raw_id").count() == 0 and after.count() == 3
    assert place.mart() == mart
    assert place.warehouse.errors().count() == 1
    assert place.warehouse.load_stats().count() == 4


def test_pages_without_records_are_counted(place):
    place.land((DAY, 1, page([])), (NEXT, 1, {}))
    stats = jobs.load_pages(place.warehouse, landing.read_lines(place.spark, place.landing))
    assert place.counters(stats)["pages"] == 2 and place.warehouse.raw().count() == 0
    assert jobs.loaded_days(stats) == [DAY.date(), NEXT.date()]
    nothing = jobs.load_pages(place.warehouse, landing.read_lines(place.spark, place.landing, [date(2020, 1, 1)]))
    assert place.counters(nothing)["pages"] == 0


def test_late_events_only_add(place):
    place.land((DAY, 1, page([record(1)])))
    place.run()
    place.land((DAY, 2, page([record(2)])))
    assert place.counters(place.run())["inserted"] == 1
    assert [r[3] for r in place.mart()] == [2]


def test_a_day_by_day_warehouse_equals_one_backfill(spark, tmp_path):
    daily, whole = Place(spark, str(tmp_path / "a")), Place(spark, str(tmp_path / "b"))
    triples = [
        (DAY + timedelta(days=d), n, page([record(100 * d + 10 * n + i, day=DAY + timedelta(days=d), ns=i) for i in range(4)], {"c": 1} if n == 1 else None))
        for d in range(3)
        for n in (1, 2)
    ]
    for p in (daily, whole):
        p.land(*triples)
    for d in (1, 0, 2):
        daily.run((DAY + timedelta(days=d)).date())
    coverage = jobs.backfill(spark, whole.landing, whole.root, DAY.date(), (DAY + timedelta(days=2)).date(), retention_days=None)
    row = coverage.first()
    assert (row["min_date"], row["max_date"], row["number_of_days"], row["total_changes"]) == (date(2024, 5, 1), date(2024, 5, 3), 3, 24)
    assert daily.mart() == whole.mart() and daily.keys() == whole.keys()
    full = daily_rollup(staging(daily.warehouse.raw()))
    assert sorted((tuple(r) for r in full.collect()), key=str) == daily.mart()


def _day(n):
    return DAY + timedelta(days=n)


def _resume(place, days=7, **options):
    return jobs.resume_backfill(place.spark, place.landing, place.root, DAY.date(), _day(days - 1).date(), retention_days=None, **options)


def _steps(place):
    return sorted((r["window_date"], r["step"]) for r in place.warehouse.backfill_steps().collect())


def test_a_broken_backfill_goes_on_where_it_broke(place, spark, tmp_path, monkeypatch):
    triples = [(_day(d), 1, page([record(10 * d + i, day=_day(d), ns=i) for i in range(3)] + [{"rcid": f"x{d}"}])) for d in range(7)]
    place.land(*triples)
    whole = Place(spark, str(tmp_path / "whole"))
    whole.land(*triples)
    jobs.backfill(spark, whole.landing, whole.root, DAY.date(), _day(6).date(), retention_days=None)
    asked, inner = [], jobs.load_pages

    def load(warehouse, lines, *args, **options):
        asked.append(sorted(r["window_date"] for r in lines.select("window_date").distinct().collect()))
        if _day(3).date() in asked[-1] and len(asked) == 4:
            raise OSError("lost")
        return inner(warehouse, lines, *args, **options)

    monkeypatch.setattr(jobs, "load_pages", load)
    with pytest.raises(OSError):
        _resume(place, pass_days=1)
    assert _steps(place) == sorted((_day(d).date(), s) for d in range(3) for s in ("load", "refresh", "check"))
    asked.clear()
    _resume(place, pass_days=2)
    assert asked == [[_day(3).date(), _day(4).date()], [_day(5).date(), _day(6).date()]]
    assert place.mart() == whole.mart() and place.keys() == whole.keys()
    asked.clear()
    assert _resume(place).first()["total_changes"] == 21 and not asked
    assert len(_steps(place)) == 21


def test_a_date_with_new_files_is_open_again_and_a_missing_step_alone_is_done(place, monkeypatch):
    place.land(*[(_day(d), 1, page([record(d + 1, day=_day(d))], {"c": 1} if d == 1 else None)) for d in range(3)])
    with pytest.raises(jobs.SourceError, match="incomplete_window"):
        _resume(place, 3, pass_days=1)
    assert {d for d, _ in _steps(place)} == {DAY.date()}
    place.land((_day(1), 2, page([record(50, day=_day(1))])))
    monkeypatch.setattr(jobs, "refresh", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        _resume(place, 3)
    assert [s for d, s in _steps(place) if d != DAY.date()] == ["load", "load"]
    monkeypatch.undo()
    monkeypatch.setattr(jobs, "load_pages", lambda *a, **o: pytest.fail("loaded again"))
    assert _resume(place, 3).first()["total_changes"] == 4
    assert len(_steps(place)) == 9


def test_a_resumed_backfill_of_dates_that_never_landed_fails(place):
    place.land((DAY, 1, page([record(1)])))
    with pytest.raises(jobs.SourceError, match="missing_window"):
        _resume(place, 2, pass_days=1)
    assert place.keys() == [1] and {d for d, _ in _steps(place)} == {DAY.date()}
    plan = plan_of(landing.landed_files(place.spark, place.landing, [DAY.date()]))
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan, plan


def test_good_pages_before_an_error_page_stay(place):
    place.land(
        (DAY, 1, page([record(1)], {"c": 1})),
        (DAY, 2, page([record(2)], error={"code": "busy"})),
        (DAY, 3, page([record(3)])),
        (NEXT, 1, page([record(4, day=NEXT)])),
    )
    with pytest.raises(jobs.SourceError, match="busy"):
        place.run()
    assert place.keys() == [1, 4]
    assert place.warehouse.mart().count() == 0


def test_an_unreadable_line_fails_the_load_but_not_the_other_pages(place, spark):
    place.land((DAY, 1, page([record(1)])))
    spark.createDataFrame([("{broken", DAY.date())], "value string, window_date date").write.mode("append").partitionBy(
        "window_date"
    ).text(place.landing)
    with pytest.raises(jobs.SourceError, match="unreadable_page"):
        place.run()
    assert place.keys() == [1]


def test_the_page_limit_fails_the_load_after_committing(place):
    place.land((DAY, 1, page([record(1)], {"c": 1})), (DAY, 2, page([record(2)], {"c": 2})), (DAY, 3, page([record(3)])))
    with pytest.raises(jobs.SourceError, match="page_limit in window .* page 3"):
        place.run(max_pages=2)
    assert place.keys() == [1, 2, 3]
    assert place.counters(place.run())["inserted"] == 0


def test_windows_are_guarded(place, spark):
    place.land((DAY, 1, page([record(1)])))
    with pytest.raises(ValueError, match="beyond_retention"):
        jobs.backfill(spark, place.landing, place.root, DAY.date(), DAY.date(), now=DAY + timedelta(days=31))
    assert jobs.backfill(spark, place.landing, place.root, DAY.date(), DAY.date(), now=DAY + timedelta(days=30)).first()["total_changes"] == 1
    swapped = json.dumps({"window_start": "2024-05-02T00:00:00Z", "window_end": "2024-05-01T00:00:00Z", "page": 1, "body": page([])})
    with pytest.raises(ValueError, match="invalid_order"):
        jobs.load_pages(place.warehouse, spark.createDataFrame([(swapped,)], "value string"))
    same = json.dumps({"window_start": "2024-05-01T00:00:00Z", "window_end": "2024-05-01T00:00:00Z", "page": 1, "body": page([record(9)])})
    stats = jobs.load_pages(place.warehouse, spark.createDataFrame([(same,)], "value string"))
    assert place.counters(stats)["inserted"] == 1


def test_a_failed_check_stops_the_run_and_a_rebuild_heals(place):
    place.land((DAY, 1, page([record(1), record(2, ns=1)])))
    place.run()
    healthy = place.mart()
    jobs.inject_fault(place.warehouse)
    with pytest.raises(QualityError, match="daily grain"):
        jobs.check(place.warehouse)
    failed = {r["check"] for r in jobs.check(place.warehouse, strict=False).filter("not passed").collect()}
    assert failed == {"daily grain"}
    jobs.refresh(place.warehouse)
    assert jobs.check(place.warehouse).filter("not passed").count() == 0
    assert place.mart() == healthy


def test_dirty_data_fails_the_gate_after_the_mart_is_built(place):
    place.land((DAY, 1, page([record(1, type="move"), record(2, ns="x")])))
    with pytest.raises(QualityError, match="accepted_values change_type .1."):
        place.run()
    assert place.warehouse.mart().count() == 2


def test_a_load_that_died_before_the_refresh_is_caught_up(place):
    place.land((DAY, 1, page([record(1)])))
    jobs.load_pages(place.warehouse, landing.read_lines(place.spark, place.landing))
    assert place.warehouse.mart().count() == 0
    place.run()
    assert [r[3] for r in place.mart()] == [1]


def test_rows_without_a_typed_key_keep_one_survivor_and_touch_no_other_day(place):
    place.land((DAY, 1, page([record(-1), record(1)])), (NEXT, 1, page([record(-2, day=NEXT), record(2, day=NEXT)])))
    place.run(DAY.date(), strict=False)
    place.run(NEXT.date(), strict=False)
    staged = place.warehouse.staging()
    assert sorted((r["change_id"], str(r["activity_date"])) for r in staged.collect() if r["change_id"]) == [
        (1, "2024-05-01"),
        (2, "2024-05-02"),
    ]
    assert [str(r["activity_date"]) for r in staged.collect() if r["change_id"] is None] == ["2024-05-02"]
    expected = daily_rollup(staging(place.warehouse.raw()))
    assert sorted((tuple(r) for r in expected.collect()), key=str) == place.mart()
    first_day = f"{place.root}/staging/activity_date=2024-05-01"
    before = sorted(os.listdir(first_day))
    third = NEXT + timedelta(days=1)
    place.land((third, 1, page([record(-3, day=third)])))
    place.run(third.date(), strict=False)
    assert sorted(os.listdir(first_day)) == before
    expected = daily_rollup(staging(place.warehouse.raw()))
    assert sorted((tuple(r) for r in expected.collect()), key=str) == place.mart()


def test_ids_never_repeat_over_loads(place):
    for n in range(3):
        day = DAY + timedelta(days=n)
        place.land((day, 1, page([record(10 * n + i, day=day) for i in range(5)])))
        jobs.load_pages(place.warehouse, landing.read_lines(place.spark, place.landing))
    raw = place.warehouse.raw()
    assert raw.count() == raw.select("_raw_id").distinct().count() == 15
    ordered = [r["_key"] for r in raw.orderBy("_raw_id").collect()]
    assert ordered == sorted(ordered)


def test_a_key_stored_on_another_day_is_found(place, spark):
    place.land((DAY, 1, page([record(1), record(50)])))
    place.run(DAY.date())
    place.land((NEXT, 1, page([record(50, day=NEXT), record(60, day=NEXT)])))
    assert place.counters(place.run(NEXT.date()))["inserted"] == 1
    assert place.keys() == [1, 50, 60]
    loads = place.warehouse.loads()
    assert jobs.days_of_keys(loads, [(1, 10)]) == [DAY.date()]
    assert jobs.days_of_keys(loads, [(55, 99), (1000, 1001)]) == [NEXT.date()]
    assert jobs.days_of_keys(loads, [(50, 50)]) == [DAY.date(), NEXT.date()]
    assert jobs.days_of_keys(loads, [(61, 99)]) == [] and jobs.days_of_keys(loads, []) == []
    assert jobs.joined_spans([(5, 9), (1, 3), (2, 4), (20, 21)]) == [(1, 4), (5, 9), (20, 21)]


def test_an_odd_key_widens_its_own_date_alone(place, spark):
    place.land((DAY, 1, page([record(1), record(10**15)])), (NEXT, 1, page([record(20, day=NEXT), record(30, day=NEXT)])))
    place.run()
    loads = place.warehouse.loads()
    assert jobs.days_of_keys(loads, [(500, 600)]) == [DAY.date()]
    assert jobs.days_of_keys(loads, [(25, 26)]) == [DAY.date(), NEXT.date()]


def test_two_loads_with_one_time_stamp_are_counted_apart(place, spark):
    place.land((DAY, 1, page([record(1), record(2)])))
    at = DAY + timedelta(days=2)
    got = [place.counters(jobs.load_pages(place.warehouse, landing.read_lines(spark, place.landing), ingested_at=at)) for _ in range(2)]
    assert [(g["fetched"], g["inserted"], g["duplicates"]) for g in got] == [(2, 2, 0), (2, 0, 2)]


def test_a_missing_page_or_window_fails_after_committing(place):
    place.land((DAY, 1, page([record(1)], {"c": 1})), (DAY, 3, page([record(3)])))
    with pytest.raises(jobs.SourceError, match="page_gap .* page 2"):
        place.run(DAY.date())
    assert place.keys() == [1, 3]
    place.land((DAY, 2, page([record(2)], {"c": 2})))
    with pytest.raises(jobs.SourceError, match="missing_window in window 2024-05-02"):
        place.run(DAY.date(), NEXT.date())
    assert place.keys() == [1, 2, 3]
    place.run(DAY.date())


def test_a_page_fetched_again_heals_the_load(place, spark):
    fetch = lambda n, hour, body: pages_frame(spark, [(DAY, n, body)]).withColumn("fetched_at", F.lit(DAY + timedelta(days=1, hours=hour)))
    for n, hour, body in ((1, 1, page([record(1)], {"c": 1})), (2, 1, page([record(7)], error={"code": "busy"}))):
        landing.write_pages(fetch(n, hour, body), place.landing)
    with pytest.raises(jobs.SourceError, match="source_error"):
        place.run()
    landing.write_pages(fetch(2, 2, page([record(2)])), place.landing)
    place.run()
    assert place.keys() == [1, 2]


def test_appends_refuse_rows_that_break_a_constraint(place, spark):
    place.land((DAY, 1, page([record(1)])))
    place.run()
    rows = place.warehouse.raw()
    for broken in (rows.withColumn("_raw", F.lit(None).cast("string")), rows.withColumn("_window_end", F.col("_window_start"))):
        with pytest.raises(Exception, match="row breaks a constraint"):
            place.warehouse.append_raw(broken)
    assert place.warehouse.raw().count() == 1


def test_a_load_leaves_no_scratch(place, spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        pytest.skip("scratch goes to fresh temporary folders")
    before = set(os.listdir(folder.removeprefix("file:")))
    place.land((DAY, 1, page([record(1)])))
    jobs.load_pages(place.warehouse, landing.read_lines(spark, place.landing))
    assert set(os.listdir(folder.removeprefix("file:"))) == before


def test_a_check_of_some_days_reads_no_payload(place, spark):
    place.land((DAY, 1, page([record(1)])), (NEXT, 1, page([record(2, day=NEXT), record(3, day=NEXT, type="move")])))
    place.run(strict=False)
    assert jobs.check(place.warehouse, days=[DAY.date()]).filter("not passed").count() == 0
    with pytest.raises(QualityError, match="accepted_values"):
        jobs.check(place.warehouse, days=[NEXT.date()])
    raw = place.warehouse.raw([DAY.date()])
    required = [c for c in quality.RAW_REQUIRED if c != "_raw"]
    assert "_raw:string" not in plan_of(quality.quality_report(raw, place.warehouse.staging([DAY.date()]), place.warehouse.mart([DAY.date()]), required))


def test_reading_some_days_prunes_the_others(place):
    place.land((DAY, 1, page([record(1)])), (NEXT, 1, page([record(2, day=NEXT)])))
    jobs.load_pages(place.warehouse, landing.read_lines(place.spark, place.landing))
    one_day = place.warehouse.raw([NEXT.date()])
    assert [r["_key"] for r in one_day.collect()] == [2]
    assert "_event_date" in plan_of(one_day).split("PartitionFilters: [")[1].split("]")[0]
    assert place.warehouse.raw([]).count() == 0
    assert place.warehouse.raw([date(2030, 1, 1)]).count() == 0
    everything = place.warehouse.raw([date(2020, 1, 1) + timedelta(days=n) for n in range(4000)])
    assert sorted(r["_key"] for r in everything.collect()) == [1, 2]


def test_a_third_of_all_records_under_one_key(place, spark):
    hot = [record(7, comment=str(i)) for i in range(400)] + [{"rcid": "bad"}] * 400 + [record(1000 + i) for i in range(400)]
    place.land((DAY, 1, page(hot)))
    got = place.counters(jobs.load_pages(place.warehouse, landing.read_lines(spark, place.landing)))
    assert got == {"fetched": 1200, "inserted": 401, "duplicates": 399, "quarantined": 1, "outside_window": 0, "pages": 1}
    assert json.loads(place.warehouse.raw().filter("_key = 7").first()["_raw"])["comment"] == "0"


def test_the_writer_offers_no_way_to_change_raw():
    public = {n for n in vars(Warehouse) if not n.startswith("_")}
    assert public == {
        "raw", "errors", "staging", "mart", "load_stats", "loads", "append_raw", "append_errors", "append_load_stats",
        "append_load", "append_mart", "replace_mart", "replace_staging", "publish", "bad_pages", "append_bad_pages", "untyped",
        "untyped_survivor", "replace_untyped", "drop_mart_days",
    }


def test_views_are_published_for_sql(place, spark):
    place.land((DAY, 1, page([record(1)])))
    place.run()
    place.warehouse.publish(staging(place.warehouse.raw()), "t_")
    assert spark.sql("select s.change_id, m.total_changes from t_stg_changes s join t_agg_changes_daily m on to_date(changed_at_utc) = activity_date").first() == (1, 1)
    assert spark.sql("select count(*) from t_raw_changes union all select count(*) from t_raw_changes_errors").count() == 2


def test_scratch_goes_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_dir(spark, "x")
    assert path.startswith(f"{shared.rstrip('/')}/x-" if shared else "/")
    assert path != shared_dir(spark, "x")
    assert materialize(spark.range(3), "numbers").inputFiles()


def test_the_fixture_splits_into_bounded_pages(spark, sf_dir):
    feed = fixture.deliveries(spark, sf_dir)
    sizes = feed.groupBy("_window_start", "page_no").count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] <= fixture.PAGE_SIZE and sizes[1] == 1100


def test_the_feed_moves_events_and_not_their_texts(spark, sf_dir):
    plan = plan_of(fixture.deliveries(spark, sf_dir))
    assert "concat_ws" in plan and "concat_ws" not in plan[plan.index("Exchange") :]


def test_an_error_is_fingerprinted_once(place, monkeypatch):
    plans, insert = {}, jobs.insert_if_absent

    def noting(incoming, existing, key, order):
        plans[key] = optimized(incoming)
        return insert(incoming, existing, key, order)

    monkeypatch.setattr(jobs, "insert_if_absent", noting)
    place.land((DAY, 1, page([record(1), record("x"), record("x"), record("y")])))
    assert place.counters(place.run())["quarantined"] == 2
    assert "Project" not in plans["_error_fingerprint"] and "Filter" not in plans["_error_fingerprint"]


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_the_undisturbed_feed_has_no_gap_at_any_scale(spark, scale):
    feed = fixture.deliveries(spark, f"/root/testdata/{scale}")
    pages = feed.select("_window_start", "_window_end", "page_no").distinct().withColumn("readable", F.lit(True))
    assert pages.agg(F.max("page_no")).first()[0] > 1
    assert gates.page_gaps(pages).count() == 0


def test_command_line(place, monkeypatch, capsys):
    place.land((DAY, 1, page([record(1)])))

    def call(*args):
        monkeypatch.setattr(sys, "argv", ["changeflow", "--warehouse", place.root, *args])
        main()
        return [json.loads(line) for line in capsys.readouterr().out.splitlines()]

    assert call("run", "--landing", place.landing, "--date", "2024-05-01")[0]["inserted"] == 1
    assert call("report", "daily_total_changes") == [{"activity_date": "2024-05-01", "total_changes": 1}]
    assert call("coverage")[0]["number_of_days"] == 1
    assert [r.get("raw_rows") for r in call("idempotency")] == [1, None]
    assert call("peek", "--rows", "1")[0]["namespace_name"] == "Bài viết"
    call("inject-fault")
    with pytest.raises(QualityError):
        call("check")
    call("refresh")
    assert all(r["passed"] for r in call("check"))
