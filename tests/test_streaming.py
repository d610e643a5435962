from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from changeflow.operators.rollup import daily_rollup
from changeflow.operators.staging import staging
from changeflow.plans import jobs
from changeflow.sources import landing
from changeflow.sources.tables import Warehouse
from changeflow.streaming import ingest

from .helpers import DAY, page, pages_frame, record

NEXT = DAY + timedelta(days=1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def batches():
    return [
        [(DAY, 1, page([record(1), record(2), {"rcid": "x"}])), (NEXT, 1, page([record(4, day=NEXT)]))],
        [
            (DAY, 2, page([record(2, comment="late copy"), record(3, hour=5), {"rcid": "x"}])),
            (NEXT, 2, page([record(1), record(5, day=NEXT, ns=3)])),
        ],
    ]


def test_micro_batches_store_what_one_batch_stores(spark, tmp_path):
    streamed, batch = Warehouse(spark, f"{tmp_path}/s"), Warehouse(spark, f"{tmp_path}/b")
    land = f"{tmp_path}/landing"
    for part in batches():
        landing.write_pages(pages_frame(spark, part), land)
        ingest.run_available(spark, land, streamed.root, f"{tmp_path}/checkpoint")
    jobs.load_pages(batch, landing.read_lines(spark, land))
    jobs.refresh(batch)
    columns = ["_key", "_raw", "_window_start", "_window_end"]
    assert rows(streamed.raw().select(columns)) == rows(batch.raw().select(columns))
    assert streamed.raw().count() == 5
    assert rows(streamed.mart()) == rows(batch.mart()) == rows(daily_rollup(staging(streamed.raw())))
    assert rows(streamed.errors().select("_error_fingerprint")) == rows(batch.errors().select("_error_fingerprint"))
    before = rows(streamed.raw())
    ingest.run_available(spark, land, streamed.root, f"{tmp_path}/lost-checkpoint")
    assert rows(streamed.raw()) == before


def test_several_micro_batches_in_one_run(spark, tmp_path):
    land, warehouse = f"{tmp_path}/landing", Warehouse(spark, f"{tmp_path}/w")
    landing.write_pages(pages_frame(spark, [p for part in batches() for p in part]).coalesce(1), land)
    ingest.run_available(spark, land, warehouse.root, f"{tmp_path}/checkpoint", maxFilesPerTrigger="1")
    assert sorted(r["_key"] for r in warehouse.raw().collect()) == [1, 2, 3, 4, 5]
    assert warehouse.loads().count() > 1


def test_bounded_state_keeps_one_record_per_key(spark, tmp_path):
    land = f"{tmp_path}/landing"
    for part in batches():
        landing.write_pages(pages_frame(spark, part), land)
    records = ingest.valid_stream(landing.stream_lines(spark, land))
    unique = ingest.first_within_retention(records).select("_key", "event_time")
    ingest.write_available(unique, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert sorted(r["_key"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3, 4, 5]


def test_daily_windows_are_kept_up_to_date(spark, tmp_path):
    land, warehouse = f"{tmp_path}/landing", Warehouse(spark, f"{tmp_path}/w")
    for part in batches():
        landing.write_pages(pages_frame(spark, part), land)
        ingest.run_available(spark, land, warehouse.root, f"{tmp_path}/checkpoint")
        ingest.maintain_daily_counts(spark, warehouse.root, f"{tmp_path}/counts", f"{tmp_path}/counts-checkpoint")
    got = spark.read.parquet(f"{tmp_path}/counts")
    columns = ["activity_date", "namespace_id", "total_changes", "bot_changes", "anonymous_changes"]
    assert rows(got.select(columns)) == rows(warehouse.mart().select(columns))
    assert got.agg(F.sum("total_changes")).first()[0] == 5


def test_bad_pages_do_not_stop_the_stream_and_are_settled_later(spark, tmp_path):
    land, warehouse = f"{tmp_path}/landing", Warehouse(spark, f"{tmp_path}/w")
    checkpoint = f"{tmp_path}/checkpoint"
    busy = page([record(8)], error={"code": "busy"})
    landing.write_pages(pages_frame(spark, [(DAY, 1, page([record(1)])), (DAY, 2, busy), (DAY, 3, page([record(3)]))]), land)
    spark.createDataFrame([("{broken", DAY.date())], "value string, window_date date").write.mode("append").partitionBy("window_date").text(land)
    ingest.run_available(spark, land, warehouse.root, checkpoint, max_pages=2)
    assert sorted(r["_key"] for r in warehouse.raw().collect()) == [1, 3]
    assert sorted((r["reason"], r["page_no"]) for r in warehouse.bad_pages().collect()) == [("source_error", 2), ("unreadable_page", None)]
    landing.write_pages(pages_frame(spark, [(DAY, 2, page([record(2)]))]), land)
    ingest.run_available(spark, land, warehouse.root, checkpoint, max_pages=2)
    assert sorted(r["_key"] for r in warehouse.raw().collect()) == [1, 2, 3]
    assert [r["reason"] for r in jobs.open_bad_pages(warehouse).collect()] == ["unreadable_page"]


def test_the_bounded_stream_leaves_bad_pages_to_their_own_stream(spark, tmp_path):
    land = f"{tmp_path}/landing"
    landing.write_pages(pages_frame(spark, [(DAY, 1, page([record(1)])), (DAY, 2, page([record(2)], error={"code": "busy"}))]), land)
    records = ingest.valid_stream(landing.stream_lines(spark, land)).select("_key")
    ingest.write_available(records, f"{tmp_path}/good", f"{tmp_path}/c1")
    ingest.write_available(ingest.bad_page_stream(landing.stream_lines(spark, land)), f"{tmp_path}/bad", f"{tmp_path}/c2")
    assert [r["_key"] for r in spark.read.parquet(f"{tmp_path}/good").collect()] == [1]
    assert [r["page_no"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()] == [2]


def spoil(folder):
    """Make every file below ``folder`` unreadable, and say how many there are."""
    found = [p for p in Path(folder).rglob("*.parquet") if not p.name.startswith(".")]
    for path in found:
        path.write_bytes(b"no parquet")
        for check in path.parent.glob(f".{path.name}.crc"):
            check.unlink()
    return len(found)


def test_a_batch_adds_to_its_days_without_opening_what_earlier_ones_staged(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/w")
    users = [record(n, user=f"u{n % 7}", bot=True) if n % 3 else record(n, user="") for n in range(1, 40)]
    for part in (users[:20], users[20:]):
        land = f"{tmp_path}/{part[0]['rcid']}"
        landing.write_pages(pages_frame(spark, [(DAY, part[0]["rcid"], page(part))]), land)
        jobs.load_pages(warehouse, landing.read_lines(spark, land), complete=False)
        jobs.advance(warehouse)
        whole = rows(daily_rollup(staging(warehouse.raw())))
        assert rows(warehouse.mart()) == whole and jobs.advance(warehouse) == []
        assert spoil(f"{tmp_path}/w/staging")
    before = rows(warehouse.mart())
    jobs.fold(warehouse, [DAY.date()], most_deltas=1)
    assert rows(jobs.mart_from_state(warehouse, [DAY.date()])) == before
    assert warehouse.state_log().count() == 3 and warehouse.user_numbers([DAY.date()]).count() == 7


def test_what_a_broken_step_left_is_added_once(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, f"{tmp_path}/w")
    untyped = record("+3", user="cat")
    landing.write_pages(pages_frame(spark, [(DAY, 1, page([record(1), record(2, user="bob"), untyped]))]), f"{tmp_path}/l")
    jobs.load_pages(warehouse, landing.read_lines(spark, f"{tmp_path}/l"), complete=False)
    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "append_state_log", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.advance(warehouse)
    assert jobs.advance(warehouse) == [DAY.date()]
    assert rows(warehouse.mart()) == rows(daily_rollup(staging(warehouse.raw())))
    assert warehouse.mart().first()["unique_users"] == 3 and warehouse.user_numbers([DAY.date()]).count() == 3
