"""Registered queries over events whose days make more pages than the default limit, as large tables do."""

import duckdb
import pytest

from changeflow.plans import registry
from changeflow.schemas import MAX_PAGES
from check_oracles import compare


@pytest.fixture(scope="module")
def long_dir(spark, tmp_path_factory):
    """A long window and eleven short ones: ids a page's length apart make one page per event, as pages are cut by id."""
    path = str(tmp_path_factory.mktemp("long"))
    spark.range(MAX_PAGES + 300).selectExpr(
        "id * 500 + 1 as event_id",
        "to_timestamp_ntz('2024-01-01 00:00:00') + make_dt_interval(if(id < 5200, 0, id % 11 + 1), 0, 0, id * 10) as ts",
        "id % 50 as user_id",
        "element_at(array('click', 'view', 'signup', 'purchase', 'error'), int(id % 5) + 1) as event_type",
        "double(id % 90) as value",
        "concat('{\"k\": ', id % 100, '}') as props",
    ).write.parquet(f"{path}/events.parquet")
    assert registry.feed(spark, path).agg({"page_no": "max"}).first()[0] > MAX_PAGES
    return path


@pytest.fixture(scope="module")
def events_db(long_dir):
    db = duckdb.connect()
    db.execute(f"create view events as select * from read_parquet('{long_dir}/events.parquet/*.parquet')")
    return db


@pytest.mark.parametrize("name", ["daily_run_report", "daily_run_stats", "backfill_resumed", "backfill_run"])
def test_windows_of_very_many_pages_are_loaded_whole(spark, events_db, long_dir, name):
    good, note = compare(spark, events_db, name, long_dir)
    assert good, note


def test_the_limit_is_the_default_where_no_window_is_longer(spark, sf_dir):
    assert registry.page_limit(spark, sf_dir) == MAX_PAGES
