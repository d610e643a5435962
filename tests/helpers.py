"""Small literal tables for the tests."""

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

DAY = datetime(2024, 5, 1, tzinfo=timezone.utc)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def record(rcid=1, hour=1, day=DAY, **more):
    stamp = (day + timedelta(hours=hour)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return {"rcid": rcid, "type": "edit", "ns": 0, "title": "T", "user": "ann", "timestamp": stamp} | more


def raw_table(spark, payloads, window_start=DAY, ingested_at=None):
    """Raw rows, ids in list order; payloads may be dicts or JSON texts, or (payload, ingested_at) pairs."""
    rows = []
    for i, item in enumerate(payloads, 1):
        payload, at = item if isinstance(item, tuple) else (item, ingested_at or window_start + timedelta(days=1))
        text = payload if isinstance(payload, str) or payload is None else json.dumps(payload, ensure_ascii=False)
        rows.append((i, text, window_start, window_start + timedelta(days=1), at))
    schema = "_raw_id long, _raw string, _window_start timestamp, _window_end timestamp, _ingested_at timestamp"
    return spark.createDataFrame(rows, schema)


def pages_frame(spark, pages):
    """(window start, page number, body) triples as pages of daily windows."""
    rows = [(start, start + timedelta(days=1), n, body if isinstance(body, str) else json.dumps(body)) for start, n, body in pages]
    return spark.createDataFrame(rows, "_window_start timestamp, _window_end timestamp, page_no long, body string")


def page(records, more=None, error=None):
    body = {"query": {"recentchanges": records}}
    if more is not None:
        body["continue"] = more
    if error is not None:
        body["error"] = error
    return body


def one(spark, column_builder, *values, schema="string"):
    """Apply a column function to literal values."""
    df = spark.createDataFrame([(v,) for v in values], f"x {schema}")
    return [r[0] for r in df.select(column_builder(F.col("x"))).collect()]
