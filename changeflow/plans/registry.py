"""Every operator as a named query over the given tables: ``QUERIES[name](spark, sf_dir)``.

The change feed is derived from ``events`` (see ``sources.fixture``) and stored once per session, as a landed feed
would be; each query then does its own work from the feed on, over all of it.
"""

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.payload import array_length, field, has_key, with_payload
from changeflow.operators import audits, digests, gates, inserts, key_filters, quality, reports, rollup, windows
from changeflow.operators import staging as stg
from changeflow.operators import validation as val
from changeflow.plans import jobs
from changeflow.schemas import CHANGE_TYPES, MAX_PAGES, RAW_COLUMNS
from changeflow.session import configure, materialize, shared_dir
from changeflow.sources import fixture, landing
from changeflow.sources.tables import Warehouse
from changeflow.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The feed is dated January 2024; the age check takes "now" as a parameter so that its result stays the same.
NOW = datetime(2024, 2, 10, 12, tzinfo=timezone.utc)
ARRIVAL = ["_raw_id"]

_feeds: dict[tuple[str, str], DataFrame] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


# ---- the feed and what the operators make of it ---------------------------------------------------


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _feeds:
        _feeds[key] = materialize(fixture.deliveries(spark, sf_dir), "feed")
    return _feeds[key]


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.classify(feed(spark, sf_dir))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.valid_records(judged(spark, sf_dir))


def inserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inserts.first_per_key(valid(spark, sf_dir), "_key", ARRIVAL)


def staged(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    return stg.staging(inserted(spark, sf_dir), columns)


def mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.daily_rollup(staged(spark, sf_dir, rollup.ROLLED))


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reports of totals need of the mart, from the three keys that it takes."""
    return rollup.event_counts(staged(spark, sf_dir, ["changed_at_utc", "namespace_id"]), "total_changes")


def mart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as a stored table, for queries that read it more than once."""
    return materialize(mart(spark, sf_dir), "mart")


def double_rates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in ("bot_rate", "anonymous_rate") if c in df.columns})


def land(spark: SparkSession, feed_part: DataFrame, path: str) -> str:
    landing.write_pages(fixture.pages(feed_part, faults=False), path)
    return path


def page_limit(spark: SparkSession, sf_dir: str) -> int:
    """Pages that a run over the feed may fetch of a window: the default, or as many as its longest window was cut into.

    The feed lands whole, and its windows get more pages as ``events`` grows; a page beyond them still fails the run.
    """
    longest = feed(spark, sf_dir).agg(F.max("page_no")).first()[0]
    return max(MAX_PAGES, longest or 0)


def landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixture.pages(feed(spark, sf_dir)).select(landing.landed_line(F.col("body")).alias("value"))
    return landing.parse_pages(lines)


# ---- sources --------------------------------------------------------------------------------------


@query
def deliveries_raw(spark, sf_dir):
    return feed(spark, sf_dir).select(RAW_COLUMNS)


@query
def envelope_records(spark, sf_dir):
    return landing.only_records(landing.page_records(landed_rows(spark, sf_dir)))


@query
def envelope_pages(spark, sf_dir):
    rows = landing.page_records(landed_rows(spark, sf_dir))
    return landing.page_headers(rows).select("_window_start", "page_no", "readable", "has_error", "has_more")


@query
def envelope_errors(spark, sf_dir):
    return gates.page_errors(landed_rows(spark, sf_dir)).select("_window_start", "page_no", "reason", "detail")


@query
def incomplete_windows(spark, sf_dir):
    return gates.incomplete_windows(landed_rows(spark, sf_dir))


@query
def admitted_records(spark, sf_dir):
    rows = materialize(landing.page_records(landed_rows(spark, sf_dir)), "rows")
    admitted = gates.admit(rows, landing.page_headers(rows))
    return landing.only_records(admitted).select("_window_start", "page_no", "pos", "_raw")


def _disturbed_headers(spark, sf_dir):
    """Headers of the newest landings of a bad run."""
    lines = fixture.disturbed_lines(feed(spark, sf_dir))
    headers = landing.page_headers(materialize(landing.page_records(landing.parse_pages(lines)), "rows"))
    return landing.newest_landings(headers, headers)


@query
def refetched_pages(spark, sf_dir):
    """Pages as they count when those fetched again replace their error copies, and stale error copies do not."""
    counted = _disturbed_headers(spark, sf_dir).filter("readable")
    return counted.select("_window_start", "page_no", "fetched_at", "has_error")


@query
def page_gaps(spark, sf_dir):
    return gates.page_gaps(_disturbed_headers(spark, sf_dir)).select("_window_start", "first_missing", "last_missing")


@query
def missing_windows(spark, sf_dir):
    asked = windows.covering_windows(fixture.table(spark, sf_dir, "events"), "ts")
    return gates.missing_windows(asked, _disturbed_headers(spark, sf_dir)).select("_window_start")


@query
def landing_violations(spark, sf_dir):
    """Everything wrong with the bad run, with a limit of one page per window."""
    asked = windows.covering_windows(fixture.table(spark, sf_dir, "events"), "ts")
    found = gates.violations(_disturbed_headers(spark, sf_dir), 1, asked)
    return found.groupBy("reason").agg(F.count("*").alias("violations"))


def _asked_windows(spark, sf_dir):
    """The feed's windows, some of them with equal or swapped bounds."""
    day = F.dayofmonth("_window_start")
    end = (
        F.when(day % 5 == 0, F.col("_window_start"))
        .when(day % 6 == 0, F.col("_window_start") - F.expr("interval 1 day"))
        .otherwise(F.col("_window_end"))
    )
    asked = feed(spark, sf_dir).select("_window_start", "_window_end").distinct()
    return asked.withColumn("_window_end", end)


@query
def window_guard(spark, sf_dir):
    return windows.guard_windows(_asked_windows(spark, sf_dir), NOW)


@query
def source_request(spark, sf_dir):
    return landing.source_request(windows.normalize_windows(_asked_windows(spark, sf_dir)))


@query
def source_predicate(spark, sf_dir):
    start, end = datetime(2024, 1, 10, tzinfo=timezone.utc), datetime(2024, 1, 20, tzinfo=timezone.utc)
    typed = stg.type_records(feed(spark, sf_dir), ["change_id", "change_type", "changed_at_utc"])
    asked = windows.source_predicate(typed, "changed_at_utc", "change_type", start, end, CHANGE_TYPES[:3])
    return asked.select("_raw_id", "change_id", "change_type", "changed_at_utc")


# ---- validation and load --------------------------------------------------------------------------


@query
def record_status(spark, sf_dir):
    return judged(spark, sf_dir).select("_raw_id", "_key", "event_time", "status", "error_type", "error_message")


@query
def quarantine(spark, sf_dir):
    errors = inserts.first_per_key(val.error_rows(judged(spark, sf_dir)), "_error_fingerprint", ARRIVAL)
    return errors.select(
        "_error_fingerprint", "_raw", "_error_type", "_error_message", "_window_start", "_window_end", "_ingested_at"
    )


@query
def quarantine_increment(spark, sf_dir):
    """Errors that a load of the whole feed adds to a quarantine filled by the feed's originals."""
    errors = materialize(val.error_rows(judged(spark, sf_dir)), "errors")
    known = inserts.first_per_key(errors.filter("replay = 0"), "_error_fingerprint", ARRIVAL)
    return inserts.insert_if_absent(errors, known, "_error_fingerprint", ARRIVAL).select("_error_fingerprint", "_raw_id")


@query
def raw_insert(spark, sf_dir):
    return inserted(spark, sf_dir).select(RAW_COLUMNS)


@query
def raw_insert_increment(spark, sf_dir):
    """Rows that a load of the whole feed adds to a raw table holding the first fifteen days."""
    rows = materialize(valid(spark, sf_dir), "valid")
    early = rows.filter(F.col("_window_start") < F.lit(date(2024, 1, 16)).cast("timestamp"))
    known = inserts.first_per_key(early, "_key", ARRIVAL)
    return inserts.insert_if_absent(rows, known, "_key", ARRIVAL).select("_key", *RAW_COLUMNS)


def _filtered(spark, sf_dir):
    """The feed's rows under keys that are spread over the whole range, and the filters of those of the first fifteen days."""
    spread = F.pmod(F.col("_key") * 48271, F.lit(2147483647)).alias("_key")
    rows = valid(spark, sf_dir).select(spread, *ARRIVAL, "_window_start", F.to_date("event_time").alias("event_date"))
    rows = materialize(rows, "spread")
    known = inserts.first_per_key(rows.filter(F.col("_window_start") < F.lit(date(2024, 1, 16)).cast("timestamp")), "_key", ARRIVAL)
    known = materialize(known, "known")
    sizes = known.groupBy("event_date").agg(F.count("_key").alias("keys"))
    filters = materialize(key_filters.key_filters(known, sizes, "_key"), "filters")
    levels = [r["level"] for r in filters.select("level").distinct().collect()] or [0]
    return rows, known, key_filters.possible_days(rows, filters, "_key", levels)


@query
def raw_insert_filtered(spark, sf_dir):
    """Rows that a load of the whole feed adds where keys of all days lie between one another: of the history only the rows
    under a key and day that pass the filters are compared."""
    rows, known, possible = _filtered(spark, sf_dir)
    return inserts.insert_if_absent(rows, known.join(possible, ["_key", "event_date"], "left_semi"), "_key", ARRIVAL)


@query
def key_filter_audit(spark, sf_dir):
    """Per stored day its keys, those that its filter denies (none), and whether it lets through less than one in fifty of
    the keys that it does not hold."""
    rows, known, possible = _filtered(spark, sf_dir)
    asked = rows.agg(F.count_distinct("_key")).first()[0]
    marked = known.select("_key", "event_date", F.lit(1).alias("held")).join(
        possible.withColumn("passed", F.lit(1)), ["_key", "event_date"], "full_outer"
    )
    days = marked.groupBy("event_date").agg(
        F.count("held").alias("stored_keys"),
        F.count_if(F.col("passed").isNull()).alias("denied"),
        F.count_if(F.col("held").isNull()).alias("false"),
    )
    few = F.col("false") * 50 < asked - F.col("stored_keys")
    return days.select("event_date", "stored_keys", "denied", few.alias("few_false"))


@query
def constraint_violations(spark, sf_dir):
    return inserts.constraint_violations(fixture.damaged_raw(feed(spark, sf_dir)))


def _page_stats(spark, sf_dir):
    rows = materialize(judged(spark, sf_dir), "judged")
    new = inserts.first_per_key(val.valid_records(rows), "_key", ARRIVAL)
    bad = inserts.first_per_key(val.error_rows(rows), "_error_fingerprint", ARRIVAL)
    return inserts.load_stats(rows, new, bad)


@query
def load_stats_page(spark, sf_dir):
    return _page_stats(spark, sf_dir)


@query
def load_stats_window(spark, sf_dir):
    return inserts.total_stats(_page_stats(spark, sf_dir), ["_window_start"])


@query
def load_stats_total(spark, sf_dir):
    return inserts.total_stats(_page_stats(spark, sf_dir))


# ---- staging --------------------------------------------------------------------------------------


@query
def stg_events(spark, sf_dir):
    return staged(spark, sf_dir)


@query
def stg_latest_wins(spark, sf_dir):
    return stg.staging(feed(spark, sf_dir))


@query
def stg_untyped_keys(spark, sf_dir):
    """Stored staging of a feed with keys that staging does not type: one such row stays, the newest."""
    root = shared_dir(spark, "run")
    lines = landing.read_lines(spark, land(spark, fixture.untyped_keys(feed(spark, sf_dir)), f"{root}/landing"))
    warehouse = Warehouse(spark, f"{root}/warehouse")
    jobs.refresh(warehouse, jobs.loaded_days(jobs.load_pages(warehouse, lines, page_limit(spark, sf_dir))))
    untyped = F.col("change_id").isNull().alias("untyped")
    return warehouse.staging().groupBy(untyped).agg(F.count("*").alias("records"), F.max("changed_at_utc").alias("newest"))


@query
def json_flags(spark, sf_dir):
    keys = ["bot", "minor", "anon", "redirect", "userhidden"]
    parsed = with_payload(feed(spark, sf_dir), "_raw", variants=keys)
    return parsed.select("_raw_id", *[has_key(field(k)).alias(f"has_{k}") for k in keys])


@query
def tag_counts(spark, sf_dir):
    parsed = with_payload(feed(spark, sf_dir), "_raw", variants=["tags"])
    return parsed.groupBy(array_length(field("tags")).alias("tag_count")).agg(F.count("*").alias("records"))


# ---- mart and reports -----------------------------------------------------------------------------


@query
def mart_daily(spark, sf_dir):
    return double_rates(mart(spark, sf_dir))


@query
def daily_total_changes(spark, sf_dir):
    return reports.daily_total_changes(daily_counts(spark, sf_dir))


@query
def daily_rates(spark, sf_dir):
    return double_rates(reports.daily_rates(mart(spark, sf_dir)))


@query
def namespace_totals(spark, sf_dir):
    return reports.namespace_totals(mart(spark, sf_dir))


@query
def top_namespaces(spark, sf_dir):
    return reports.top_namespaces(mart(spark, sf_dir))


@query
def distinct_users_daily(spark, sf_dir):
    """Distinct users of each day and, without a date, of all days: whether sketches added up come within a twentieth of
    the exact count, which is taken here for comparison."""
    rows = materialize(staged(spark, sf_dir, rollup.ROLLED), "staged")
    spans = F.explode(F.array("activity_date", F.lit(None).cast("date"))).alias("activity_date")
    sketches = rollup.user_sketches(rows).select(spans, "users")
    named = rows.filter("not is_user_missing").select(F.to_date("changed_at_utc").alias("activity_date"), "user_name")
    exact = named.select(spans, "user_name").groupBy("activity_date").agg(F.count_distinct("user_name").alias("unique_users"))
    found = rollup.distinct_users(sketches, "activity_date").withColumnRenamed("activity_date", "sketched_date")
    close = F.abs(F.col("distinct_users") - F.col("unique_users")) * 20 <= F.col("unique_users")
    both = found.join(exact, F.col("sketched_date").eqNullSafe(F.col("activity_date")))
    return both.select("activity_date", "unique_users", close.alias("close"))


@query
def latest_day_kpis(spark, sf_dir):
    return double_rates(reports.latest_day_kpis(mart_table(spark, sf_dir)))


@query
def latest_day(spark, sf_dir):
    return reports.latest_day(mart(spark, sf_dir))


@query
def staging_counts(spark, sf_dir):
    return rollup.event_counts(staged(spark, sf_dir, ["changed_at_utc", "namespace_id"]))


@query
def change_types_daily(spark, sf_dir):
    return reports.change_types_daily(mart(spark, sf_dir))


@query
def change_types_long(spark, sf_dir):
    return reports.change_types_long(mart(spark, sf_dir))


@query
def mart_peek(spark, sf_dir):
    return double_rates(reports.peek(mart(spark, sf_dir), 20, rollup.GRAIN))


@query
def staging_peek(spark, sf_dir):
    return reports.peek(staged(spark, sf_dir), 5, ["change_id"])


# ---- data quality ---------------------------------------------------------------------------------


@query
def dq_not_null_raw(spark, sf_dir):
    return quality.null_counts(fixture.damaged_raw(feed(spark, sf_dir)), quality.RAW_REQUIRED)


@query
def dq_not_null_staging(spark, sf_dir):
    typed = stg.type_records(feed(spark, sf_dir), quality.STAGING_REQUIRED)
    return quality.not_null(typed, quality.STAGING_REQUIRED, ["_raw_id"])


@query
def dq_not_null_mart(spark, sf_dir):
    return quality.not_null(mart(spark, sf_dir), quality.MART_REQUIRED, rollup.GRAIN)


@query
def dq_unique_change_id(spark, sf_dir):
    return quality.unique(stg.type_records(feed(spark, sf_dir), ["change_id"]), "change_id")


@query
def dq_accepted_types(spark, sf_dir):
    return quality.accepted_values(fixture.table(spark, sf_dir, "events"), "event_type", ["click", "view", "signup"])


@query
def dq_daily_grain(spark, sf_dir):
    return quality.grain(audits.inject_duplicate(mart_table(spark, sf_dir)), rollup.GRAIN)


@query
def dq_inside_window(spark, sf_dir):
    return quality.inside_window(stg.type_records(feed(spark, sf_dir), ["change_id", "changed_at_utc"]), ["_raw_id", "change_id"])


@query
def dq_metric_ranges(spark, sf_dir):
    return double_rates(quality.ranges(fixture.damaged_mart(mart(spark, sf_dir))))


@query
def dq_reconciliation(spark, sf_dir):
    stored = materialize(staged(spark, sf_dir), "staging")
    return quality.staging_mart_reconciliation(stored, rollup.daily_rollup(stored))


@query
def dq_report(spark, sf_dir):
    raw = materialize(inserted(spark, sf_dir), "raw")
    stored = materialize(stg.staging(raw), "staging")
    return quality.quality_report(raw, stored, materialize(rollup.daily_rollup(stored), "mart"))


@query
def dq_orders_unique_customer(spark, sf_dir):
    return quality.unique(fixture.table(spark, sf_dir, "orders"), "o_custkey")


@query
def dq_orders_accepted_priority(spark, sf_dir):
    urgent = ["1-URGENT", "2-HIGH"]
    return quality.accepted_values(fixture.table(spark, sf_dir, "orders"), "o_orderpriority", urgent)


@query
def dq_lineitem_grain(spark, sf_dir):
    return quality.grain(fixture.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_lineitem_ranges(spark, sf_dir):
    items = fixture.table(spark, sf_dir, "lineitem").withColumn("net_units", F.col("l_quantity") - 10)
    return quality.ranges(items, ["net_units", "l_extendedprice"], ["l_discount", "l_tax"]).select(
        "l_orderkey", "l_linenumber", "net_units"
    )


@query
def dq_orders_reconciliation(spark, sf_dir):
    """Orders whose line count differs from one, and orders or lines without the other."""
    lines = fixture.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_key"))
    orders = fixture.table(spark, sf_dir, "orders").groupBy(F.col("o_orderkey").alias("order_key"))
    return quality.reconcile(
        lines.agg(F.count("*").alias("line_count")),
        orders.agg(F.count("*").alias("order_count")),
        ["order_key"],
        "line_count",
        "order_count",
    )


@query
def dq_document_nulls(spark, sf_dir):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    return quality.null_counts(fixture.table(spark, sf_dir, "documents"), columns)


# ---- operational jobs -----------------------------------------------------------------------------


@query
def backfill_windows(spark, sf_dir):
    return windows.covering_windows(fixture.table(spark, sf_dir, "events"), "ts")


@query
def assigned_windows(spark, sf_dir):
    events = fixture.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return windows.assign_daily(events, "ts").select("event_id", "_window_start", "_window_end")


@query
def assigned_general_windows(spark, sf_dir):
    """Events per 36-hour window, one of which starts every day, so they overlap."""
    events = fixture.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    long_windows = windows.covering_windows(events, "ts").withColumn(
        "_window_end", F.col("_window_start") + F.expr("interval 36 hours")
    )
    return (
        windows.assign_windows(events, long_windows, "ts")
        .groupBy("_window_start", "_window_end")
        .agg(F.count("*").alias("events"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))
    )


@query
def assigned_mixed_windows(spark, sf_dir):
    """Events per window, of one minute, 36 hours and a year, that start on every day; a year holds all later days."""
    events = fixture.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    lengths = F.explode(F.array(*[F.expr(f"interval {n} minutes") for n in (1, 2160, 525600)]))
    mixed = windows.covering_windows(events, "ts").select("_window_start", lengths.alias("length"))
    mixed = mixed.select("_window_start", (F.col("_window_start") + F.col("length")).alias("_window_end"))
    return (
        windows.assign_windows_by_cells(events, mixed, "ts")
        .groupBy("_window_start", "_window_end")
        .agg(F.count("*").alias("events"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))
    )


@query
def backfill_coverage(spark, sf_dir):
    return audits.backfill_coverage(mart(spark, sf_dir))


@query
def missing_days(spark, sf_dir):
    """Days planned up to one week after the last event that the mart does not hold."""
    planned = windows.covering_windows(
        fixture.table(spark, sf_dir, "events").select(F.explode(F.array("ts", F.col("ts") + F.expr("interval 7 days"))).alias("ts")),
        "ts",
    )
    return audits.missing_days(planned, mart(spark, sf_dir)).select("activity_date", "_window_start", "_window_end")


@query
def idempotency_windows(spark, sf_dir):
    return audits.window_loads(inserted(spark, sf_dir))


@query
def idempotency_days(spark, sf_dir):
    return audits.day_totals(mart(spark, sf_dir))


@query
def replay_diff(spark, sf_dir):
    """Raw rows per window and mart totals per day, before and after the whole feed is loaded again."""
    rows = materialize(valid(spark, sf_dir), "valid")
    before = materialize(inserts.first_per_key(rows, "_key", ARRIVAL), "before")
    again = inserts.insert_if_absent(rows, before, "_key", ARRIVAL)
    after = materialize(before.unionByName(again), "after")

    def totals(raw: DataFrame) -> DataFrame:
        return audits.day_totals(rollup.daily_rollup(stg.staging(raw))).withColumnRenamed("activity_date", "day")

    def loads(raw: DataFrame) -> DataFrame:
        return audits.window_loads(raw).withColumn("day", F.to_date("_window_start"))

    raw_diff = audits.compare_runs(loads(before), loads(after), ["day"], ["raw_rows"])
    mart_diff = audits.compare_runs(totals(before), totals(after), ["day"], ["mart_total_changes"])
    return raw_diff.select("day", "raw_rows_before", "raw_rows_after", F.col("unchanged").alias("raw_unchanged")).join(
        mart_diff.select(
            "day", "mart_total_changes_before", "mart_total_changes_after", F.col("unchanged").alias("mart_unchanged")
        ),
        "day",
        "full_outer",
    )


@query
def append_only_audit(spark, sf_dir):
    before = materialize(inserted(spark, sf_dir).select(RAW_COLUMNS), "before")
    return audits.append_only_audit(before, fixture.mutated_raw(before), "_raw_id")


@query
def snapshot_drilldown(spark, sf_dir):
    """Rows changed or lost between two stored snapshots, found by digests per day first."""
    root = shared_dir(spark, "snapshots")
    dated = inserted(spark, sf_dir).select(*RAW_COLUMNS, F.to_date("event_time").alias("_event_date"))
    dated.write.partitionBy("_event_date").parquet(f"{root}/before")
    before = spark.read.parquet(f"{root}/before")
    fixture.mutated_days(before).write.partitionBy("_event_date").parquet(f"{root}/after")
    return digests.snapshot_drilldown(before, spark.read.parquet(f"{root}/after"), "_raw_id", "_event_date")


@query
def day_digests(spark, sf_dir):
    """Rows per day from digests of single windows, added up; equal to those taken of whole days."""
    rows = inserted(spark, sf_dir).select(*RAW_COLUMNS, F.to_date("event_time").alias("_event_date"))
    parts = digests.added(digests.digests(rows, ["_event_date", "_window_start"], RAW_COLUMNS), ["_event_date"])
    whole = digests.digests(rows, ["_event_date"], RAW_COLUMNS)
    return audits.compare_runs(parts, whole, ["_event_date"], digests.DIGEST).select("_event_date", "digest_rows_before", "unchanged")


@query
def vanished_rows(spark, sf_dir):
    before = materialize(inserted(spark, sf_dir).select("_raw_id", "_raw"), "before")
    return audits.vanished_rows(before, fixture.mutated_raw(before))


@query
def daily_run(spark, sf_dir):
    """Landed pages through load and refresh as stored tables; the mart read back."""
    root = shared_dir(spark, "run")
    lines = landing.read_lines(spark, land(spark, feed(spark, sf_dir), f"{root}/landing"))
    warehouse = Warehouse(spark, f"{root}/warehouse")
    jobs.load_pages(warehouse, lines, page_limit(spark, sf_dir))
    jobs.refresh(warehouse)
    return double_rates(warehouse.mart())


@query
def daily_run_report(spark, sf_dir):
    """Two loads, the second one of the whole feed again, then the quality report over the stored tables."""
    root = shared_dir(spark, "run")
    lines = landing.read_lines(spark, land(spark, feed(spark, sf_dir), f"{root}/landing"))
    warehouse = Warehouse(spark, f"{root}/warehouse")
    limit = page_limit(spark, sf_dir)
    jobs.load_pages(warehouse, lines, limit)
    jobs.load_pages(warehouse, lines, limit)
    jobs.refresh(warehouse)
    return jobs.check(warehouse, strict=False)


@query
def daily_run_stats(spark, sf_dir):
    """Counters of a first load of the originals and of a second load of everything."""
    root = shared_dir(spark, "run")
    whole = feed(spark, sf_dir)
    first = land(spark, whole.filter("replay = 0"), f"{root}/first")
    second = land(spark, whole, f"{root}/second")
    warehouse, limit = Warehouse(spark, f"{root}/warehouse"), page_limit(spark, sf_dir)
    totals = [
        inserts.total_stats(jobs.load_pages(warehouse, landing.read_lines(spark, path), limit)).withColumn("load", F.lit(n))
        for n, path in enumerate((first, second), 1)
    ]
    return totals[0].unionByName(totals[1])


def _event_span(spark, sf_dir) -> tuple[date, date]:
    """First and last date of the events."""
    planned = windows.covering_windows(fixture.table(spark, sf_dir, "events"), "ts")
    span = planned.agg(F.min(F.to_date("_window_start")), F.max(F.to_date("_window_start"))).first()
    return span[0], span[1]


@query
def dq_report_days(spark, sf_dir):
    """A backfill of the whole feed, then the report over ten of its days, from the fifth one on."""
    root = shared_dir(spark, "run")
    place = (spark, land(spark, feed(spark, sf_dir), f"{root}/landing"), f"{root}/warehouse")
    first, last = _event_span(spark, sf_dir)
    jobs.backfill(*place, first, last, retention_days=None, max_pages=page_limit(spark, sf_dir), strict=False)
    return jobs.check(Warehouse(spark, f"{root}/warehouse"), False, jobs.days_between(first + timedelta(days=4), first + timedelta(days=13)))


@query
def backfill_run(spark, sf_dir):
    """All landed days in one run with its checks, done twice; the mart's coverage, which the second one leaves as it is."""
    root = shared_dir(spark, "run")
    place = (spark, land(spark, feed(spark, sf_dir), f"{root}/landing"), f"{root}/warehouse")
    (first, last), limit = _event_span(spark, sf_dir), page_limit(spark, sf_dir)
    for _ in range(2):
        coverage = jobs.backfill(*place, first, last, retention_days=None, max_pages=limit, strict=False)
    return coverage


@query
def backfill_resumed(spark, sf_dir):
    """A backfill that breaks off after ten days, as the others have not landed, and goes on when they have: changes per
    day, how many steps are noted for it, and how many loads brought it."""
    root, whole = shared_dir(spark, "run"), feed(spark, sf_dir)
    place, warehouse = (spark, f"{root}/landing", f"{root}/warehouse"), Warehouse(spark, f"{root}/warehouse")
    (first, last), limit = _event_span(spark, sf_dir), page_limit(spark, sf_dir)
    early = F.to_date("_window_start") < F.lit(first + timedelta(days=10))
    for part in (early, ~early):
        land(spark, whole.filter(part), f"{root}/landing")
        try:
            jobs.resume_backfill(*place, first, last, retention_days=None, pass_days=10, max_pages=limit, strict=False)
        except jobs.SourceError as error:
            if "missing_window" not in str(error):
                raise
    by_day = lambda df, day, name, what: df.groupBy(F.col(day).alias("activity_date")).agg(what.alias(name))
    steps = by_day(warehouse.backfill_steps(), "window_date", "steps", F.count("*"))
    loads = by_day(warehouse.loads(), "event_date", "loads", F.countDistinct("_load_id"))
    changes = by_day(warehouse.mart(), "activity_date", "total_changes", F.sum("total_changes"))
    return changes.join(steps, "activity_date", "left").join(loads, "activity_date", "left")


@query
def published_views(spark, sf_dir):
    """SQL over the published views, as a dashboard or an analyst writes it."""
    root = shared_dir(spark, "run")
    lines = landing.read_lines(spark, land(spark, feed(spark, sf_dir), f"{root}/landing"))
    warehouse = Warehouse(spark, f"{root}/warehouse")
    jobs.load_pages(warehouse, lines, page_limit(spark, sf_dir))
    jobs.refresh(warehouse)
    warehouse.publish(stg.staging(warehouse.raw()))
    return spark.sql(
        """
        select m.activity_date, m.namespace_id, m.total_changes, count(s.change_id) as staged,
            count(distinct s.page_title) as pages
        from agg_changes_daily m
        join stg_changes s on to_date(s.changed_at_utc) = m.activity_date and s.namespace_id = m.namespace_id
        group by m.activity_date, m.namespace_id, m.total_changes
        """
    )


# ---- streaming ------------------------------------------------------------------------------------


def _streamed(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The originals landed and streamed, then the replays landed and streamed by a restarted query."""
    root = shared_dir(spark, "stream")
    whole = feed(spark, sf_dir)
    for replay in (0, 1):
        land(spark, whole.filter(F.col("replay") == replay), f"{root}/landing")
        ingest.run_available(spark, f"{root}/landing", f"{root}/warehouse", f"{root}/checkpoint")
    return Warehouse(spark, f"{root}/warehouse")


@query
def stream_ingest(spark, sf_dir):
    return _streamed(spark, sf_dir).raw().select("_key", "_raw", "_window_start", "_window_end")


@query
def stream_mart(spark, sf_dir):
    return double_rates(_streamed(spark, sf_dir).mart())


@query
def stream_dedup(spark, sf_dir):
    root = shared_dir(spark, "dedup")
    land(spark, feed(spark, sf_dir), f"{root}/landing")
    records = ingest.valid_stream(landing.stream_lines(spark, f"{root}/landing"))
    unique = ingest.first_within_retention(records).select("_key", "event_time", "_window_start")
    ingest.write_available(unique, f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(unique.schema).parquet(f"{root}/out")


@query
def stream_bad_pages(spark, sf_dir):
    """A bad run streamed in: what went to ``bad_pages``; the load went on past them."""
    root = shared_dir(spark, "bad")
    fixture.disturbed_lines(feed(spark, sf_dir)).withColumn("window_date", F.lit(date(2024, 1, 1))).write.partitionBy(
        "window_date"
    ).text(f"{root}/landing")
    ingest.run_available(spark, f"{root}/landing", f"{root}/warehouse", f"{root}/checkpoint")
    return Warehouse(spark, f"{root}/warehouse").bad_pages().select("_window_start", "page_no", "reason", "detail")


@query
def stream_page_ledger(spark, sf_dir):
    """A bad run streamed in by several micro-batches: what its windows lack over all of them, by the ledger."""
    root = shared_dir(spark, "ledger")
    fixture.disturbed_lines(feed(spark, sf_dir)).withColumn("window_date", F.lit(date(2024, 1, 1))).repartition(3).write.partitionBy(
        "window_date"
    ).text(f"{root}/landing")
    ingest.run_available(spark, f"{root}/landing", f"{root}/warehouse", f"{root}/checkpoint", maxFilesPerTrigger="1")
    asked = windows.covering_windows(fixture.table(spark, sf_dir, "events"), "ts")
    return jobs.open_windows(Warehouse(spark, f"{root}/warehouse"), asked, 1).select("_window_start", "reason", "page_no")


@query
def stream_daily_counts(spark, sf_dir):
    root = shared_dir(spark, "counts")
    lines = landing.read_lines(spark, land(spark, feed(spark, sf_dir), f"{root}/landing"))
    jobs.load_pages(Warehouse(spark, f"{root}/warehouse"), lines, page_limit(spark, sf_dir))
    ingest.maintain_daily_counts(spark, f"{root}/warehouse", f"{root}/counts", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/counts")
