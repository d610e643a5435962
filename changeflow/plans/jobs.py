"""The jobs of a warehouse: load landed pages, refresh staging and mart, check, or all in that order."""

import uuid
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators import daily_state as state
from changeflow.operators import progress
from changeflow.operators.audits import backfill_coverage
from changeflow.operators.gates import admit, good_pages, page_errors, violations
from changeflow.operators.inserts import id_span, in_ranges, insert_if_absent, load_stats, number_rows, total_stats
from changeflow.operators.key_filters import key_filters, passed_days, possible_days, some_keys
from changeflow.operators.page_ledger import ledger_violations, merged_intervals, page_intervals
from changeflow.operators.quality import RAW_REQUIRED, quality_report, require_quality
from changeflow.operators.reports import peek
from changeflow.operators.rollup import GRAIN, daily_rollup
from changeflow.operators.staging import staging_of_unique
from changeflow.operators.validation import ERROR, OK, classify, error_rows, valid_records
from changeflow.operators.windows import daily_windows, guard_windows, normalize_windows, windows_between
from changeflow.schemas import BACKFILL_STEPS, MAX_PAGES, RETENTION_DAYS, STATE_LOG
from changeflow.session import configure, discard, materialize
from changeflow.sources.landing import landed_files, newest_landings, only_records, page_headers, page_records, parse_pages, read_lines
from changeflow.sources.tables import Warehouse

PAGE = ["_window_start", "_window_end", "page_no"]
# the row number keeps two equal landings of one page apart
ARRIVAL = [*PAGE, "pos", "row"]
# Additions to a day that are kept apart before they are made one.
MOST_DELTAS = 64
# Keys that ask all days' filters before all keys do.
SOME_KEYS = 8192


class SourceError(RuntimeError):
    pass


def check_windows(windows: DataFrame, now: datetime | None = None, retention_days: int | None = RETENTION_DAYS) -> None:
    """Refuse windows in wrong order or older than the source keeps; None turns the age check off."""
    now = now or datetime.now(timezone.utc)
    guarded = guard_windows(windows, now, retention_days or RETENTION_DAYS).filter("status <> 'ok'")
    if retention_days is None:
        guarded = guarded.filter("status <> 'beyond_retention'")
    bad = guarded.first()
    if bad is not None:
        raise ValueError(f"window {bad['_window_start']} .. {bad['_window_end']}: {bad['status']}")


def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def days_of_keys(loads: DataFrame, spans: list[tuple[int, int]]) -> list[date]:
    """Event dates that can hold keys of the ranges, told by the earlier loads: at most one value per calendar day."""
    if not spans:
        return []
    overlaps = [(F.col("low_key") <= F.lit(high)) & (F.col("high_key") >= F.lit(low)) for low, high in joined_spans(spans)]
    found = loads.filter(F.col("event_date").isNotNull() & reduce(lambda x, y: x | y, overlaps))
    return sorted(r["event_date"] for r in found.select("event_date").distinct().collect())


def days_with_keys(warehouse: Warehouse, keys: DataFrame, loads: DataFrame, days: list[date], rows: int = 0) -> list[date]:
    """Of the days whose ranges overlap the keys', those whose filters at least one key passes, and those that some load
    left without a filter. ``loads`` must be the ledger without the load that asks; ``rows`` says how many keys there are.

    Only which days are hit matters, not by which keys, and a day that one key has hit is not asked again: first each key
    asks the filters of its own event date, then some thousand keys and at last all of them ask the days still left. Of very
    many keys a few pass any large filter, so all of them ask small or few days only.
    """
    if not days:
        return []
    filters = warehouse.key_filters(days)
    levels = [r["level"] for r in filters.select("level").distinct().collect()]  # at most one per power of two
    covered = filters.select("event_date", "_load_id").distinct()
    noted = loads.filter(F.col("event_date").isin(days)).select("event_date", "_load_id").distinct()
    bare = noted.join(covered, ["event_date", "_load_id"], "left_anti").select("event_date").distinct()
    found = {r["event_date"] for r in bare.collect()}  # here and below at most one value per calendar day
    asks = [lambda left: possible_days(keys, left, "_key", levels)]
    if rows > SOME_KEYS:
        asks.insert(0, lambda left: possible_days(some_keys(keys, "_key", rows, SOME_KEYS), left, "_key", levels))
    if "event_date" in keys.columns:
        asks.insert(0, lambda left: passed_days(keys, left, "_key", levels))
    for ask in asks if levels else []:
        left = [d for d in days if d not in found]
        if left:
            found |= {r["event_date"] for r in ask(warehouse.key_filters(left)).select("event_date").distinct().collect()}
    return sorted(found)


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same ranges, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def load_judged(
    warehouse: Warehouse, judged: DataFrame, pages: DataFrame, ingested_at: datetime, load_id: str | None = None
) -> DataFrame:
    """Append new valid records to raw and new errors to quarantine; returns the stats per page.

    ``judged`` must be stored (it is read several times). Running the same load again adds nothing. What is read
    of the tables is bounded by the days that matter to this load, not by their history.
    """
    covered = pages.agg(
        F.to_date(F.min("_window_start")).alias("first_day"),
        F.to_date(F.max("_window_start")).alias("last_window_day"),
        F.to_date(F.max("_window_end") - F.expr("interval 1 microsecond")).alias("last_day"),
    ).first()
    if covered["first_day"] is None:
        return warehouse.load_stats([])
    load_id = load_id or uuid.uuid4().hex
    event_days = days_between(covered["first_day"], covered["last_day"])
    window_days = days_between(covered["first_day"], covered["last_window_day"])
    counted = judged.agg(F.count_if(F.col("status") == OK).alias("valid"), F.count_if(F.col("status") == ERROR).alias("bad")).first()
    by_day = (
        valid_records(judged)
        .groupBy(F.to_date("event_time").alias("event_date"))
        .agg(F.min("_key").alias("low_key"), F.max("_key").alias("high_key"), F.count("_key").alias("keys"))
    )
    days = by_day.collect()  # one row per event date of the load
    spans = [(r["low_key"], r["high_key"]) for r in days]
    loads = warehouse.loads()
    first_id = loads.agg(F.coalesce(F.max("next_id"), F.lit(1)).alias("next_id")).first()["next_id"]
    known_days = days_of_keys(loads, spans)
    # recorded before any row is stored: a load that dies half-way leaves a gap in the ids and no repeated id,
    # and its rows are found by the next one
    most = max(counted["valid"], counted["bad"])
    ids = (first_id, first_id + id_span(judged, most))
    rows = [(*ids, r["low_key"], r["high_key"], r["event_date"]) for r in days] + [(*ids, None, None, None)]
    ledger = warehouse.spark.createDataFrame(rows, "first_id long, next_id long, low_key long, high_key long, event_date date")
    warehouse.append_load(ledger.withColumns({"_ingested_at": F.lit(ingested_at), "_load_id": F.lit(load_id)}))
    marks = {"_ingested_at": F.lit(ingested_at), "_load_id": F.lit(load_id)}

    if counted["valid"]:
        keys = valid_records(judged).select("_key", F.to_date("event_time").alias("event_date"))
        known = in_ranges(warehouse.raw(days_with_keys(warehouse, keys, loads, known_days, counted["valid"])), "_key", joined_spans(spans))
        # written before the rows, like the ledger: a filter may say more than raw holds, never less
        sizes = warehouse.spark.createDataFrame([(r["event_date"], r["keys"]) for r in days], "event_date date, keys long")
        warehouse.append_key_filters(key_filters(keys, sizes, "_key").withColumn("_load_id", F.lit(load_id)))
        new = insert_if_absent(valid_records(judged), known, "_key", ARRIVAL)
        new = number_rows(new, "_raw_id", first_id, ARRIVAL, most)
        warehouse.append_raw(new.withColumns({**marks, "_event_date": F.to_date("event_time")}))
    if counted["bad"]:
        scratch: list[str] = []
        try:
            # the few errors are stored, so that all payloads are read once for them and each is fingerprinted once
            bad = materialize(error_rows(judged), "bad", warehouse.spark, scratch)
            # a fingerprint covers the window, so only errors of the same windows can be the same
            new_bad = insert_if_absent(bad, warehouse.errors(window_days), "_error_fingerprint", ARRIVAL)
            new_bad = number_rows(new_bad, "_error_id", first_id, ARRIVAL, most)
            warehouse.append_errors(new_bad.withColumns(marks))
        finally:
            discard(warehouse.spark, scratch)

    mine = F.col("_load_id") == load_id
    stored, stored_bad = warehouse.raw(event_days).filter(mine), warehouse.errors(window_days).filter(mine)
    stats = load_stats(judged, stored, stored_bad, PAGE, pages)
    warehouse.append_load_stats(stats.withColumns(marks))
    return warehouse.load_stats(window_days).filter(mine)


def load_pages(
    warehouse: Warehouse,
    lines: DataFrame,
    max_pages: int = MAX_PAGES,
    ingested_at: datetime | None = None,
    complete: bool = True,
    asked: DataFrame | None = None,
) -> DataFrame:
    """Load landed lines. Of a page that landed more than once the newest landing counts.

    ``complete`` lines hold whole windows: good pages before a window's first bad one are committed, all others that
    landed too, and then anything wrong (a bad page, a gap, more pages than ``max_pages``, a window that says more
    follow, an ``asked`` window that did not land) fails the load. Otherwise, as in a micro-batch, every good page is
    committed, bad ones go to ``bad_pages``, good ones to the page ledger (see ``open_windows``), and the load goes on.

    Pages and records are parsed once; the judged records, with their pages' headers, are stored in the shared
    folder, and every later step reads the columns it needs from there, also after an executor is lost. The folder is
    cleared when the load is done.
    """
    scratch: list[str] = []
    try:
        parsed = normalize_windows(parse_pages(lines))
        judged = classify(page_records(parsed)).withColumn("row", F.monotonically_increasing_id())
        rows = materialize(judged, "judged", warehouse.spark, scratch)
        headers = materialize(page_headers(rows), "pages", warehouse.spark, scratch)
        pages, rows = newest_landings(headers, headers), newest_landings(rows, headers)
        check_windows(pages, retention_days=None)
        stamp, load_id = ingested_at or datetime.now(timezone.utc), uuid.uuid4().hex

        admitted = [admit(df, pages) if complete else good_pages(df) for df in (rows, pages)]
        stats = load_judged(warehouse, only_records(admitted[0]), admitted[1], stamp, load_id)
        if complete:
            wrong = violations(pages, max_pages, asked).orderBy("_window_start", "page_no", "reason").first()
            if wrong is not None:
                raise SourceError(
                    f"{wrong['reason']} in window {wrong['_window_start']}, page {wrong['page_no']}: {wrong['detail']}"
                )
        else:
            warehouse.append_page_intervals(page_intervals(pages).withColumn("_load_id", F.lit(load_id)))
            bad = page_errors(pages).withColumns({"_ingested_at": F.lit(stamp), "_load_id": F.lit(load_id)})
            if bad.first() is not None:
                warehouse.append_bad_pages(bad)
        return stats
    finally:
        discard(warehouse.spark, scratch)


def open_windows(warehouse: Warehouse, asked: DataFrame | None = None, max_pages: int = MAX_PAGES, days: list[date] | None = None) -> DataFrame:
    """What is still wrong with the windows that micro-batches have landed pages of, over all batches so far: gaps, windows
    that say more follow or go beyond the limit, and asked windows without a page. Zero rows: all is there."""
    return ledger_violations(merged_intervals(warehouse.page_intervals(days)), max_pages, asked)


def open_bad_pages(warehouse: Warehouse) -> DataFrame:
    """Bad pages that no later load has taken; lines that have lost their window or page stay open."""
    taken = warehouse.load_stats().groupBy(*PAGE).agg(F.max("_ingested_at").alias("taken_at"))
    later = warehouse.bad_pages().join(taken, PAGE, "left")
    return later.filter(F.col("taken_at").isNull() | (F.col("taken_at") <= F.col("_ingested_at"))).drop("taken_at", "_load_id")


def loaded_days(stats: DataFrame) -> list[date]:
    """Event dates of the windows a load covered: at most one value per calendar day.

    A load that is repeated after a failure covers the same days, also if it finds nothing left to add.
    """
    last = F.to_date(F.col("_window_end") - F.expr("interval 1 microsecond"))
    days = F.explode(F.sequence(F.to_date("_window_start"), last)).alias("day")
    windows = stats.select("_window_start", "_window_end").distinct()
    return [r["day"] for r in windows.select(days).distinct().orderBy("day").collect()]


def refresh(warehouse: Warehouse, days: list[date] | None = None) -> None:
    """Rebuild the stored staging copy and the mart: wholly, or only the given event dates.

    Raw holds every key once and an event's date never changes, so staging needs no deduplication and a date
    depends on its own raw folder alone. Rows without a typed key, of which only the newest one of the whole table
    survives, are kept in a side table; if the survivor moves, the mart of the date it leaves is rebuilt as well.
    """
    if days is not None and not days:
        return
    whole = days is None
    before = _survivor_days(warehouse)
    warehouse.replace_staging(staging_of_unique(warehouse.raw(days)), whole)
    warehouse.replace_untyped(days, whole)
    touched = None if whole else sorted({*days, *(before ^ _survivor_days(warehouse))})
    rolled = daily_rollup(warehouse.staging(touched))
    warehouse.replace_mart(rolled, whole)
    if not whole:
        # a date that held nothing but the old survivor has no row to be overwritten by
        warehouse.drop_mart_days(before - {r["activity_date"] for r in warehouse.staging(sorted(before)).select("activity_date").distinct().collect()})


def pending_additions(warehouse: Warehouse) -> list[tuple[date, str]]:
    """Event dates and loads whose rows the daily state does not hold yet: one row per date of a load."""
    loads = warehouse.loads().filter("event_date is not null").select(F.col("event_date").alias("activity_date"), "_load_id")
    held = warehouse.state_log().select("activity_date", "_load_id")
    missing = loads.distinct().join(held, ["activity_date", "_load_id"], "left_anti")
    return sorted((r["activity_date"], r["_load_id"]) for r in missing.collect())


def advance(warehouse: Warehouse, most_deltas: int = MOST_DELTAS) -> list[date]:
    """Add what the loads since the last call brought to staging, to the daily state and to the mart; the days touched.

    Only rows of those loads are typed and counted, whatever else a day holds: an addition is a day's counters and users as
    bitmaps, and the mart of the touched days is the sum of their additions. Whatever a call that died has left is written
    again by the next one, load by load, before the log makes it count. Days with very many additions are folded.
    """
    pending = pending_additions(warehouse)
    if not pending:
        return []
    days, loads = sorted({d for d, _ in pending}), sorted({i for _, i in pending})
    spark, scratch = warehouse.spark, []
    try:
        new = warehouse.raw(days).filter(F.col("_load_id").isin(loads))
        before = _survivor_days(warehouse)
        warehouse.replace_staging(staging_of_unique(new), whole=False)
        rows = warehouse.staged_by(loads, days)
        typed, untyped = rows.filter("change_id is not null"), rows.filter("change_id is null")
        if untyped.select("activity_date").first() is not None:
            warehouse.add_untyped(untyped)
        names = materialize(state.day_names(rows), "names", spark, scratch)
        held = warehouse.user_numbers(days)
        placed = materialize(state.new_numbers(names, held), "placed", spark, scratch)
        warehouse.append_user_numbers(state.dense(placed, held))
        warehouse.add_deltas(state.day_counters(typed), state.day_users(typed, warehouse.user_numbers(days)))
        log = spark.createDataFrame([(d, i, []) for d, i in pending], STATE_LOG)
        warehouse.append_state_log(log)
        touched = sorted({*days, *(before ^ _survivor_days(warehouse))})
        mart = materialize(mart_from_state(warehouse, touched), "mart", spark, scratch)
        warehouse.replace_mart(mart, whole=False)
        if before:
            warehouse.drop_mart_days(before - {r["activity_date"] for r in mart.select("activity_date").distinct().collect()})
        fold(warehouse, touched, most_deltas)
        return touched
    finally:
        discard(spark, scratch)


def mart_from_state(warehouse: Warehouse, days: list[date]) -> DataFrame:
    """The mart of the days: the sum of their additions and the one row without a typed key that staging keeps."""
    counters, users = warehouse.day_deltas(days)
    survivor = warehouse.untyped_survivor().filter(F.col("activity_date").isin(days)).drop("activity_date")
    return state.mart_of(
        counters.unionByName(state.day_counters(survivor)),
        users.unionByName(state.day_users(survivor, warehouse.user_numbers(days))),
    )


def fold(warehouse: Warehouse, days: list[date], most_deltas: int = MOST_DELTAS) -> None:
    """Make one addition out of those of each day that has more than ``most_deltas``; no total changes."""
    log = warehouse.state_log().filter(F.col("activity_date").isin(days))
    folded = log.select("activity_date", F.explode("replaces").alias("_load_id"))
    counting = log.select("activity_date", "_load_id").distinct().join(folded, ["activity_date", "_load_id"], "left_anti")
    many = counting.groupBy("activity_date").agg(F.collect_list("_load_id").alias("loads")).filter(F.size("loads") > most_deltas).collect()
    if not many:
        return
    name = F.lit(f"fold-{uuid.uuid4().hex}")
    counters, users = warehouse.day_deltas([r["activity_date"] for r in many])
    scratch: list[str] = []
    try:
        stored = [
            materialize(df.withColumn("_load_id", name), "fold", warehouse.spark, scratch)
            for df in (state.merged_counters(counters), state.merged_users(users))
        ]
        warehouse.add_deltas(*stored)
        rows = [(r["activity_date"], r["loads"]) for r in many]
        made = warehouse.spark.createDataFrame(rows, "activity_date date, replaces array<string>")
        warehouse.append_state_log(made.withColumn("_load_id", name))
        warehouse.drop_deltas([(day, load) for day, loads in rows for load in loads])
    finally:
        discard(warehouse.spark, scratch)


def _survivor_days(warehouse: Warehouse) -> set[date]:
    return {r["activity_date"] for r in warehouse.untyped_survivor().select("activity_date").collect() if r["activity_date"]}


def check(warehouse: Warehouse, strict: bool = True, days: list[date] | None = None) -> DataFrame:
    """The quality report over the stored tables, or over the given event dates of them; in strict mode a violation
    fails the run.

    With dates no payload is read: that none is missing is enforced when raw is appended to, as is that no key is
    stored twice, so it is enough to look for repeated keys within the dates.
    """
    raw = warehouse.raw(days)
    report = quality_report(
        raw, warehouse.staging(days), warehouse.mart(days), RAW_REQUIRED if days is None else [c for c in RAW_REQUIRED if c != "_raw"]
    )
    report = materialize(report, "quality")
    if strict:
        require_quality(report)
    return report


def run(
    spark: SparkSession,
    landing: str,
    root: str,
    window_dates: list[date] | None = None,
    max_pages: int = MAX_PAGES,
    full_refresh: bool = False,
    strict: bool = True,
) -> DataFrame:
    """Load, transform, check; a failing step stops the later ones. Returns the load's counters per window.

    ``window_dates`` selects the landed folders: one date is a daily run, many are a backfill in one pass. A date
    whose window did not land fails the run, after the others are committed.
    """
    warehouse = Warehouse(configure(spark), root)
    asked = None if window_dates is None else daily_windows(spark, window_dates)
    stats = load_pages(warehouse, read_lines(spark, landing, window_dates), max_pages, asked=asked)
    days = None if full_refresh else loaded_days(stats)
    refresh(warehouse, days)
    check(warehouse, strict, days)
    return total_stats(stats, ["_window_start"])


def backfill(
    spark: SparkSession,
    landing: str,
    root: str,
    first: date,
    last: date,
    now: datetime | None = None,
    retention_days: int | None = RETENTION_DAYS,
    **options,
) -> DataFrame:
    """All daily windows from ``first`` to ``last`` in one set-based run; returns the mart's coverage.

    Doing it again changes no total, except by events that have landed since.
    """
    check_windows(windows_between(configure(spark), first, last), now, retention_days)
    run(spark, landing, root, days_between(first, last), **options)
    return backfill_coverage(Warehouse(spark, root).mart())


def resume_backfill(
    spark: SparkSession,
    landing: str,
    root: str,
    first: date,
    last: date,
    now: datetime | None = None,
    retention_days: int | None = RETENTION_DAYS,
    pass_days: int | None = None,
    max_pages: int = MAX_PAGES,
    strict: bool = True,
) -> DataFrame:
    """Like ``backfill``, but only what is left to do: steps that no earlier call has done for the files that have landed.

    The dates are worked on in passes of up to ``pass_days`` of those with an open step (None: one pass), each loaded,
    refreshed and checked as a set. A step is noted once it is done, with the digest that the date's landing had before the
    call, so a call that breaks off loses at most the pass it was in, and files that land meanwhile open their date
    again. Returns the mart's coverage.
    """
    check_windows(windows_between(configure(spark), first, last), now, retention_days)
    warehouse, days = Warehouse(spark, root), days_between(first, last)
    inputs = progress.landing_digests(landed_files(spark, landing, days))
    pending = progress.open_steps(spark, days, inputs, warehouse.backfill_steps()).collect()  # at most three per date
    landed = {r["window_date"]: r for r in pending}
    steps = {step: {r["window_date"] for r in pending if r["step"] == step} for step in progress.STEPS}
    left = sorted(landed)

    def note(step: str, done: list[date]) -> None:
        stamp = datetime.now(timezone.utc)
        rows = [(d, step, *[landed[d][c] for c in progress.DIGEST], stamp) for d in done]
        warehouse.append_backfill_steps(spark.createDataFrame(rows, BACKFILL_STEPS))

    for at in range(0, len(left), pass_days or max(len(left), 1)):
        part = left[at : at + (pass_days or len(left))]
        load, refreshed, checked = ([d for d in part if d in steps[step]] for step in progress.STEPS)
        if load:
            load_pages(warehouse, read_lines(spark, landing, load), max_pages, asked=daily_windows(spark, load))
            note(progress.LOAD, load)
        if refreshed:
            refresh(warehouse, loaded_days(warehouse.load_stats(refreshed)))
            note(progress.REFRESH, refreshed)
        if checked:
            check(warehouse, strict, loaded_days(warehouse.load_stats(checked)))
            note(progress.CHECK, checked)
    return backfill_coverage(warehouse.mart())


def inject_fault(warehouse: Warehouse) -> None:
    """Double one mart row, so that the grain check must fail until the mart is rebuilt."""
    warehouse.append_mart(materialize(peek(warehouse.mart(), 1, GRAIN), "fault"))
