"""Landed source pages: JSON lines, one page per line, below ``window_date=`` folders.

A line is ``{"window_start": iso, "window_end": iso, "page": n, "fetched_at": iso, "body": {page as the source sent
it}}``; the body holds ``query.recentchanges[]`` and perhaps ``continue`` or ``error``. A page may land again: its newest
landing by ``fetched_at`` counts (a line without that time is older than any with it). The fetching client is not part of
this package: whatever lands such lines is the source.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.payload import has_key, is_truthy
from changeflow.functions.times import iso_utc, request_time, zoned_timestamp
from changeflow.schemas import CHANGE_TYPES, LANDED_LINE

# What the source is asked for (fixed values).
REQUESTED_PROPERTIES = ["title", "ids", "sizes", "flags", "user", "userid", "timestamp", "comment", "loginfo", "tags"]


def source_request(windows: DataFrame) -> DataFrame:
    """Per window, the interval, type and property selection the source is asked for."""
    return windows.select(
        "_window_start",
        "_window_end",
        request_time(F.col("_window_start")).alias("rcstart"),
        request_time(F.col("_window_end")).alias("rcend"),
        F.lit("newer").alias("rcdir"),
        F.lit("|".join(CHANGE_TYPES)).alias("rctype"),
        F.lit("|".join(REQUESTED_PROPERTIES)).alias("rcprop"),
    )


def read_lines(spark: SparkSession, path: str, window_dates: list | None = None) -> DataFrame:
    """The landed lines; with ``window_dates``, only those folders are listed for reading."""
    lines = spark.read.schema("value string, window_date date").text(path)
    if window_dates is not None:
        lines = lines.filter(F.col("window_date").isin(window_dates))
    return lines


def landed_files(spark: SparkSession, path: str, window_dates: list) -> DataFrame:
    """``path, modificationTime, length`` of the files of the dates; nothing is read of them."""
    files = spark.read.format("binaryFile").load(path).withColumn("window_date", F.col("window_date").cast("date"))
    return files.filter(F.col("window_date").isin(window_dates)).select("window_date", "path", "modificationTime", "length")


def stream_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return spark.readStream.options(**options).schema("value string, window_date date").text(path)


PAGE = ["_window_start", "_window_end", "page_no"]
GATE = ["fetched_at", "readable", "has_error", "error_json", "has_more", "bad_line"]
PAGE_HEADER = [*PAGE, *GATE]


def parse_pages(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per line: window, page number, what the gates look at, and the record texts.

    The line is tokenized once (the generator keeps later filters from repeating it). Record texts keep their
    keys, order and values; only blanks between tokens and trailing zeros of fractions go. A line that is no JSON, or whose parts have the wrong shape, is kept with
    ``readable`` false and no records.
    """
    line = F.from_json(F.col(column), LANDED_LINE, {"columnNameOfCorruptRecord": "_unreadable"})
    parsed = lines.select(F.inline(F.array(line)))
    start, end = zoned_timestamp(F.col("window_start")), zoned_timestamp(F.col("window_end"))
    parts = [start, end, F.col("page"), F.col("body")]
    readable = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts], F.col("_unreadable").isNull())
    return parsed.select(
        start.alias("_window_start"),
        end.alias("_window_end"),
        F.col("page").alias("page_no"),
        zoned_timestamp(F.col("fetched_at")).alias("fetched_at"),
        readable.alias("readable"),
        has_key(F.col("body.error")).alias("has_error"),
        F.to_json(F.col("body.error")).alias("error_json"),
        is_truthy(F.col("body.continue")).alias("has_more"),
        F.when(~readable, F.coalesce("_unreadable", F.lit("a window bound, page or body is missing"))).alias("bad_line"),
        F.when(readable, F.col("body.query.recentchanges")).alias("records"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """One row per record, in page order (``pos``), next to its page's header. A page without records keeps one
    row with no ``pos``; a JSON null in the list is a record, ``null``."""
    return pages.select(*PAGE_HEADER, F.posexplode_outer("records").alias("pos", "record")).select(
        *PAGE_HEADER,
        F.col("pos").cast("long").alias("pos"),
        F.when(F.col("pos").isNotNull(), F.coalesce("record", F.lit("null"))).alias("_raw"),
    )


def only_records(rows: DataFrame) -> DataFrame:
    """Without the rows that stand for pages without records, and without the page headers' gate columns."""
    return rows.filter(F.col("pos").isNotNull()).drop(*GATE)


def page_headers(rows: DataFrame) -> DataFrame:
    """The pages' headers again, one row per landing of a page, from rows made by ``page_records``."""
    return rows.filter("readable").groupBy(*PAGE, "fetched_at", "has_error").agg(
        F.lit(True).alias("readable"),
        F.max("error_json").alias("error_json"),
        F.bool_or("has_more").alias("has_more"),
        F.lit(None).cast("string").alias("bad_line"),
    ).unionByName(rows.filter("not readable").select(PAGE_HEADER))


def _landing() -> Column:
    """Orders the landings of a page: by time, and of equal times a good one after a bad one."""
    good = F.col("readable") & ~F.col("has_error")
    return F.struct(F.coalesce("fetched_at", F.lit(0).cast("timestamp")).alias("at"), F.coalesce(good, F.lit(False)).alias("good"))


def newest_landings(rows: DataFrame, headers: DataFrame) -> DataFrame:
    """``rows`` (or headers) without those of landings that a later one of the same page supersedes.

    Only pages that landed more than once are joined, which are few; the rows themselves need no shuffle for it.
    """
    again = (
        headers.groupBy(*[F.col(c).alias(f"_{c}") for c in PAGE])
        .agg(F.max(_landing()).alias("_newest"), F.min(_landing()).alias("_oldest"))
        .filter("_newest <> _oldest")
        .drop("_oldest")
    )
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in PAGE])
    kept = rows.join(again, same, "left").filter(F.col("_newest").isNull() | (_landing() == F.col("_newest")))
    return kept.select(rows.columns)


def landed_line(body: Column, fetched_at: Column | None = None) -> Column:
    """A landing line from a page body and its window and page number columns, and perhaps the time of the fetch."""
    stamp = [F.lit(',"fetched_at":"'), iso_utc(fetched_at), F.lit('"')] if fetched_at is not None else []
    return F.concat(
        F.lit('{"window_start":"'),
        iso_utc(F.col("_window_start")),
        F.lit('","window_end":"'),
        iso_utc(F.col("_window_end")),
        F.lit('","page":'),
        F.col("page_no"),
        *stamp,
        F.lit(',"body":'),
        body,
        F.lit("}"),
    )


def write_pages(pages: DataFrame, path: str) -> None:
    """Land pages (``_window_start, _window_end, page_no, body``, perhaps ``fetched_at``), adding to what is there."""
    stamp = F.col("fetched_at") if "fetched_at" in pages.columns else None
    (
        pages.select(landed_line(F.col("body"), stamp).alias("value"), F.to_date("_window_start").alias("window_date"))
        .write.mode("append")
        .partitionBy("window_date")
        .text(path)
    )
