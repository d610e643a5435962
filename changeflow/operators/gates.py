"""Gates over landed pages. Zero rows means pass. What landed is loaded; a gate says what is wrong with it."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.schemas import MAX_PAGES

WINDOW = ["_window_start", "_window_end"]
VIOLATION = [*WINDOW, "page_no", "reason", "detail"]


def page_errors(pages: DataFrame) -> DataFrame:
    """Pages that carry an error, with its JSON, and lines that are no page at all."""
    return pages.filter(is_bad()).select(
        *WINDOW,
        "page_no",
        F.when(F.col("readable"), F.lit("source_error")).otherwise(F.lit("unreadable_page")).alias("reason"),
        F.when(F.col("readable"), F.col("error_json")).otherwise(F.col("bad_line")).alias("detail"),
    )


def is_bad() -> Column:
    return F.col("has_error") | ~F.col("readable")


def incomplete_windows(pages: DataFrame) -> DataFrame:
    """Windows whose last page still says that more follow."""
    return (
        pages.filter("readable")
        .groupBy(*WINDOW)
        .agg(F.max("page_no").alias("last_page"), F.max_by("has_more", "page_no").alias("has_more"))
        .filter("has_more")
        .drop("has_more")
    )


def page_gaps(pages: DataFrame) -> DataFrame:
    """Pages of a window that did not land although a later one did: ``first_missing`` to ``last_missing``."""
    landed = pages.filter("readable").select(*WINDOW, "page_no").distinct()
    before = F.lag("page_no", 1, 0).over(W.partitionBy(*WINDOW).orderBy("page_no"))
    return (
        landed.withColumn("before", before)
        .filter("page_no - before > 1")
        .select(*WINDOW, (F.col("before") + 1).alias("first_missing"), (F.col("page_no") - 1).alias("last_missing"))
    )


def pages_above_limit(pages: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """Windows with more pages than a run may fetch, and the last of them."""
    return (
        pages.filter(F.col("readable") & (F.col("page_no") > max_pages))
        .groupBy(*WINDOW)
        .agg(F.max("page_no").alias("last_page"))
    )


def missing_windows(asked: DataFrame, pages: DataFrame) -> DataFrame:
    """Asked windows of which no page landed."""
    return asked.select(WINDOW).join(pages.filter("readable").select(WINDOW).distinct(), WINDOW, "left_anti")


def violations(pages: DataFrame, max_pages: int = MAX_PAGES, asked: DataFrame | None = None) -> DataFrame:
    """Everything wrong with a landing that should be complete: one row each, with its reason."""

    def rows(df: DataFrame, reason: str, page: Column, detail: Column) -> DataFrame:
        return df.select(*WINDOW, page.cast("long").alias("page_no"), F.lit(reason).alias("reason"), detail.alias("detail"))

    gap = F.concat(F.lit("to page "), F.col("last_missing"))
    parts = [
        page_errors(pages),
        rows(page_gaps(pages), "page_gap", F.col("first_missing"), gap),
        rows(pages_above_limit(pages, max_pages), "page_limit", F.col("last_page"), F.concat(F.lit("limit "), F.lit(max_pages))),
        rows(incomplete_windows(pages), "incomplete_window", F.col("last_page"), F.lit("its last page says that more follow")),
    ]
    if asked is not None:
        parts.append(rows(missing_windows(asked, pages), "missing_window", F.lit(None), F.lit("no page of it landed")))
    return reduce(DataFrame.unionByName, parts)


def admit(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """The rows a strict load may commit: per window, those of pages before its first bad one. The joined side
    holds one row per window that has a bad page."""
    bad = (
        pages.filter(is_bad())
        .groupBy(F.col("_window_start").alias("_bad_start"), F.col("_window_end").alias("_bad_end"))
        .agg(F.min("page_no").alias("_first_bad"))
    )
    # an unreadable line may have lost its window or page number; it then holds nothing back but itself
    same_window = (F.col("_window_start") == F.col("_bad_start")) & (F.col("_window_end") == F.col("_bad_end"))
    return (
        rows.join(bad, same_window, "left")
        .filter(F.col("_first_bad").isNull() | (F.col("page_no") < F.col("_first_bad")))
        .drop("_bad_start", "_bad_end", "_first_bad")
    )


def good_pages(rows: DataFrame) -> DataFrame:
    """The rows of pages without an error: what a load takes that does not stop at a bad page."""
    return rows.filter(~is_bad())
