"""Which pages of a window have landed, as intervals, over any number of loads in any order.

A load adds the intervals of its own pages; intervals that touch or overlap merge when they are read (gaps and islands), so
gaps, ends and limits are judged over everything that has landed so far, and a load done twice changes nothing.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.operators.gates import WINDOW, is_bad
from changeflow.schemas import MAX_PAGES

INTERVAL = [*WINDOW, "first_page", "last_page", "has_more"]


def page_intervals(pages: DataFrame) -> DataFrame:
    """The good pages of a load as intervals; ``has_more`` is what the interval's last page says."""
    good = pages.filter(~is_bad())
    return merged_intervals(good.select(*WINDOW, F.col("page_no").alias("first_page"), F.col("page_no").alias("last_page"), "has_more"))


def merged_intervals(intervals: DataFrame) -> DataFrame:
    """The fewest intervals that hold the same pages. Of several words on one last page, that more follow counts only if
    all say so: a page fetched again may have become the last."""
    window = W.partitionBy(*WINDOW).orderBy("first_page", "last_page")
    reach = F.max("last_page").over(window.rowsBetween(W.unboundedPreceding, -1))
    starts = F.when(F.col("first_page") <= reach + 1, 0).otherwise(1)
    island = F.sum("_starts").over(window.rowsBetween(W.unboundedPreceding, 0))
    word = F.max(F.struct("last_page", (~F.col("has_more")).alias("is_end")))
    return (
        intervals.distinct()
        .withColumn("_starts", starts)
        .withColumn("_island", island)
        .groupBy(*WINDOW, "_island")
        .agg(F.min("first_page").alias("first_page"), F.max("last_page").alias("last_page"), word.alias("_word"))
        .select(*WINDOW, "first_page", "last_page", (~F.col("_word.is_end")).alias("has_more"))
    )


def ledger_violations(intervals: DataFrame, max_pages: int = MAX_PAGES, asked: DataFrame | None = None) -> DataFrame:
    """What is wrong with the windows so far: ``_window_start, _window_end, reason, page_no``, the page being the first one
    missing or the last one landed. ``intervals`` must be merged."""
    before = F.lag("last_page", 1, 0).over(W.partitionBy(*WINDOW).orderBy("first_page"))
    placed = intervals.withColumn("_before", before)
    last = intervals.groupBy(*WINDOW).agg(F.max("last_page").alias("last_page"), F.max_by("has_more", "last_page").alias("has_more"))

    def found(df: DataFrame, reason: str, page: Column) -> DataFrame:
        return df.select(*WINDOW, F.lit(reason).alias("reason"), page.cast("long").alias("page_no"))

    parts = [
        found(placed.filter("first_page - _before > 1"), "page_gap", F.col("_before") + 1),
        found(last.filter("has_more"), "incomplete_window", F.col("last_page")),
        found(last.filter(F.col("last_page") > max_pages), "page_limit", F.col("last_page")),
    ]
    if asked is not None:
        absent = asked.select(WINDOW).join(intervals.select(WINDOW).distinct(), WINDOW, "left_anti")
        parts.append(found(absent, "missing_window", F.lit(None)))
    return reduce(DataFrame.unionByName, parts)
