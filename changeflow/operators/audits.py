"""Proofs about tables: coverage, idempotency, append-only, and a fault to test the checks with."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.operators.reports import daily_total_changes, peek
from changeflow.operators.rollup import GRAIN


def backfill_coverage(mart: DataFrame) -> DataFrame:
    """First and last day, number of days, and global totals."""
    return mart.agg(
        F.min("activity_date").alias("min_date"),
        F.max("activity_date").alias("max_date"),
        F.count_distinct("activity_date").alias("number_of_days"),
        F.sum("total_changes").alias("total_changes"),
        F.sum("bot_changes").alias("bot_changes"),
        F.sum("anonymous_changes").alias("anonymous_changes"),
    )


def missing_days(windows: DataFrame, mart: DataFrame) -> DataFrame:
    """Planned windows whose day the mart does not hold."""
    days = mart.select("activity_date").distinct()
    return windows.withColumn("activity_date", F.to_date("_window_start")).join(days, "activity_date", "left_anti")


def window_loads(raw: DataFrame) -> DataFrame:
    """Per window: stored rows, first and last load time."""
    return (
        raw.groupBy("_window_start", "_window_end")
        .agg(
            F.count("*").alias("raw_rows"),
            F.min("_ingested_at").alias("first_ingested_at"),
            F.max("_ingested_at").alias("last_ingested_at"),
        )
        .orderBy(F.col("_window_start").asc_nulls_last())
    )


def day_totals(mart: DataFrame) -> DataFrame:
    return daily_total_changes(mart).withColumnRenamed("total_changes", "mart_total_changes")


def compare_runs(before: DataFrame, after: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Both runs' values side by side per key, and whether they are the same. Keys match null-safely."""
    left = before.select(*[F.col(k).alias(f"_l_{k}") for k in keys], *[F.col(v).alias(f"{v}_before") for v in values])
    right = after.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[F.col(v).alias(f"{v}_after") for v in values])
    match = reduce(lambda a, b: a & b, [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(f"{v}_before").eqNullSafe(F.col(f"{v}_after")) for v in values])
    return left.join(right, match, "full_outer").select(
        *[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys],
        *[c for v in values for c in (f"{v}_before", f"{v}_after")],
        same.alias("unchanged"),
    )


def append_only_audit(before: DataFrame, after: DataFrame, id_column: str) -> DataFrame:
    """Rows of an earlier snapshot that a later one has changed or lost. Zero rows means append-only.

    Rows travel as id and digest, not as payloads; 96 bits of two hashes per row stand for its content.
    """

    def digest(df: DataFrame, name: str) -> DataFrame:
        columns = sorted(c for c in before.columns if c != id_column)
        # struct hashing skips NULLs without a trace, so say which columns are NULL
        nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in columns])
        content = F.struct(F.xxhash64(*columns, nulls), F.hash(*columns, nulls))
        return df.select(id_column, content.alias(name))

    return (
        digest(before, "_then")
        .join(digest(after, "_now"), id_column, "left")
        .filter(~F.col("_then").eqNullSafe(F.col("_now")))
        .select(id_column, F.when(F.col("_now").isNull(), F.lit("vanished")).otherwise(F.lit("changed")).alias("violation"))
    )


def vanished_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """The same audit for tables without an id: whole rows of ``before``, as often as ``after`` lacks them."""
    return before.exceptAll(after.select(before.columns))


def inject_duplicate(mart: DataFrame) -> DataFrame:
    """The mart with its first row doubled, to see the grain check fail."""
    return mart.unionByName(peek(mart, 1, GRAIN))
