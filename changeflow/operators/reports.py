"""Reports over the daily mart, and over nothing else."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.functions.numbers import rate
from changeflow.schemas import TOP_NAMESPACES


def _by_date(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("activity_date").asc_nulls_last())


def _rates() -> list:
    total = F.sum("total_changes")
    return [
        rate(F.sum("bot_changes"), total).alias("bot_rate"),
        rate(F.sum("anonymous_changes"), total).alias("anonymous_rate"),
    ]


def daily_total_changes(mart: DataFrame) -> DataFrame:
    return _by_date(mart.groupBy("activity_date").agg(F.sum("total_changes").alias("total_changes")))


def daily_rates(mart: DataFrame) -> DataFrame:
    """Rates per day, weighted by changes (not the mean of the namespaces' rates)."""
    return _by_date(mart.groupBy("activity_date").agg(*_rates()))


def namespace_totals(mart: DataFrame) -> DataFrame:
    return mart.groupBy("namespace_name").agg(F.sum("total_changes").alias("total_changes"))


def top_namespaces(mart: DataFrame, n: int = TOP_NAMESPACES) -> DataFrame:
    """The n busiest namespace names; equal totals in order of name."""
    return (
        namespace_totals(mart)
        .orderBy(F.col("total_changes").desc_nulls_first(), F.col("namespace_name").asc_nulls_last())
        .limit(n)
    )


def latest_day(mart: DataFrame) -> DataFrame:
    return mart.agg(F.max("activity_date").alias("activity_date"))


def latest_day_kpis(mart: DataFrame) -> DataFrame:
    """Figures of the last day. ``namespace_user_occurrences`` adds per-namespace users, so one user may count
    several times. The broadcast side is one row by construction (a global maximum)."""
    return (
        mart.join(F.broadcast(latest_day(mart)), "activity_date")
        .groupBy("activity_date")
        .agg(
            F.sum("total_changes").alias("total_changes"),
            F.sum("unique_users").alias("namespace_user_occurrences"),
            *_rates(),
        )
    )


def change_types_daily(mart: DataFrame) -> DataFrame:
    return _by_date(
        mart.groupBy("activity_date").agg(
            F.sum("edit_count").alias("edit_count"),
            F.sum("new_page_count").alias("new_page_count"),
            F.sum("log_count").alias("log_count"),
        )
    )


def change_types_long(mart: DataFrame) -> DataFrame:
    """One row per day and change type, for a stacked bar."""
    return change_types_daily(mart).unpivot(
        "activity_date", ["edit_count", "new_page_count", "log_count"], "change_type", "changes"
    )


def peek(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first n rows in the given order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


REPORTS = {
    "daily_total_changes": daily_total_changes,
    "daily_rates": daily_rates,
    "top_namespaces": top_namespaces,
    "latest_day_kpis": latest_day_kpis,
    "change_types_daily": change_types_daily,
}
