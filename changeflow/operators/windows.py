"""Half-open time windows [start, end)."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.schemas import RETENTION_DAYS


def normalize_windows(windows: DataFrame) -> DataFrame:
    """Equal bounds mean the day that starts there."""
    start, end = F.col("_window_start"), F.col("_window_end")
    return windows.withColumn("_window_end", F.when(start == end, start + F.expr("interval 1 day")).otherwise(end))


def guard_windows(windows: DataFrame, now: Column | datetime, retention_days: int = RETENTION_DAYS) -> DataFrame:
    """Normalized windows with a ``status``: ok, invalid_order or beyond_retention."""
    now = now if isinstance(now, Column) else F.lit(now)
    horizon = F.make_dt_interval(F.lit(retention_days))
    status = (
        F.when(F.col("_window_start") >= F.col("_window_end"), F.lit("invalid_order"))
        .when(now - F.col("_window_start") > horizon, F.lit("beyond_retention"))
        .otherwise(F.lit("ok"))
    )
    return normalize_windows(windows).withColumn("status", status)


def windows_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One daily window per date from ``first`` to ``last``, both included."""
    days = F.explode(F.sequence(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"), F.expr("interval 1 day")))
    return spark.range(1).select(days.alias("_window_start")).withColumn(
        "_window_end", F.col("_window_start") + F.expr("interval 1 day")
    )


def daily_windows(spark: SparkSession, days: list[date]) -> DataFrame:
    """The daily windows of the given dates."""
    starts = spark.createDataFrame([(d,) for d in days], "day date").select(F.col("day").cast("timestamp").alias("_window_start"))
    return starts.withColumn("_window_end", F.col("_window_start") + F.expr("interval 1 day"))


def covering_windows(events: DataFrame, time: str) -> DataFrame:
    """The daily windows from the first to the last event."""
    span = events.agg(F.min(F.to_date(time)).alias("first"), F.max(F.to_date(time)).alias("last"))
    days = F.explode(F.sequence(F.col("first").cast("timestamp"), F.col("last").cast("timestamp"), F.expr("interval 1 day")))
    return span.select(days.alias("_window_start")).withColumn(
        "_window_end", F.col("_window_start") + F.expr("interval 1 day")
    )


def assign_daily(events: DataFrame, time: str) -> DataFrame:
    """The UTC day each event belongs to: plain arithmetic, no join."""
    day = F.date_trunc("day", F.col(time))
    return events.withColumns({"_window_start": day, "_window_end": day + F.expr("interval 1 day")})


def assign_windows(events: DataFrame, windows: DataFrame, time: str) -> DataFrame:
    """Each event with every window it lies in, for windows of any length, overlapping or not.

    Windows are spread over the hours they touch, so the join is an equality on the hour followed by the exact
    interval test. Spark may broadcast the windows if they turn out small, and splits hot hours if not.
    """
    hours = F.sequence(
        F.date_trunc("hour", F.col("_window_start")),
        F.col("_window_end") - F.expr("interval 1 microsecond"),
        F.expr("interval 1 hour"),
    )
    spread = windows.filter(F.col("_window_start") < F.col("_window_end")).withColumn("_hour", F.explode(hours))
    t = F.col(time)
    return (
        events.withColumn("_hour", F.date_trunc("hour", t))
        .join(spread, "_hour")
        .filter((t >= F.col("_window_start")) & (t < F.col("_window_end")))
        .drop("_hour")
    )


# A cell of one level is so many cells of the level below; the lowest cell is a second, the highest some eight years.
FANOUT = 16
LEVELS = 8


def _cell(seconds: Column, level: int) -> Column:
    size = F.lit(FANOUT**level).cast("long")
    return F.call_function("div", seconds - F.pmod(seconds, size), size)


def _seconds(time: Column) -> Column:
    micros, million = F.unix_micros(time), F.lit(1_000_000).cast("long")
    return F.call_function("div", micros - F.pmod(micros, million), million)


def _cells(low: Column, high: Column, level: int) -> Column:
    """Cells from ``low`` up to, not with, ``high``; none if they cross."""
    cells = F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(cells, lambda cell: F.struct(F.lit(level).alias("_level"), cell.alias("_cell")))


def window_cells(start: Column, end: Column) -> Column:
    """The fewest cells of the hierarchy that make up a window, widened to whole seconds: those of a level that the level
    above cannot hold, at both ends. At most 30 a level, whatever the length of the window."""
    first, last = _seconds(start), _seconds(end - F.expr("interval 1 microsecond")) + 1

    def inside(level: int) -> tuple[Column, Column]:
        """The cells of a level that lie wholly in the window, from the one up to the other."""
        return _cell(first + FANOUT**level - 1, level), _cell(last, level)

    parts, size = [], F.lit(FANOUT).cast("long")
    for level in range(LEVELS):
        low, high = inside(level)
        if level == LEVELS - 1:
            parts.append(_cells(low, high, level))
            break
        above, below = inside(level + 1)
        held = above < below
        parts.append(_cells(low, F.when(held, above * size).otherwise(high), level))
        parts.append(_cells(F.when(held, below * size).otherwise(high), high, level))
    return F.concat(*parts)


def assign_windows_by_cells(events: DataFrame, windows: DataFrame, time: str) -> DataFrame:
    """Like ``assign_windows``, for windows of very different lengths: a minute and a year take some tens of rows each.

    An event has one cell per level, so a window and an event in it meet in exactly one cell, and no pair repeats. Only
    levels that some window uses are asked of the events (one small aggregate over the windows). Rows without a time, and
    empty or crossed windows, have no partner.
    """
    proper = windows.filter(F.col("_window_start") < F.col("_window_end"))
    spread = proper.withColumn("_at", F.explode(window_cells(F.col("_window_start"), F.col("_window_end"))))
    spread = spread.select(*windows.columns, "_at._level", "_at._cell")
    levels = sorted(r["_level"] for r in spread.select("_level").distinct().collect()) or [0]
    t = F.col(time)
    cells = F.array(*[F.struct(F.lit(n).alias("_level"), _cell(_seconds(t), n).alias("_cell")) for n in levels])
    placed = events.filter(t.isNotNull()).withColumn("_at", F.explode(cells)).select(*events.columns, "_at._level", "_at._cell")
    met = placed.join(spread, ["_level", "_cell"]).filter((t >= F.col("_window_start")) & (t < F.col("_window_end")))
    return met.drop("_level", "_cell")


def source_predicate(
    events: DataFrame, time: str, kind: str, start: Column | datetime, end: Column | datetime, kinds: list[str]
) -> DataFrame:
    """Events of the wanted kinds from start to end, oldest first. The source includes the end instant; the
    half-open test of validation takes it out again."""
    return events.filter(F.col(time).between(start, end) & F.col(kind).isin(kinds)).orderBy(time)
