"""The tables of a warehouse folder, as Parquet.

``raw``, ``errors`` and ``bad_pages`` can only be appended to; ``mart`` is replaced whole or by activity date; ``staging``
is a view over raw, with an optional stored copy that is replaced by date like the mart. One writer at a time.
"""

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.inserts import broken_constraints
from changeflow.schemas import BACKFILL_STEPS, BAD_PAGES, DAY_COUNTERS, DAY_USERS, ERRORS, KEY_FILTERS, LOAD_STATS, LOADS, MART, PAGE_LEDGER, RAW, STAGING, STATE_LOG, USER_NUMBERS

# The raw id breaks ties between rows without a typed key, of which one survives.
STORED_STAGING = T.StructType(
    [
        *STAGING.fields,
        T.StructField("_raw_id", T.LongType()),
        T.StructField("activity_date", T.DateType()),
        T.StructField("_load_id", T.StringType()),
    ]
)

DELTA = ["activity_date", "_load_id"]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(
        self, name: str, schema: T.StructType, partition: str | None = None, days: Sequence[date] | None = None
    ) -> DataFrame:
        """A table, or only the given days of it: folders of other days are pruned by the filter on the partition."""
        # known to be empty to the optimizer, too, which then drops joins with it
        nothing = self.spark.createDataFrame([], schema).filter(F.lit(False))
        if days is not None and not days:
            return nothing
        try:
            table = self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return nothing
        # partition columns come last when read; keep the declared order
        table = table.select(schema.fieldNames())
        return table if days is None else table.filter(F.col(partition).isin(list(days)))

    def raw(self, days: Sequence[date] | None = None) -> DataFrame:
        return self._read("raw", RAW, "_event_date", days)

    def errors(self, days: Sequence[date] | None = None) -> DataFrame:
        return self._read("errors", ERRORS, "_window_date", days)

    def staging(self, days: Sequence[date] | None = None) -> DataFrame:
        """Rows with a typed key, and the newest of all rows without one if it lies in the days."""
        stored = self._read("staging", STORED_STAGING, "activity_date", days).filter(F.col("change_id").isNotNull())
        survivor = self.untyped_survivor()
        if days is not None:
            survivor = survivor.filter(F.col("activity_date").isin(list(days)))
        return stored.unionByName(survivor).drop("_raw_id", "_load_id")

    def untyped(self, days: Sequence[date] | None = None) -> DataFrame:
        """The side table of staging rows without a typed key."""
        return self._read("untyped", STORED_STAGING, "activity_date", days)

    def untyped_survivor(self) -> DataFrame:
        """The one row without a typed key that staging keeps: the newest of the whole table. At most one row."""
        return self.untyped().orderBy(F.desc_nulls_first("_ingested_at"), F.desc_nulls_first("_raw_id")).limit(1)

    def mart(self, days: Sequence[date] | None = None) -> DataFrame:
        return self._read("mart", MART, "activity_date", days)

    def bad_pages(self) -> DataFrame:
        return self._read("bad_pages", BAD_PAGES)

    def load_stats(self, days: Sequence[date] | None = None) -> DataFrame:
        return self._read("load_stats", LOAD_STATS, "_window_date", days)

    def loads(self) -> DataFrame:
        return self._read("loads", LOADS)

    def _append(self, name: str, rows: DataFrame, schema: T.StructType, partition: str) -> None:
        rows.select(schema.fieldNames()).write.mode("append").partitionBy(partition).parquet(f"{self.root}/{name}")

    def append_raw(self, rows: DataFrame) -> None:
        """Rows that break a constraint make the append fail; the test is part of the write, not a pass of its own."""
        self._append("raw", rows.withColumn("_raw", _refusing(F.col("_raw"))), RAW, "_event_date")

    def append_errors(self, rows: DataFrame) -> None:
        dated = rows.withColumn("_raw", _refusing(F.col("_raw"))).withColumn("_window_date", F.to_date("_window_start"))
        self._append("errors", dated, ERRORS, "_window_date")

    def append_bad_pages(self, rows: DataFrame) -> None:
        rows.select(BAD_PAGES.fieldNames()).coalesce(1).write.mode("append").parquet(f"{self.root}/bad_pages")

    def append_page_intervals(self, rows: DataFrame) -> None:
        dated = rows.withColumn("_window_date", F.to_date("_window_start"))
        self._append("page_ledger", dated.repartition("_window_date"), PAGE_LEDGER, "_window_date")

    def page_intervals(self, days: Sequence[date] | None = None) -> DataFrame:
        """Intervals of pages that have landed well, of all windows or of those that start on the days; not yet merged."""
        return self._read("page_ledger", PAGE_LEDGER, "_window_date", days)

    def append_load_stats(self, rows: DataFrame) -> None:
        dated = rows.withColumn("_window_date", F.to_date("_window_start"))
        # one file per day: a day holds one row per page
        self._append("load_stats", dated.repartition("_window_date"), LOAD_STATS, "_window_date")

    def append_load(self, rows: DataFrame) -> None:
        """One row per event date of a load and one without a date, in one file."""
        rows.select(LOADS.fieldNames()).coalesce(1).write.mode("append").parquet(f"{self.root}/loads")

    def backfill_steps(self) -> DataFrame:
        return self._read("backfill_steps", BACKFILL_STEPS)

    def append_backfill_steps(self, rows: DataFrame) -> None:
        rows.select(BACKFILL_STEPS.fieldNames()).coalesce(1).write.mode("append").parquet(f"{self.root}/backfill_steps")

    def append_key_filters(self, rows: DataFrame) -> None:
        # one file per day, blocks in order: a reader skips the row groups of blocks it does not ask for
        ordered = rows.repartition("event_date").sortWithinPartitions("event_date", "level", "block")
        self._append("key_filters", ordered, KEY_FILTERS, "event_date")

    def key_filters(self, days: Sequence[date] | None = None) -> DataFrame:
        """Blocks of the loads' key filters. A load writes them before its rows, so a stored key is always in one."""
        return self._read("key_filters", KEY_FILTERS, "event_date", days)

    def _replace(self, name: str, rows: DataFrame, whole: bool, by: Sequence[str] = ("activity_date",)) -> None:
        """Overwrite a table, or only the partitions (activity dates, perhaps of a load) that ``rows`` holds."""
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if whole else "dynamic")
            .partitionBy(*by)
            .parquet(f"{self.root}/{name}")
        )

    def replace_mart(self, rows: DataFrame, whole: bool = True) -> None:
        # one small file per day: a day holds one row per namespace
        self._replace("mart", rows.repartition("activity_date"), whole)

    def drop_mart_days(self, days: set[date]) -> None:
        """Take the folders of dates that have no events any more out of the mart."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for day in sorted(days):
            path = hadoop.Path(f"{self.root}/mart/activity_date={day.isoformat()}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def replace_staging(self, rows: DataFrame, whole: bool = True) -> None:
        """Typed rows straight from raw, whose files hold one date each, written as they lie."""
        dated = rows.withColumn("activity_date", F.to_date("changed_at_utc"))
        self._replace("staging", dated.select(STORED_STAGING.fieldNames()), whole, DELTA)

    def staged_by(self, loads: Sequence[str], days: Sequence[date]) -> DataFrame:
        """Stored staging rows that the given loads brought, with ``_load_id``; other loads' folders are not opened."""
        return self._read("staging", STORED_STAGING, "activity_date", days).filter(F.col("_load_id").isin(list(loads)))

    def add_untyped(self, rows: DataFrame) -> None:
        """Rows of some loads without a typed key into the side table, in place of what these loads put there before."""
        self._replace("untyped", rows.select(STORED_STAGING.fieldNames()), False, DELTA)

    def state_log(self) -> DataFrame:
        return self._read("state_log", STATE_LOG)

    def append_state_log(self, rows: DataFrame) -> None:
        rows.select(STATE_LOG.fieldNames()).coalesce(1).write.mode("append").parquet(f"{self.root}/state_log")

    def user_numbers(self, days: Sequence[date]) -> DataFrame:
        return self._read("user_numbers", USER_NUMBERS, "activity_date", days)

    def append_user_numbers(self, rows: DataFrame) -> None:
        self._append("user_numbers", rows, USER_NUMBERS, "activity_date")

    def day_deltas(self, days: Sequence[date]) -> tuple[DataFrame, DataFrame]:
        """Counters and users that count for the days, as the log says."""
        log = self.state_log().filter(F.col("activity_date").isin(list(days)))
        folded = log.select("activity_date", F.explode("replaces").alias("_load_id"))
        counting = log.select("activity_date", "_load_id").distinct().join(folded, DELTA, "left_anti")
        tables = (("day_counters", DAY_COUNTERS), ("day_users", DAY_USERS))
        return tuple(self._read(name, schema, "activity_date", days).join(counting, DELTA, "left_semi") for name, schema in tables)

    def add_deltas(self, counters: DataFrame, users: DataFrame) -> None:
        """Write what loads add to days; the same load's earlier attempt is replaced. They count once the log names them."""
        for name, rows, schema in (("day_counters", counters, DAY_COUNTERS), ("day_users", users, DAY_USERS)):
            # one small file per load and day
            spread = rows.select(schema.fieldNames()).repartition(*DELTA)
            self._replace(name, spread, False, DELTA)

    def drop_deltas(self, replaced: Sequence[tuple[date, str]]) -> None:
        """Delete the folders of deltas that a folded one stands for."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for name in ("day_counters", "day_users"):
            for day, load in replaced:
                path = hadoop.Path(f"{self.root}/{name}/activity_date={day.isoformat()}/_load_id={load}")
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def replace_untyped(self, days: Sequence[date] | None, whole: bool) -> None:
        """Take the rows without a typed key out of the stored staging of ``days`` into the side table. Row groups
        that hold none are skipped by their statistics."""
        rows = self._read("staging", STORED_STAGING, "activity_date", days).filter(F.col("change_id").isNull())
        if whole or rows.select("activity_date").first() is not None:
            self._replace("untyped", rows.repartition("activity_date"), whole, DELTA)

    def append_mart(self, rows: DataFrame) -> None:
        """Only to break the grain on purpose; ``replace_mart`` is how the mart is built."""
        rows.write.mode("append").partitionBy("activity_date").parquet(f"{self.root}/mart")

    def publish(self, staging: DataFrame, prefix: str = "") -> None:
        """Temporary views for SQL users: raw, errors, staging (always a view) and mart."""
        self.raw().createOrReplaceTempView(f"{prefix}raw_changes")
        self.errors().createOrReplaceTempView(f"{prefix}raw_changes_errors")
        staging.createOrReplaceTempView(f"{prefix}stg_changes")
        self.mart().createOrReplaceTempView(f"{prefix}agg_changes_daily")


def _refusing(payload: Column) -> Column:
    broken = broken_constraints()
    return F.when(F.size(broken) > 0, F.raise_error(F.concat(F.lit("row breaks a constraint: "), F.array_join(broken, ", ")))).otherwise(payload)
