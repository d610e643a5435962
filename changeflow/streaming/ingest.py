"""The load as Structured Streaming: the same operators, fed by micro-batches of newly landed files."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.gates import good_pages, page_errors
from changeflow.operators.staging import type_records
from changeflow.operators.validation import classify, valid_records
from changeflow.plans.jobs import advance, load_pages
from changeflow.schemas import MAX_PAGES, RAW, RETENTION_DAYS
from changeflow.session import configure, discard, materialize
from changeflow.sources.landing import only_records, page_records, parse_pages, stream_lines
from changeflow.sources.tables import Warehouse


def run_available(
    spark: SparkSession, landing: str, root: str, checkpoint: str, max_pages: int = MAX_PAGES, **source_options: str
) -> None:
    """Load everything that landed since the last run, then stop.

    Each micro-batch is committed on its own and adds its rows to staging, to the daily state and to the mart of the days it
    touched, without reading what earlier ones staged. A batch that is tried again after a failure finds its keys in raw and
    adds nothing to it, and what it had not yet added to the state is added then, so a restart neither loses nor duplicates. Pages with an error and
    lines that are no page go to ``bad_pages`` and do not stop the stream; ``jobs.open_bad_pages`` tells which of them
    no later landing has made good.
    """
    warehouse = Warehouse(configure(spark), root)

    def load(batch: DataFrame, _batch_id: int) -> None:
        load_pages(warehouse, batch, max_pages, complete=False)
        advance(warehouse)

    query = (
        stream_lines(spark, landing, **source_options)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def valid_stream(lines: DataFrame) -> DataFrame:
    """Valid in-window records of a stream of landed lines; those of bad pages are left to ``bad_page_stream``."""
    return valid_records(classify(only_records(good_pages(page_records(parse_pages(lines))))))


def bad_page_stream(lines: DataFrame) -> DataFrame:
    """The other side of ``valid_stream``: pages with an error and lines that are no page, as rows to be stored."""
    return page_errors(parse_pages(lines))


def first_within_retention(records: DataFrame) -> DataFrame:
    """One record per key with bounded state: a key is remembered as long as the source keeps its events.

    Unlike the load above, which looks keys up in the whole of raw, this drops events later than that.
    """
    return records.withWatermark("event_time", f"{RETENTION_DAYS} days").dropDuplicatesWithinWatermark(["_key"])


def write_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append a stream's rows to a Parquet folder until its source is used up."""
    with state_on_disk(stream.sparkSession):
        query = (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB instead of on the executors' heap: a month of keys is more
    than a heap should hold. The session's own choice is put back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def raw_stream(spark: SparkSession, root: str) -> DataFrame:
    """Raw as a stream source: it is append-only, so each of its files is read once."""
    return spark.readStream.schema(RAW).parquet(f"{root.rstrip('/')}/raw")


def daily_counts(raw: DataFrame) -> DataFrame:
    """Additive counters per one-day window and namespace. State is one row per day and namespace, few enough to be
    kept for good, so no event is ever too late."""
    typed = type_records(raw, ["namespace_id", "changed_at_utc", "is_bot", "is_anonymous"])
    return (
        typed.groupBy(F.window("changed_at_utc", "1 day").alias("day"), "namespace_id")
        .agg(
            F.count("*").alias("total_changes"),
            F.count_if("is_bot").alias("bot_changes"),
            F.count_if("is_anonymous").alias("anonymous_changes"),
        )
        .select(
            F.to_date("day.start").alias("activity_date"),
            "namespace_id",
            "total_changes",
            "bot_changes",
            "anonymous_changes",
        )
    )


def maintain_daily_counts(spark: SparkSession, root: str, target: str, checkpoint: str) -> None:
    """Bring the counters in ``target`` up to date with raw, then stop.

    A micro-batch gives the counters it changed; only their dates' folders are written anew, the dates' other counters
    with them. Writing the same batch again gives the same folders.
    """

    def store(batch: DataFrame, _batch_id: int) -> None:
        scratch: list[str] = []
        try:
            changed = materialize(batch, "changed", spark, scratch)
            days = [r["activity_date"] for r in changed.select("activity_date").distinct().collect()]  # one per day touched
            if not days:
                return
            rows = changed
            if _exists(spark, target):
                held = spark.read.schema(changed.schema).parquet(target).filter(F.col("activity_date").isin(days))
                new = changed.select(F.col("activity_date").alias("_day"), F.col("namespace_id").alias("_namespace"))
                same = (F.col("activity_date") == F.col("_day")) & F.col("namespace_id").eqNullSafe(F.col("_namespace"))
                rows = held.join(new, same, "left_anti").unionByName(changed)
            rows = materialize(rows, "counts", spark, scratch)
            dated = rows.repartition("activity_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            dated.partitionBy("activity_date").parquet(target)
        finally:
            discard(spark, scratch)

    with state_on_disk(spark):
        query = (
            daily_counts(raw_stream(configure(spark), root))
            .writeStream.outputMode("update")
            .foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
