"""Daily totals that only grow: what a load adds to a day is kept as rows that merge, and the mart is their sum.

Counters add up. Exact distinct users are bitmaps over the numbers that a day's dictionary gives its users, and merge by
bitwise or; numbers are dense, so a bitmap of 32,768 users takes 4 kB whatever their names. A load writes its own rows
alone and reads none of another one's, but for the dictionary of the days it touches.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.operators.rollup import ADDITIVE, GRAIN, counters, finished

DELTA = ["activity_date", "_load_id"]


def dated(staged: DataFrame) -> DataFrame:
    return staged.withColumn("activity_date", F.to_date("changed_at_utc"))


def day_counters(staged: DataFrame) -> DataFrame:
    """The counters that each load's rows add to a day and namespace."""
    return dated(staged).groupBy(*DELTA, "namespace_id").agg(*counters())


def day_names(staged: DataFrame) -> DataFrame:
    """Each day's users, once."""
    return dated(staged).filter(~F.col("is_user_missing")).select("activity_date", "user_name").distinct()


def new_numbers(names: DataFrame, held: DataFrame) -> DataFrame:
    """``activity_date, user_name, number`` for the names that ``held`` lacks, dense from each day's last number on.

    Names are numbered where they lie after the shuffle of the join: a partition's first number comes from the counts of the
    partitions before it, so no day passes through one task. ``names`` must be stored, as it is read twice.
    """
    lacking = names.join(held.select("activity_date", "user_name"), ["activity_date", "user_name"], "left_anti")
    spread = lacking.repartition("user_name").sortWithinPartitions("activity_date", "user_name")
    place = F.monotonically_increasing_id()
    return spread.withColumns({"_part": F.shiftrightunsigned(place, 33), "_place": place})


def dense(placed: DataFrame, held: DataFrame) -> DataFrame:
    """The numbers of ``new_numbers`` rows, which must be stored in between."""
    runs = placed.groupBy("activity_date", "_part").agg(F.count("*").alias("_names"), F.min("_place").alias("_first"))
    earlier = W.partitionBy("activity_date").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_names").over(earlier), F.lit(0)))
    last = held.groupBy("activity_date").agg(F.max("number").alias("_last"))
    runs = runs.join(last, "activity_date", "left")
    number = F.coalesce("_last", F.lit(0)) + F.col("_before") + F.col("_place") - F.col("_first") + 1
    return placed.join(runs, ["activity_date", "_part"]).select("activity_date", "user_name", number.alias("number"))


def day_users(staged: DataFrame, numbers: DataFrame) -> DataFrame:
    """The users that each load's rows bring to a day and namespace, as bitmaps."""
    seen = dated(staged).filter(~F.col("is_user_missing")).select(*DELTA, "namespace_id", "user_name").distinct()
    numbered = seen.join(numbers, ["activity_date", "user_name"])
    bucket, bit = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    return numbered.groupBy(*DELTA, "namespace_id", bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("users"))


def merged_counters(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*GRAIN).agg(*[F.sum(c).alias(c) for c in ADDITIVE])


def merged_users(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*GRAIN, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def mart_of(counter_deltas: DataFrame, user_deltas: DataFrame) -> DataFrame:
    """The mart, from deltas in any order and any division."""
    distinct = merged_users(user_deltas).groupBy(*GRAIN).agg(F.sum(F.bitmap_count("users")).alias("unique_users"))
    users = distinct.select(F.col("activity_date").alias("_day"), F.col("namespace_id").alias("_namespace"), "unique_users")
    same = (F.col("activity_date") == F.col("_day")) & F.col("namespace_id").eqNullSafe(F.col("_namespace"))
    joined = merged_counters(counter_deltas).join(users, same, "left")
    return finished(joined.withColumn("unique_users", F.coalesce("unique_users", F.lit(0))))
