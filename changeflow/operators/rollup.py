"""Daily rollup: one row per UTC date and namespace."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.numbers import rate
from changeflow.schemas import MART, NAMESPACE_LABELS

GRAIN = ["activity_date", "namespace_id"]
#: What the rollup reads of staging.
ROLLED = (
    "namespace_id change_type user_name changed_at_utc old_length new_length is_bot is_minor is_anonymous is_user_missing"
).split()


def namespace_name(namespace_id: Column) -> Column:
    """The label of a known namespace, ``Namespace <id>`` for others, NULL for NULL."""
    labels = F.create_map(*[F.lit(x) for pair in NAMESPACE_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, namespace_id), F.concat(F.lit("Namespace "), namespace_id.cast("string")))


def event_counts(staged: DataFrame, name: str = "expected_count") -> DataFrame:
    """Events per grain."""
    return staged.groupBy(F.to_date("changed_at_utc").alias("activity_date"), "namespace_id").agg(
        F.count("*").alias(name)
    )


#: Counters that add up over any division of a day's rows.
ADDITIVE = (
    "total_changes edit_count new_page_count log_count bot_changes anonymous_changes minor_changes missing_user_changes net_bytes_change"
).split()


def counters() -> list[Column]:
    """The additive counters of staged rows."""
    # NULL if one of the lengths is unknown
    byte_change = F.coalesce(F.col("new_length") - F.col("old_length"), F.lit(0))
    made = [
        F.count("*"),
        F.count_if(F.col("change_type") == "edit"),
        F.count_if(F.col("change_type") == "new"),
        F.count_if(F.col("change_type") == "log"),
        F.count_if("is_bot"),
        F.count_if("is_anonymous"),
        F.count_if("is_minor"),
        F.count_if("is_user_missing"),
        F.sum(byte_change),
    ]
    return [c.alias(name) for c, name in zip(made, ADDITIVE, strict=True)]


def finished(counted: DataFrame) -> DataFrame:
    """The mart's columns from its counters: the namespace's label and the rates."""
    return counted.withColumns(
        {
            "namespace_name": namespace_name(F.col("namespace_id")),
            "bot_rate": rate(F.col("bot_changes"), F.col("total_changes")),
            "anonymous_rate": rate(F.col("anonymous_changes"), F.col("total_changes")),
        }
    ).select(MART.fieldNames())


def daily_rollup(staged: DataFrame) -> DataFrame:
    """The mart. The condition on the distinct users sits inside the aggregate instead of in a FILTER, so rows
    are not expanded: partial sums per (grain, user) leave the map tasks, spread over users, then per grain."""
    named = F.count_distinct(F.when(~F.col("is_user_missing"), F.col("user_name"))).alias("unique_users")
    grain = staged.groupBy(F.to_date("changed_at_utc").alias("activity_date"), "namespace_id")
    return finished(grain.agg(*counters(), named))


# Twice to the fourteenth registers: a standard error of 0.8 percent, at most some 16 kB a sketch.
SKETCH_SIZE = 14


def user_sketches(staged: DataFrame) -> DataFrame:
    """A sketch of the users per grain beside the mart's exact count; unlike the count it can be added up."""
    named = F.when(~F.col("is_user_missing"), F.col("user_name"))
    grain = staged.groupBy(F.to_date("changed_at_utc").alias("activity_date"), "namespace_id")
    return grain.agg(F.hll_sketch_agg(named, F.lit(SKETCH_SIZE)).alias("users"))


def distinct_users(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """About how many different users each group of grains has, over namespaces and days; nobody is counted twice. Reads
    one sketch per grain and no staging rows."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("distinct_users"))
