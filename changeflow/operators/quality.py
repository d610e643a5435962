"""Data-quality checks on any table. A check is a DataFrame of violations; zero rows means pass."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.operators.rollup import GRAIN, event_counts
from changeflow.schemas import CHANGE_TYPES

NON_NEGATIVE = [
    "total_changes",
    "edit_count",
    "new_page_count",
    "log_count",
    "bot_changes",
    "anonymous_changes",
    "minor_changes",
    "missing_user_changes",
    "unique_users",
]
UNIT_RATES = ["bot_rate", "anonymous_rate"]

RAW_REQUIRED = ["_raw", "_window_start", "_window_end"]
STAGING_REQUIRED = ["change_id", "changed_at_utc", "namespace_id", "change_type"]
MART_REQUIRED = ["activity_date", "namespace_id", "namespace_name", "total_changes"]


def not_null(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per missing value: the ``keep`` columns and the name of the empty column. One pass."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.select(*keep, F.explode(missing).alias("null_column"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Checked and missing values per column, from one aggregate."""
    counts = df.agg(F.count("*").alias("checked"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot("checked", list(columns), "column_name", "violations").select(
        "column_name", "checked", "violations"
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; missing values do not count."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their row counts; a missing value passes."""
    return (
        df.filter(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value_field"))
        .agg(F.count("*").alias("n_records"))
    )


def grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations held by more than one row; missing key parts are a value like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def _outside(time: str, start: str, end: str) -> Column:
    return (F.col(time) < F.col(start)) | (F.col(time) >= F.col(end))


def inside_window(
    df: DataFrame,
    keep: Sequence[str] = ("change_id",),
    time: str = "changed_at_utc",
    start: str = "_window_start",
    end: str = "_window_end",
) -> DataFrame:
    """Events outside their half-open window; a missing time passes."""
    return df.filter(_outside(time, start, end)).select(*keep, time, start, end)


def _out_of_range(non_negative: Sequence[str], unit_interval: Sequence[str]) -> Column:
    tests = [F.col(c) < 0 for c in [*non_negative, *unit_interval]] + [F.col(c) > 1 for c in unit_interval]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def ranges(
    df: DataFrame, non_negative: Sequence[str] = NON_NEGATIVE, unit_interval: Sequence[str] = UNIT_RATES
) -> DataFrame:
    """Rows with a negative measure or a rate outside [0, 1]; missing values pass."""
    return df.filter(_out_of_range(non_negative, unit_interval))


def reconcile(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    expected_value: str,
    actual_value: str,
    null_safe_keys: bool = False,
) -> DataFrame:
    """Keys whose values differ between two relations, or that only one of them holds.

    By default a key with a missing part matches nothing, so it shows once per side.
    """
    left = expected.select(*[F.col(k).alias(f"_l_{k}") for k in keys], expected_value)
    right = actual.select(*[F.col(k).alias(f"_r_{k}") for k in keys], actual_value)
    pairs = [(F.col(f"_l_{k}"), F.col(f"_r_{k}")) for k in keys]
    same = reduce(lambda a, b: a & b, [x.eqNullSafe(y) if null_safe_keys else x == y for x, y in pairs])
    return (
        left.join(right, same, "full_outer")
        .filter(~F.col(expected_value).eqNullSafe(F.col(actual_value)))
        .select(*[F.coalesce(x, y).alias(k) for k, (x, y) in zip(keys, pairs, strict=True)], expected_value, actual_value)
    )


def staging_mart_reconciliation(staged: DataFrame, mart: DataFrame, null_safe_keys: bool = False) -> DataFrame:
    actual = mart.withColumnRenamed("total_changes", "actual_count")
    return reconcile(event_counts(staged), actual, GRAIN, "expected_count", "actual_count", null_safe_keys)


def quality_report(raw: DataFrame, staged: DataFrame, mart: DataFrame, raw_required: Sequence[str] = RAW_REQUIRED) -> DataFrame:
    """All seventeen checks: name, relation, number of violations, passed.

    Row-level checks share one aggregate per relation, whatever their number; only the grouped ones (unique
    key, grain, reconciliation) need a shuffle of their own.
    """

    def nulls(columns: Sequence[str]) -> dict[str, Column]:
        return {f"not_null {c}": F.count_if(F.col(c).isNull()) for c in columns}

    def one_pass(relation: str, df: DataFrame, checks: dict[str, Column]) -> DataFrame:
        counted = df.agg(*[c.cast("long").alias(n) for n, c in checks.items()])
        return counted.unpivot([], list(checks), "check", "violations").select(
            F.lit(relation).alias("relation"), "check", "violations"
        )

    def grouped(relation: str, check: str, violations: DataFrame) -> DataFrame:
        return violations.agg(F.count("*").alias("violations")).select(
            F.lit(relation).alias("relation"), F.lit(check).alias("check"), "violations"
        )

    bad_type = F.when(~F.col("change_type").isin(CHANGE_TYPES), F.col("change_type"))
    parts = [
        one_pass("raw", raw, nulls(raw_required)),
        one_pass(
            "staging",
            staged,
            nulls(STAGING_REQUIRED)
            | {
                "accepted_values change_type": F.count_distinct(bad_type),
                "event inside window": F.count_if(
                    F.coalesce(_outside("changed_at_utc", "_window_start", "_window_end"), F.lit(False))
                ),
            },
        ),
        grouped("staging", "unique change_id", unique(staged, "change_id")),
        one_pass(
            "mart",
            mart,
            nulls(MART_REQUIRED) | {"non-negative metrics": F.count_if(_out_of_range(NON_NEGATIVE, UNIT_RATES))},
        ),
        grouped("mart", "daily grain", grain(mart, GRAIN)),
        grouped("mart", "staging mart reconciliation", staging_mart_reconciliation(staged, mart)),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("violations") == 0)


class QualityError(RuntimeError):
    pass


def require_quality(report: DataFrame) -> None:
    """Fail the run if a check has violations. The report has one row per check, so it may be collected."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        raise QualityError(", ".join(f"{r['relation']}: {r['check']} ({r['violations']})" for r in failed))
