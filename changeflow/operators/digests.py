"""Digests of tables that do not depend on the order of rows, per day and for the whole, and an audit that descends by them.

A digest is the number of rows and the sums of two 64-bit hashes of each row. Digests of parts add up to that of the whole,
so a day's can be kept while rows are appended, and two snapshots are compared day by day before a single row is joined.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.operators.audits import append_only_audit, compare_runs

DIGEST = ["digest_rows", "digest_sum", "digest_salted_sum"]


def digests(rows: DataFrame, by: list[str], columns: list[str] | None = None) -> DataFrame:
    """The digest of the rows of each ``by``; of the whole table if that is empty."""
    hashed = sorted(columns or [c for c in rows.columns if c not in by])
    # hashing skips NULLs without a trace, so say which columns are NULL
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in hashed])
    plain, salted = F.xxhash64(*hashed, nulls), F.xxhash64(F.lit("salt"), nulls, *hashed)
    # sums of decimals are exact, where longs would overflow
    return rows.groupBy(*by).agg(
        F.count("*").alias(DIGEST[0]),
        F.sum(plain.cast("decimal(20,0)")).alias(DIGEST[1]),
        F.sum(salted.cast("decimal(20,0)")).alias(DIGEST[2]),
    )


def added(parts: DataFrame, by: list[str]) -> DataFrame:
    """Digests of parts as those of the wholes that they make."""
    return parts.groupBy(*by).agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in DIGEST])


def differing_days(before: DataFrame, after: DataFrame, day: str) -> list[date]:
    """Days whose digests differ or that one side lacks: at most one value per calendar day."""
    compared = compare_runs(before, after, [day], DIGEST).filter("not unchanged")
    return sorted(r[0] for r in compared.select(day).collect() if r[0] is not None)


def snapshot_drilldown(
    before: DataFrame, after: DataFrame, id_column: str, day: str, digests_before: DataFrame | None = None, digests_after: DataFrame | None = None
) -> DataFrame:
    """Rows of an earlier snapshot that a later one has changed or lost, with their day; days of equal digests are not read.

    Both snapshots must be partitioned by ``day``, which a row never changes. Digests that were kept spare reading a snapshot
    for them; without them a snapshot is scanned once, without any shuffle of rows, and only days that differ are joined.
    """
    columns = [c for c in before.columns if c != day]
    kept = [d if d is not None else digests(s, [day], columns) for d, s in ((digests_before, before), (digests_after, after))]
    days = differing_days(kept[0], kept[1], day)
    wrong = append_only_audit(before.filter(F.col(day).isin(days)), after.filter(F.col(day).isin(days)), id_column)
    return before.filter(F.col(day).isin(days)).select(id_column, day).join(wrong, id_column).select(day, id_column, "violation")
