"""Insert-if-absent on append-only tables, and the counters of a load."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key. Map tasks keep one row per key before the shuffle, so a hot key is cheap."""
    position = F.row_number().over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")


def insert_if_absent(incoming: DataFrame, existing: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The rows an append must write so that each key is stored once and the first writer wins.

    Who wins is decided on keys and arrival alone, without payloads: the first arrival of each key, less the keys that
    the history holds. Of the history only the key column is read, and cut down to the incoming keys first, which a
    small load broadcasts of its own accord. The payload then moves once, to be joined with the winners; copies and
    known keys never move with theirs. ``order`` must tell the rows of a key apart.
    """
    first = first_per_key(incoming.select(key, *order), key, order)
    known = existing.select(key).join(first.select(key), key, "left_semi")
    return incoming.join(first.join(known, key, "left_anti"), [key, *order], "left_semi")


def in_ranges(existing: DataFrame, key: str, spans: Sequence[tuple]) -> DataFrame:
    """The part of ``existing`` that can hold keys of the ranges: row groups outside them are skipped unread."""
    tests = [F.col(key).between(low, high) for low, high in spans]
    return existing.filter(reduce(lambda a, b: a | b, tests, F.lit(False)))


def number_rows(df: DataFrame, id_column: str, first_id: int, order: Sequence[str], rows: int) -> DataFrame:
    """Ids that rise in arrival order, from ``first_id`` on, with gaps. Range partitioning keeps the order
    without a single-task sort, and splits a hot window over several files. ``rows`` bounds the number of rows: each
    partition gets that many ids."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # partition number above the lower 33 bits, place in the partition in them
    place = F.monotonically_increasing_id()
    partition, within = F.shiftrightunsigned(place, 33), place.bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn(id_column, F.lit(first_id) + partition * F.lit(rows).cast("long") + within)


def id_span(df: DataFrame, rows: int) -> int:
    """How many ids ``number_rows`` may use up at most for so many rows."""
    conf = df.sparkSession.conf
    partitions = max(
        int(conf.get("spark.sql.shuffle.partitions")),
        int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or 0),
    )
    return partitions * max(rows, 1)


def broken_constraints() -> Column:
    """Names of the constraints that a raw row breaks: a missing payload, window bound or load time, an empty window."""
    return F.array_compact(
        F.array(
            *[
                F.when(F.col(c).isNull(), F.lit(f"{c} not null"))
                for c in ("_raw", "_window_start", "_window_end", "_ingested_at")
            ],
            F.when(F.col("_window_start") >= F.col("_window_end"), F.lit("window order")),
        )
    )


def constraint_violations(raw: DataFrame, id_column: str = "_raw_id") -> DataFrame:
    """Rows that a raw table must refuse, and refuses when they are appended."""
    return raw.select(id_column, F.explode(broken_constraints()).alias("constraint"))


def load_stats(
    judged: DataFrame,
    inserted: DataFrame,
    quarantined: DataFrame,
    by: Sequence[str] = ("_window_start", "page_no"),
    pages: DataFrame | None = None,
) -> DataFrame:
    """Six additive counters per page: every input is counted where it lies, then one small shuffle adds up.

    ``duplicates`` are valid records that were not inserted; ``quarantined`` counts newly stored errors only.
    ``pages`` adds pages that held no record.
    """
    zero = F.lit(0)

    def part(df: DataFrame, **ones: Column | int) -> DataFrame:
        counters = {"fetched": zero, "valid": zero, "inserted": zero, "quarantined": zero, "outside_window": zero}
        counters.update({k: v if isinstance(v, Column) else F.lit(v) for k, v in ones.items()})
        return df.select(*by, *[c.cast("long").alias(n) for n, c in counters.items()])

    parts = part(judged, fetched=1, valid=F.col("status") == "ok", outside_window=F.col("status") == "outside_window")
    parts = parts.unionByName(part(inserted, inserted=1)).unionByName(part(quarantined, quarantined=1))
    if pages is not None:
        parts = parts.unionByName(part(pages))
    sums = parts.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("fetched", "valid", "inserted", "quarantined", "outside_window")]
    )
    return sums.select(
        *by,
        "fetched",
        "inserted",
        (F.col("valid") - F.col("inserted")).alias("duplicates"),
        "quarantined",
        "outside_window",
        F.lit(1).cast("long").alias("pages"),
    )


COUNTERS = ["fetched", "inserted", "duplicates", "quarantined", "outside_window", "pages"]


def total_stats(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The counters added up, per ``by`` or over everything."""
    return stats.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS])
