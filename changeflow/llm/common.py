"""What the operators share: tables, fresh column names, words, and row-wise Arrow work on one column."""

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "[\\x20\\x09-\\x0D]+"
BLANK_CHARACTERS = " \t\n\x0b\f\r"

stored = materialize

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that Python work runs from any folder."""
    if spark.sparkContext.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="changeflow-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(spark.sparkContext.applicationId)


def arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores in front until no column of ``df`` has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Maximal runs of characters other than blanks; none for NULL. ``translate`` makes every blank a space first,
    so that splitting takes no regular expression beyond one literal character."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once; a plain reference would be evaluated again wherever it stands."""
    return F.element_at(F.transform(F.array(value), body), 1)


def map_column(
    df: DataFrame, column: str, schema: StructType, work: Callable[[list], list[pa.Array]], rows: int = 512
) -> DataFrame:
    """Columns of ``schema`` appended to ``df``; ``work`` makes them from a list of up to ``rows`` values of ``column``.

    Batches are cut into slices so that only a slice's values exist as Python objects at a time.
    """
    names = [f.name for f in schema.fields]
    kept = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                piece = batch.slice(start, rows)
                made = work(piece.column(kept.index(column)).to_pylist())
                yield pa.RecordBatch.from_arrays([*piece.columns, *made], names=[*kept, *names])

    return arrow(df, run, StructType([*df.schema.fields, *schema.fields]))



def ranked(df: DataFrame, group: str, order: list, purpose: str) -> DataFrame:
    """``df``, stored, with ``position`` (from 0, in ``order``) and ``total`` of its row within ``group``, which must not
    be NULL; NULLs of ``order`` come first.

    Rows are range-partitioned, so a group of any size is spread over tasks; what tells a partition where it starts is one
    row per partition and group. Rows equal in ``order`` may stand either way round.
    """
    tie, part, place, first, count, before = fresh(df, "tie", "part", "place", "first", "count", "before")
    keys = [group, *order, tie]
    placed = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the number of the partition stands above the lower 33 bits
    at = placed.withColumn(place, F.monotonically_increasing_id())
    at = stored(at.withColumn(part, F.shiftrightunsigned(place, 33)).drop(tie), purpose)
    runs = at.groupBy(part, group).agg(F.min(place).alias(first), F.count("*").alias(count))
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn(before, F.coalesce(F.sum(count).over(earlier), F.lit(0)))
    runs = runs.withColumn("total", F.sum(count).over(Window.partitionBy(group))).drop(count)
    joined = at.join(runs, [part, group]).withColumn("position", F.col(before) + F.col(place) - F.col(first))
    return joined.select(*df.columns, "position", "total")
