"""Which steps of a backfill are done, per window date and for which landed files.

A step counts as done for a date only together with a digest of the files that had landed for it, so a date whose landing
has changed since is open again, as is one whose run broke off before the step was noted.
"""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.digests import DIGEST, digests

LOAD, REFRESH, CHECK = STEPS = ("load", "refresh", "check")


def landing_digests(files: DataFrame) -> DataFrame:
    """A digest per window date of its landed files' names, lengths and times; their content is not read."""
    named = files.withColumn("name", F.element_at(F.split("path", "/"), -1))
    return digests(named, ["window_date"], ["name", "length", "modificationTime"])


def open_steps(spark: SparkSession, days: Sequence[date], inputs: DataFrame, done: DataFrame) -> DataFrame:
    """``window_date, step`` and the digest of the date's landing (NULL without one), for steps that ``done`` does not
    hold for that digest. A date without any landed file stays open."""
    asked = spark.createDataFrame([(d, list(STEPS)) for d in days], "window_date date, steps array<string>")
    wanted = asked.select("window_date", F.explode("steps").alias("step")).join(inputs, "window_date", "left")
    return wanted.join(done, ["window_date", "step", *DIGEST], "left_anti").select("window_date", "step", *DIGEST)
