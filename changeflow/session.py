"""Session settings the operators rely on, and the shared scratch folder for cut lineage."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin what changes results: UTC dates, and last-one-wins for repeated JSON keys in fingerprints."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only a local session, whose executors share the driver's disk, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="changeflow-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, purpose: str, spark: SparkSession | None = None, scratch: list[str] | None = None
) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, columns stay prunable.

    The folder's path is added to ``scratch``, for ``discard`` when nothing reads it any more.
    """
    spark = spark or df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    if scratch is not None:
        scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, scratch: list[str]) -> None:
    """Delete stored intermediate tables that this package wrote."""
    for text in scratch:
        path = spark._jvm.org.apache.hadoop.fs.Path(text)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    scratch.clear()
