"""Tables written to the folder that driver and executors share.

Iterative operators cut their lineage here.  A written table survives lost
executors and pins values that a recomputation could deal out differently.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode, if it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='poolspark-')}")
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; it is removed when the application ends."""
    path = f"{shared_dir(spark)}/poolspark-{uuid.uuid4().hex}-{label}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)  # deleteOnExit only registers what exists
    fs.deleteOnExit(hadoop)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{new_path(spark, label)}/table"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, label: str, buckets: int, column: str, sort: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder in buckets of ``column``, sorted inside by ``sort``, so a later join on it need not move it again.

    Buckets need an entry in the catalogue, which is dropped with the application; the files
    lie in the shared folder, never in the warehouse, and go with the others.
    """
    spark = df.sparkSession
    name = f"poolspark_{label}_{uuid.uuid4().hex}"
    path = f"{new_path(spark, label)}/table"
    write = df.write.option("compression", "zstd").option("path", path).bucketBy(buckets, column)
    (write.sortBy(*sort) if sort else write).saveAsTable(name)
    atexit.register(_forget, spark, name)
    return spark.table(name)


def _forget(spark: SparkSession, name: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone, and its catalogue with it
        spark.sql(f"DROP TABLE IF EXISTS {name}")
