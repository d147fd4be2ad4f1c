"""Running barcode counts and winner histograms over QC Parquet files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolspark.plans.shared import new_path
from poolspark.sources import tables


def barcode_counts(stream: DataFrame) -> DataFrame:
    return stream.groupBy("BC").agg(F.count("*").alias("n_rows"))


def quality_histogram(stream: DataFrame) -> DataFrame:
    return stream.groupBy("MAPQ").agg(F.count("*").alias("n_rows"))


def run(spark: SparkSession, folder: str, schema, aggregate=barcode_counts) -> DataFrame:
    """Everything in ``folder`` so far, by a stream that stops when it has caught up; the state lies on shared storage."""
    place = new_path(spark, "stream")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(folder)
    totals = aggregate(source)
    key, n = totals.columns

    def put(batch: DataFrame, epoch: int) -> None:
        # only the counts that the batch changed; an epoch that comes again replaces its own
        batch.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(f"{place}/changed")

    query = totals.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    if not tables.exists(spark, f"{place}/changed"):
        return spark.createDataFrame([], totals.schema)
    return spark.read.parquet(f"{place}/changed").groupBy(key).agg(F.max_by(n, "epoch").alias(n))


def run_to_end(table: DataFrame, aggregate=barcode_counts) -> DataFrame:
    """:func:`run` over a table that :func:`poolspark.plans.shared.materialize` wrote."""
    folder = table.inputFiles()[0].rsplit("/", 1)[0]
    return run(table.sparkSession, folder, table.schema, aggregate)
