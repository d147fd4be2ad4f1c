"""Edges and tail probabilities from counts that add up over batches of reads.

The state is one table of counts (metric, value, delta bin), partitioned by batch
id: both models follow from it, whatever the number of reads and in a single
pass over them.  A batch that comes again replaces its own partition, so it
counts once; a stream that starts anew after a failure goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolspark.config import AssignConfig
from poolspark.operators import assign
from poolspark.sources import tables, workfolder

COLUMNS = "metric string, value int, bin int, n long, batch_id long"


def counts(two: DataFrame, config: AssignConfig = AssignConfig()) -> DataFrame:
    """(metric, value, bin, n): reads by the best genome's value and the bin of its lead, null where there is no lead or a negative one.

    Values are whole numbers, so the table has some thousands of rows.
    """
    reads, parts = assign.with_deltas(two), []
    for metric, c, d, (lo, hi, bins) in assign.delta_specs(config):
        lead = F.when(F.col(d) >= lo, F.least(assign.bin_of(F.col(d), lo, hi, bins), F.lit(bins)))
        led = F.when(F.col("g2").isNotNull(), lead)
        parts.append(reads.select(F.lit(metric).alias("metric"), F.col(c).cast("int").alias("value"), led.cast("int").alias("bin")))
    return parts[0].unionByName(parts[1]).groupBy("metric", "value", "bin").agg(F.count("*").alias("n"))


def edges_of(state: DataFrame, config: AssignConfig = AssignConfig()) -> DataFrame:
    """(metric, edge) as ``decile_edges`` of all reads in the state."""
    n = F.col("n")
    hist = None
    for metric, (lo, hi, bins) in (("as", config.as_bins), ("mapq", config.mapq_bins)):
        x = F.col("value")
        own = state.where((F.col("metric") == metric) & (x >= lo) & (x <= hi)).select("metric", F.least(assign.bin_of(x, lo, hi, bins), F.lit(bins - 1)).alias("bin"), n)
        hist = own if hist is None else hist.unionByName(own)
    return assign.decile_edges(hist.groupBy("metric", "bin").agg(F.sum("n").alias("n")), config)


def tails_of(state: DataFrame, edges: dict[str, list[float]], config: AssignConfig = AssignConfig()) -> DataFrame:
    """(metric, decile, bin, p) as ``tail_prob`` of all reads in the state."""
    of = F.when(F.col("metric") == "as", assign.decile(F.col("value"), edges["as"], config.k)).otherwise(assign.decile(F.col("value"), edges["mapq"], config.k))
    hist = state.where("bin IS NOT NULL").groupBy("metric", of.alias("decile"), "bin").agg(F.sum("n").alias("n"))
    return assign.tail_prob(hist, config)


class ModelState:
    """Counts of batches in a folder, and the models of all of them together."""

    def __init__(self, spark: SparkSession, folder: str, config: AssignConfig = AssignConfig()):
        self.spark, self.folder, self.config = spark, folder.rstrip("/"), config

    def add(self, two: DataFrame, batch_id: int) -> None:
        """Best, second and worst genome of a batch's reads; a batch that is there already is replaced."""
        own = counts(two, self.config).withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        if own.isEmpty():
            workfolder.remove(self.spark, f"{self.folder}/counts/batch_id={int(batch_id)}")
            return
        own.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{self.folder}/counts")

    def counts(self) -> DataFrame:
        path = f"{self.folder}/counts"
        return self.spark.read.schema(COLUMNS).parquet(path) if tables.exists(self.spark, path) else self.spark.createDataFrame([], COLUMNS)

    def models(self) -> tuple[DataFrame, DataFrame]:
        """Edges and tails of the batches so far."""
        edges = edges_of(self.counts(), self.config)
        return edges, tails_of(self.counts(), assign.collect_edges(edges), self.config)

    def save(self, path: str) -> None:
        tables.save_model(*self.models(), path)

    def follow(self, reads: DataFrame, checkpoint: str):
        """A running query that adds every micro-batch of ranked reads."""
        return reads.writeStream.foreachBatch(lambda df, i: self.add(df, i)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
