"""Read groups whose alignments arrive in several files.

A read's alignments on the genomes come from different files, so a micro-batch may
hold a part of them only.  The state keeps the rows of an open (barcode, read)
group; a timer closes it when the watermark has passed its last row by ``delay``,
and the group goes on whole, once.  Rows that come later than the watermark are
dropped.  Rows without a barcode or a read belong to no group; they only move
the watermark, so a last file of such a row closes all groups.

A call of the state costs far more than a row, and groups are small and many, so
groups are dealt to ``BUCKETS`` keys of the state by a hash.  A bucket keeps its rows as
compressed Arrow batches and has one timer, for the first of its groups to close.

The state store must be RocksDB, which ``run`` sets for its stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from poolspark.operators import assign
from poolspark.plans.shared import new_path
from poolspark.sources import tables

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOSED = "Read string, BC string, Genome string, MAPQ short, as_ int, NM int, XAcount short, frag_loc string"

#: Keys of the state; a folder of state keeps the number it began with.
BUCKETS = 1024

HELD = pa.schema([("Read", pa.string()), ("BC", pa.string()), ("Genome", pa.string()), ("MAPQ", pa.int16()), ("as_", pa.int32()), ("NM", pa.int32()), ("XAcount", pa.int16()), ("frag_loc", pa.string()), ("ms", pa.int64())])
GROUP = ["Read", "BC"]


def _packed(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, HELD, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(rows)
    return out.getvalue().to_pybytes()


def _last(rows: pa.Table) -> pa.Table:
    """(Read, BC, ms_max) of each group."""
    return rows.group_by(GROUP).aggregate([("ms", "max")])


class OpenReads(StatefulProcessor):
    """The rows of a bucket's open groups, and when the first of them may close."""

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "part binary")
        self.due = handle.getValueState("due", "ms long")

    def _await(self, ms: int) -> None:
        self.due.update((ms,))
        self.handle.registerTimer(ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts, first = [], None
        for part in rows:
            own = pa.Table.from_pandas(part[HELD.names], HELD, preserve_index=False)
            own = own.filter(pc.and_(own["Read"].is_valid(), own["BC"].is_valid()))
            if own.num_rows:
                parts.append((_packed(own),))
                early = pc.min(own["ms"]).as_py() + self.delay_ms
                first = early if first is None else min(first, early)
        if parts:
            self.rows.appendList(parts)
            # not later than any of the bucket's groups may close; one that has later rows too stays open then
            if not self.due.exists() or first < self.due.get()[0]:
                self._await(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.due.exists() or expiredTimerInfo.getExpiryTimeInMs() != self.due.get()[0]:
            return  # another timer has come in its place
        held = pa.concat_tables([pa.ipc.open_stream(p[0]).read_all() for p in self.rows.get()])
        last = _last(held)
        over = pc.less_equal(pc.add(last["ms_max"], self.delay_ms), timerValues.getCurrentWatermarkInMs())
        still = last.filter(pc.invert(over))
        closed = held.join(last.filter(over).select(GROUP), GROUP, join_type="left semi") if still.num_rows else held
        if not still.num_rows:
            self.rows.clear()
            self.due.clear()
        else:
            if closed.num_rows:
                self.rows.put([(_packed(held.join(still.select(GROUP), GROUP, join_type="left semi")),)])
            self._await(pc.min(still["ms_max"]).as_py() + self.delay_ms)
        if closed.num_rows:
            yield closed.select(HELD.names[:-1]).to_pandas(types_mapper={pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype()}.get)


def closed_groups(stream: DataFrame, time: str, delay_seconds: int) -> DataFrame:
    """The rows of CLOSED of whole groups; ``time`` is the stream's event time."""
    seen = stream.withWatermark(time, "0 seconds").withColumns({"ms": F.unix_millis(time), "bucket": F.pmod(F.xxhash64(*GROUP), F.lit(BUCKETS))})
    return seen.groupBy("bucket").transformWithStateInPandas(OpenReads(1000 * delay_seconds), outputStructType=StructType.fromDDL(CLOSED), outputMode="append", timeMode="eventTime")


def run(spark: SparkSession, folder: str, schema: StructType, delay_seconds: int, place: str | None = None, time: str | None = None, files: int = 64) -> DataFrame:
    """Ranked reads, as ``assign.by_read`` gives them, of all groups that are closed when the stream has caught up with ``folder``.

    ``place`` holds state and output, so a later run goes on there.  Event time is the
    column ``time``, else the time at which a file was written.  A micro-batch takes up to ``files`` files.
    """
    place = place or new_path(spark, "groups")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
    source = source.withColumn("__at", F.col(time) if time else F.col("_metadata.file_modification_time"))

    def put(batch: DataFrame, batch_id: int) -> None:
        # a group comes whole, so each batch is ranked by itself; one that comes again replaces its rows
        own = assign.by_read(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{place}/reads")

    held = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    try:
        query = closed_groups(source, "__at", delay_seconds).writeStream.foreachBatch(put).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", held)
    columns = assign.by_read(spark.createDataFrame([], CLOSED)).schema
    path = f"{place}/reads"
    return spark.read.schema(columns).parquet(path).drop("batch_id") if tables.exists(spark, path) else spark.createDataFrame([], columns)
