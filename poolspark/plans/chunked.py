"""Scoring of reads by chunks of barcodes, which adds up over several runs and goes on after a lost one.

A folder holds the scored rows, one partition for each chunk.  Beside it, in
``<folder>.state``, lie the ranked reads sorted by chunk, so that a range of chunks
reads its own row groups only; how many reads each chunk has; the models, learned
once from all reads; and the manifest, a JSON note for each finished batch of chunks.
Scored rows are written with dynamic partition overwrite before their note, so a batch
that a lost run left half-written is written again and no other one is touched.

Jobs and files follow the number of reads, not that of chunks, which may be many
and small: a batch takes as many chunks as hold ``BATCH_READS`` reads together, and
the rows of a chunk are gathered before they are written.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import asdict

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from poolspark.config import AssignConfig
from poolspark.operators import assign, qc
from poolspark.plans.shared import materialize
from poolspark.sources import tables, workfolder

#: Reads of the chunks that one job scores, if no number of chunks is given; a lost run scores as many again.
BATCH_READS = 10_000_000


def _counted(seen: Observation) -> dict[str, int]:
    """The counters of a finished pass; none if the plan found that the table is empty and left the pass out."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return {}


class ChunkedScoring:
    """Chunks (BC, chunk_id) of alignments, scored into ``folder``.

    ``source`` names the state of the inputs.  The state of a folder belongs to one source and
    configuration; with another one it is an error, unless ``force`` starts anew.
    """

    def __init__(self, spark: SparkSession, folder: str, config: AssignConfig = AssignConfig(), source: str | None = "", force: bool = False):
        self.spark, self.folder, self.config, self.state = spark, folder.rstrip("/"), config, f"{folder.rstrip('/')}.state"
        if source is None:  # only what is there is asked for
            return
        self.key = hashlib.sha256(json.dumps([asdict(config), source], sort_keys=True, default=str).encode()).hexdigest()
        held = workfolder.read_json(spark, f"{self.state}/key.json")
        if held is not None and held["key"] != self.key:
            if not force:
                raise ValueError(f"{folder} holds chunks of another input or configuration")
            for path in (self.state, self.folder):
                workfolder.remove(spark, path)
            held = None
        if held is None:
            workfolder.write_json(spark, f"{self.state}/key.json", {"key": self.key})

    def _once(self, name: str, make) -> DataFrame:
        """A table of the state, written once; its note, with its columns and counters, is written last."""
        path, note = f"{self.state}/{name}", f"{self.state}/{name}.json"
        held = workfolder.read_json(self.spark, note)
        if held is None:
            rows, seen = make()
            rows.write.mode("overwrite").parquet(path)
            held = {"columns": rows.schema.jsonValue(), "seen": _counted(seen) if seen else {}}
            workfolder.write_json(self.spark, note, held)
        return self.spark.read.schema(StructType.fromJson(held["columns"])).parquet(path)

    def reads(self, rows: DataFrame | None = None, chunks: DataFrame | None = None) -> DataFrame:
        """Ranked reads with their chunk, sorted by barcode and read; written from ``rows`` and ``chunks`` the first time.

        Reads of barcodes without a chunk are left out of scoring, but models count them.
        A large barcode may span files, as ranges are of chunk, barcode and read.  Dealing by ranges looks at
        its rows twice, so they are ranked into a table before.
        """

        def make():
            if rows is None or chunks is None:
                raise ValueError("no reads are prepared yet")
            config, seen = self.config, None
            every = rows
            if not config.max_rows_per_genome:  # a cap looks at the rows before
                seen = Observation("filtered")
                every = rows.observe(seen, *qc.filter_counters(config.mapq_min, config.xa_max))
            kept = qc.cap_rows(qc.alignment_filter(every, config.mapq_min, config.xa_max), config.max_rows_per_genome)
            own = materialize(assign.by_read(kept), "ranked").join(chunks.select("BC", F.col("chunk_id").cast("long")), "BC", "left").withColumn("chunk_id", F.coalesce("chunk_id", F.lit(0).cast("long")))
            return own.repartitionByRange("chunk_id", "BC", "Read").sortWithinPartitions("chunk_id", "BC", "Read"), seen

        return self._once("reads", make)

    def sizes(self) -> dict[int, int]:
        """The number of reads of each chunk that has any, a few bytes each."""
        held = self._once("sizes", lambda: (self.reads().where("chunk_id > 0").groupBy("chunk_id").agg(F.count("*").alias("n")).coalesce(1), None))
        return {r["chunk_id"]: r["n"] for r in held.collect()}

    def filtered(self) -> dict[str, int]:
        """What the alignment filter kept and took away, counted in the pass that filtered; nothing of a capped run."""
        return workfolder.read_json(self.spark, f"{self.state}/reads.json")["seen"]

    def models(self, learn_edges: bool = True, learn_tails: bool = True) -> tuple[dict[str, list[float]], DataFrame]:
        """Edges and tail probabilities, learned once from all reads; without leave to learn, missing ones are an error."""
        for name, allowed in (("edges", learn_edges), ("tails", learn_tails)):
            if not allowed and not tables.exists(self.spark, f"{self.state}/{name}.json"):
                raise FileNotFoundError(f"no {name} in {self.state}")
        two = lambda: self._sampled(self.reads().drop("genomes", "chunk_id"))
        edges = self._once("edges", lambda: (assign.decile_edges(assign.winner_hist(two(), self.config), self.config).coalesce(1), None))
        cuts = assign.collect_edges(edges)
        tails = self._once("tails", lambda: (assign.tail_prob(assign.delta_hist(assign.best_two_delta(two()), cuts, self.config), self.config).coalesce(1), None))
        return cuts, tails

    def _sampled(self, two: DataFrame) -> DataFrame:
        n = self.config.sample_barcodes
        return qc.semi_barcodes(two, qc.sample_barcodes(two.select("BC"), n, self.config.seed)) if n else two

    def finished(self) -> dict[int, dict]:
        """The chunks of the manifest with their counts."""
        notes = workfolder.matches(self.spark, f"{self.state}/manifest/*.json")
        texts = self.spark.read.text(notes, wholetext=True).collect() if notes else []  # some tens of bytes for each chunk
        return {int(c): n for t in texts for c, n in json.loads(t["value"]).items()}

    def chunk_ids(self) -> list[int]:
        """All chunks that have reads."""
        return sorted(self.sizes())

    def score(self, span: str | None = None, batch: int | None = None, learn_edges: bool = True, learn_tails: bool = True) -> list[int]:
        """Score the chunks of ``span`` (START:END from 0, without END) that the manifest lacks; the chunks that were scored now.

        ``batch``: chunks that one job scores; without it, as many as hold ``BATCH_READS`` reads.
        """
        cuts, tails = self.models(learn_edges, learn_tails)
        first, last = qc.chunk_span(span) if span else (0, None)
        done = self.finished()
        todo = [c for c in self.chunk_ids() if first < c and (last is None or c <= last) and c not in done]
        for own in self._batches(todo, batch):
            self._score(own, cuts, tails)
        return todo

    def _batches(self, todo: list[int], batch: int | None) -> Iterator[list[int]]:
        sizes, own, reads = self.sizes(), [], 0
        for c in todo:
            if own and (len(own) == batch if batch else reads + sizes[c] > BATCH_READS):
                yield own
                own, reads = [], 0
            own.append(c)
            reads += sizes[c]
        if own:
            yield own

    def _rows(self, own: list[int], cuts: dict[str, list[float]], tails: DataFrame) -> DataFrame:
        first, last = (own[0], own[-1]) if own else (0, 0)
        raw = assign.assign_raw(self.reads().where(F.col("chunk_id").between(first, last) & F.col("chunk_id").isin(own)), cuts, tails, self.config)
        return assign.friend_rescue(assign.assign_filtered(raw, "chunk_id"), self.config.rescue_window)

    def _score(self, own: list[int], cuts: dict[str, list[float]], tails: DataFrame) -> None:
        rows = self._rows(own, cuts, tails).hint("rebalance", "chunk_id")  # the rescue leaves a chunk's rows in all tasks
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk_id").parquet(self.folder)
        paths = [f"{self.folder}/chunk_id={c}" for c in own]  # every chunk of ``own`` has reads, and every read a row
        per = self.spark.read.schema(rows.schema).option("basePath", self.folder).parquet(*paths).groupBy("chunk_id", "assigned_class").agg(F.count("*").alias("n")).collect()  # three for each chunk
        counts: dict[int, dict[str, int]] = {c: {} for c in own}
        for r in per:
            counts[r["chunk_id"]][r["assigned_class"]] = r["n"]
        workfolder.write_json(self.spark, f"{self.state}/manifest/{own[0]}-{own[-1]}-{hashlib.sha256(str(own).encode()).hexdigest()[:8]}.json", counts)

    def result(self, partly: bool = False) -> DataFrame:
        """The scored rows of the finished chunks; that chunks are missing is an error unless ``partly``."""
        done, every = self.finished(), self.chunk_ids()
        if not partly and (missing := [c for c in every if c not in done]):
            raise ValueError(f"{len(missing)} of {len(every)} chunks are not scored, the first is {missing[0]}")
        columns = self._rows([], *self.models()).schema
        if not done:
            return self.spark.createDataFrame([], columns).drop("chunk_id")
        rows = self.spark.read.schema(columns).parquet(self.folder)
        if len(done) < len(every):
            rows = rows.where(F.col("chunk_id").isin(sorted(done)))
        return rows.drop("chunk_id")


def finished_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a folder whose chunks are all scored, whatever its configuration."""
    return ChunkedScoring(spark, folder, source=None).result()
