"""Registered queries of the read-assignment operators, on alignment-shaped views of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from poolspark import testkit
from poolspark.config import DecontamConfig, MergeConfig
from poolspark.functions import barcode
from poolspark.operators import assign as A
from poolspark.operators import decontam as D
from poolspark.operators import genotype as G
from poolspark.operators import qc as Q
from poolspark.operators import reports as R
from poolspark.oracle import ORACLE_SQL as _SQL
from poolspark.plans import chunked
from poolspark.plans.shared import materialize, new_path
from poolspark.schema import QC
from poolspark.sources import bam, tables
from poolspark.streaming import groups, models

TWO = ("Read", "BC", "g1", "as1", "mq1", "nm1", "g2", "as2", "mq2", "nm2", "gl", "asl", "mql", "nml", "n_genomes")
ROW = ("Read", "BC", "Genome", "MAPQ", "as_", "NM", "XAcount")
POOL = ["g0", "g2", "g4"]


class Views:
    """The stages over one data directory, each made when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    @cached_property
    def qc(self) -> DataFrame:
        return testkit.qc(self.spark, self.dir)

    def by_genome(self, *columns: str) -> DataFrame:
        """Rows dealt out by genome in one pass over the inputs, so that each genome's table is read alone."""
        own = self.qc.select("Genome", *columns) if columns else self.qc
        path = f"{new_path(self.spark, 'by-genome')}/rows"
        own.write.option("compression", "zstd").partitionBy("Genome").parquet(path)
        return self.spark.read.schema(own.schema).parquet(path).select(own.columns)

    @cached_property
    def assignment(self) -> A.Assignment:
        return A.Assignment(self.qc.drop("BC_raw"))

    @cached_property
    def raw(self) -> DataFrame:
        return self.assignment.raw()

    @cached_property
    def chunks(self) -> DataFrame:
        return Q.barcode_chunks(Q.distinct_barcodes(self.qc), 100)

    @cached_property
    def assigned(self) -> DataFrame:
        """Written once: the later stages read it several times."""
        return materialize(self.assignment.result(), "assign")

    @cached_property
    def reduced(self) -> DataFrame:
        return G.reduce_per_genome(G.from_assign(self.assignment.result()))

    @cached_property
    def post(self) -> DataFrame:
        return G.posteriors(self.reduced)

    @cached_property
    def mass(self) -> DataFrame:
        """From the written profiles, so what is asked of barcodes does not go back to the reads."""
        return self.genotyping.mass

    @cached_property
    def reads(self) -> DataFrame:
        return self.genotyping.reads

    @cached_property
    def top(self) -> DataFrame:
        return G.topk_genomes(self.mass, 3)

    @cached_property
    def genotyping(self) -> G.Genotyping:
        """Straight from the scored reads, which it reads once; where classes weigh the same, Spark drops the rescue behind them."""
        return G.Genotyping(self.assignment.result(), MergeConfig())

    @cached_property
    def eta0(self) -> dict[str, float]:
        g = self.genotyping
        return G.eta_of(g.mass, G.eta_initial_seed(g.mass, g.reads), g.genomes)

    @cached_property
    def sigs(self) -> DataFrame:
        g = self.genotyping
        return G.signatures(g.post, g.eta(), G.topk_genomes(g.mass, 3), 3)

    @cached_property
    def simple_calls(self) -> DataFrame:
        """Calls from the composition alone: barcode, call, model, genome_1, genome_2."""
        best = self.top.groupBy("barcode").agg(*[F.max(F.when(F.col("rank") == k, F.col("genome"))).alias(f"genome_{k}") for k in (1, 2)])
        s = G.barcode_stats(self.mass).join(self.reads, "barcode").join(best, "barcode")
        pick = lambda low, one, two, other: F.when(F.col("n_reads") < 5, low).when(F.col("p_top1") >= 0.6, one).when(F.col("p_top2") >= 0.2, two).otherwise(other)
        return s.select("barcode", pick("low_reads", "single_clean", "doublet", "ambiguous").alias("call"), pick(None, "single", "doublet", "single").alias("model"), "genome_1", "genome_2")

    @cached_property
    def design(self) -> DataFrame:
        return testkit.design(self.spark, self.dir)

    @cached_property
    def rules(self) -> DataFrame:
        return materialize(D.policy(self.simple_calls, self.design), "rules")

    @cached_property
    def gt(self) -> DataFrame:
        keys = G.from_assign(self.assigned).columns
        return self.assigned.select(F.col("BC").alias("barcode"), F.col("Read").alias("read_id"), F.col("Genome").alias("genome"), "as_", F.col("MAPQ").alias("mapq"), F.col("NM").alias("nm"), F.col("XAcount").alias("xa"), F.col("assigned_class").alias("cls"), "p_as").select(*keys, "p_as")

    @cached_property
    def judged(self) -> DataFrame:
        return D.judged(self.gt, self.rules, DecontamConfig(decontam_alpha=0.5))

    @cached_property
    def composition(self) -> DataFrame:
        return D.composition(D.counts(self.judged, "pre"), self.rules)

    @cached_property
    def gate(self) -> DataFrame:
        return D.postclean_gate(D.counts(self.judged, "post"), self.rules, DecontamConfig(min_reads_post_clean=5))

    @cached_property
    def winners(self) -> DataFrame:
        """Straight from the scored reads: the rescue gives no winners, and Spark drops it."""
        return R.winner_reads(self.assignment.result())

    @cached_property
    def all_winners(self) -> DataFrame:
        """As the comparison of samples takes them, whatever other hits they have."""
        return R.winner_reads(self.assignment.result(), xa_max=-1)

    @cached_property
    def winner_counts(self) -> DataFrame:
        """Written once: means and rates come from these counts, not from the reads."""
        return materialize(R.genome_counts(self.winners), "winner-counts")

    @cached_property
    def as_mean(self) -> DataFrame:
        """Written once: a row for each barcode, which rates and groups read again."""
        return materialize(R.as_mean_assign(self.winner_counts), "as-mean")

    @cached_property
    def rates(self) -> DataFrame:
        return materialize(R.contamination_rate(self.winner_counts, self.as_mean), "rates")

    @cached_property
    def groups(self) -> DataFrame:
        return R.low_high(self.rates, self.as_mean, 0.2)

    @cached_property
    def samples(self) -> DataFrame:
        return testkit.samples(self.spark, self.dir)

    @cached_property
    def stats(self) -> DataFrame:
        return R.sample_stats(self.rates, self.samples)


def _tables(rows: DataFrame) -> dict[str, DataFrame]:
    return {f"G{i}": rows.where(F.col("Genome") == f"G{i}").drop("Genome") for i in range(5)}


def _policies(v: Views) -> DataFrame:
    """Decisions on the calls of all barcodes, and on a few that have every other kind of call."""
    calls, out = v.simple_calls.unionByName(testkit.calls_fix(v.spark), allowMissingColumns=True), None
    for name, design, config in (
        ("strict", v.design, DecontamConfig()), ("rescue", v.design, DecontamConfig(strict_design=False, ambiguous_policy="top12_rescue", weak_doublet_policy="top12")),
        ("free", None, DecontamConfig(ambiguous_policy="top12_rescue", weak_doublet_policy="top12")), ("free_default", None, DecontamConfig()),
    ):
        one = D.policy(calls, design, config).withColumn("allowed_set", F.array_join("allowed", ",")).drop("allowed").withColumn("variant", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def _phi_chi(v: Views) -> DataFrame:
    g = v.genotyping
    phi = G.phi_matrix(g.mass, g.reads, g.genomes, MergeConfig(xmap_phi_min_reads=10))
    return phi.join(G.chi(phi).withColumnRenamed("genome", "anchor"), "anchor")


def _jsd_seed(v: Views) -> DataFrame:
    return G.jsd_seed(v.genotyping.mass, v.genotyping.reads, v.eta0)


def _soft(v: Views) -> DataFrame:
    g = v.genotyping
    top = G.topk_genomes(g.mass, 3)
    soft = G.posteriors(v.reduced, MergeConfig(winner_only=False))
    return G.criteria(G.signatures(soft, g.eta(), top, 3, soft=True), top).select("barcode", "n_reads", "n_reads_eff", "single.bic", "single.c", "single.i")


def _tsv(v: Views) -> DataFrame:
    path = f"{new_path(v.spark, 'tsv')}/rows"
    tables.write_tsv(v.assignment.filtered.select("Read", "BC", "MAPQ", "as_", "NM", "XAcount", "frag_loc"), path)
    return tables.read_qc_tsv(v.spark, path)


def _bam(v: Views) -> DataFrame:
    """All rows, by way of one BAM folder for each genome."""
    path, back, rows = new_path(v.spark, "bam"), {}, v.by_genome()
    cores = v.spark.sparkContext.defaultParallelism
    for g, n in sorted(map(tuple, rows.where("Genome IS NOT NULL").groupBy("Genome").count().collect())):  # a file is one task when it is read
        files = max(min(cores, -(-n // 10_000)), -(-n // 1_000_000))
        bam.write_bam(rows.where(F.col("Genome") == g).repartition(files, "Read"), f"{path}/{g}")
        back[g] = bam.read_bam(v.spark, f"{path}/{g}").drop("flag")
    return Q.union_genomes(back)


def _one_scan(v: Views) -> DataFrame:
    """The rows of all genomes' tables in a folder, read at once."""
    folder = new_path(v.spark, "filtered")
    for g in sorted(r[0] for r in v.qc.select("Genome").distinct().collect()):
        tables.write_sorted(v.qc.where(F.col("Genome") == g).select(*QC.fieldNames()), f"{folder}/filtered_{g}_QCMapping.parquet")
    return tables.read_genomes(v.spark, folder)


def _quarantine(v: Views) -> DataFrame:
    """Good and bad lines of assign rows as text, where the lines of some reads lack their last fields."""
    folder, own = f"{new_path(v.spark, 'texts')}/rows", v.assigned.select("BC", "Read", "Genome", "as_")
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in own.columns]
    line = F.when(F.col("Read").like("%0"), F.concat_ws("\t", *cells[:2])).otherwise(F.concat_ws("\t", *cells))
    head = v.spark.createDataFrame([("\t".join(own.columns),)], "value string")
    own.select(line.alias("value")).repartition(4).mapInPandas(_headed("\t".join(own.columns)), head.schema).write.text(folder)
    seen = tables.read_checked(v.spark, [p for p in tables._files(v.spark, folder) if "part-" in p], ("BC", "Read", "Genome"))
    return seen.rows.select(F.lit("good").alias("kind"), "Read").unionByName(seen.bad_lines.select(F.lit("bad").alias("kind"), F.split_part("line", F.lit("\t"), F.lit(2)).alias("Read"))).groupBy("kind", "Read").agg(F.count("*").alias("n"))


def _headed(header: str):
    """Lines of a partition under a header."""

    def run(parts):
        yield pd.DataFrame({"value": [header]})
        yield from parts

    return run


def _by_chunks(v: Views) -> DataFrame:
    """Scored in two ranges that add up in one folder."""
    own = chunked.ChunkedScoring(v.spark, f"{new_path(v.spark, 'chunked')}/scored")
    own.reads(v.qc.drop("BC_raw"), v.chunks)
    own.score("0:1")
    own.score()
    return own.result()


def _merged_models(v: Views) -> DataFrame:
    """Tail probabilities from counts of four batches, one of which comes twice."""
    state = models.ModelState(v.spark, f"{new_path(v.spark, 'model')}/state", v.assignment.config)
    part = lambda i: v.assignment.two.where(F.pmod(F.xxhash64("Read"), F.lit(4)) == i)
    for i in (0, 1, 2, 1, 3):
        state.add(part(i), i)
    return state.models()[1]


def _filter_counts(v: Views) -> DataFrame:
    """Counters of the alignment filter, gathered while its rows are written."""
    seen, c = Observation(), v.assignment.config
    materialize(Q.alignment_filter(v.qc.observe(seen, *Q.filter_counters(c.mapq_min, c.xa_max)), c.mapq_min, c.xa_max), "filtered")
    return v.spark.createDataFrame(sorted(seen.get.items()), "counter string, n long")


def _streamed_reads(v: Views) -> DataFrame:
    """Groups of alignments that come in four files, by the genome and by the read, and a last row that closes them."""
    path = f"{new_path(v.spark, 'arrivals')}/rows"
    batch = F.pmod(F.xxhash64("Read", "Genome"), F.lit(4))
    rows = v.assignment.filtered.where("BC <> '' AND Read <> ''").select("Read", "BC", "Genome", "MAPQ", "as_", "NM", "XAcount", "frag_loc")
    end = v.spark.createDataFrame([(None,) * 8], rows.schema).withColumn("batch", F.lit(1000).cast("long"))
    timed = materialize(rows.withColumn("batch", batch), "arriving").unionByName(end).withColumn("at", F.timestamp_seconds(1_700_000_000 + F.col("batch") * 60))
    for i in (0, 1, 2, 3, 1000):  # files are taken up in the order in which they were written
        timed.where(F.col("batch") == i).drop("batch").write.mode("append").parquet(path)
    return groups.run(v.spark, path, timed.drop("batch").schema, 600, time="at")


def _stream(v: Views) -> DataFrame:
    from poolspark.streaming import counts

    return counts.run_to_end(materialize(v.qc.select("BC"), "stream-in"))


_MAKE: dict[str, Callable[[Views], DataFrame]] = {
    "bc_normalize": lambda v: v.qc.groupBy("BC_raw").agg(F.count("*").alias("n")).select("BC_raw", barcode.normalized(F.col("BC_raw"), " pool 1").alias("bc_norm"), "n"),
    "bc_freq_filter": lambda v: Q.frequent_barcodes(v.qc.drop("BC", "Genome").withColumnRenamed("BC_raw", "BC"), 30, "pool 1"),
    "distinct_barcodes": lambda v: Q.distinct_barcodes(*_tables(v.by_genome("BC")).values()),
    "barcode_chunks": lambda v: v.chunks,
    "union_genomes": lambda v: Q.union_genomes(_tables(v.by_genome("Read"))).groupBy("Genome").agg(F.count("*").alias("n_rows"), F.count_distinct("Read").alias("n_reads")),
    "genomes_one_scan": lambda v: _one_scan(v).select("Genome", *QC.fieldNames()),
    "quarantined_lines": _quarantine,
    "alignment_filter": lambda v: v.assignment.filtered.select(*ROW),
    "semi_ambiguous_bcs": lambda v: Q.semi_barcodes(v.assignment.filtered, v.raw.where("assigned_class = 'ambiguous'").select("BC")).select("Read", "BC", "Genome", "as_"),
    "dedup_read_genome": lambda v: A.dedup_read_genome(v.assignment.filtered).select(*ROW, "frag_loc"),
    "rank_genomes": lambda v: A.rank_genomes(A.dedup_read_genome(v.assignment.filtered)).select("Read", "BC", "Genome", "rk", "rk_worst", "n_genomes"),
    "best_two_worst": lambda v: v.assignment.two.select(*TWO),
    "best_two_delta": lambda v: A.best_two_delta(v.assignment.two).select("Read", "BC", "as1", "mq1", "d_as", "d_mq", "d_nm"),
    "winner_hist": lambda v: v.assignment.hist(),
    "decile_edges": lambda v: A.decile_edges(v.assignment.hist()),
    "delta_hist": lambda v: v.assignment.deltas(v.assignment.edges()),
    "tail_prob": lambda v: A.tail_prob(v.assignment.deltas(v.assignment.edges())),
    "assign_raw": lambda v: v.raw.select(*TWO, "d_as", "d_mq", "d_nm", "decile_as", "decile_mapq", "p_as", "p_mq", "assigned_class"),
    "assign_filtered": lambda v: A.assign_filtered(v.raw),
    "friend_rescue": lambda v: v.assignment.result(),
    "tail_prob_merged": _merged_models,
    "assign_by_chunks": _by_chunks,
    "filter_counts": _filter_counts,
    "assign_stats": lambda v: A.assign_stats(v.raw, v.chunks),
    "reduce_per_genome": lambda v: v.reduced,
    "gt_read_quality": lambda v: G.read_quality(v.reduced, 30, 1),
    "promiscuous_filter": lambda v: G.promiscuous(v.reduced, 1, 6, 500),
    "winner_only_posterior": lambda v: v.post,
    "softmax_posterior": lambda v: G.posteriors(v.reduced, MergeConfig(winner_only=False)),
    "mass_by_genome": lambda v: G.mass_by_genome(v.post),
    "mass_pivot": lambda v: G.mass_pivot(v.mass, [f"G{i}" for i in range(5)]),
    "n_reads": lambda v: G.n_reads(v.post),
    "topk_genomes": lambda v: v.top,
    "topk_restrict": lambda v: G.topk_restrict(v.reduced, v.top.where("rank <= 2")),
    "reclass_topk": lambda v: G.reclass_topk(G.topk_restrict(v.reduced, v.top.where("rank <= 2"))),
    "eta_initial_seed": lambda v: G.eta_initial_seed(v.mass, v.reads),
    "eta_seeded": lambda v: G.eta_table(v.spark, v.eta0),
    "eta_learned": lambda v: G.eta_table(v.spark, v.genotyping.eta()),
    "jsd_to_eta": lambda v: G.jsd_to_eta(v.genotyping.mass, v.eta0),
    "jsd_seed": _jsd_seed,
    "phi_chi": _phi_chi,
    "barcode_stats": lambda v: G.barcode_stats(v.mass),
    "winner_discount": lambda v: G.winner_discount(v.post),
    "bic_empty": lambda v: G.bic_empty(v.sigs).select("barcode", "n_reads", "bic_empty"),
    "bic_single_grid": lambda v: G.bic_single(v.sigs, v.top).select("barcode", "single.bic", "single.c", "single.i"),
    "bic_doublet_grid": lambda v: G.bic_doublet(G._with_k(v.sigs, v.top)).where("doublet.bic is not null").select("barcode", "doublet.bic", "doublet.c", "doublet.d", "doublet.i", "doublet.j"),
    "call_decision": lambda v: v.genotyping.calls(),
    "design_expected": lambda v: D.with_expected(v.simple_calls, v.design).select("barcode", "bc_key", "call", "expected_genome"),
    "policy_allowed_set": _policies,
    "decontam_winner": lambda v: D.winners(v.gt).drop("xa"),
    "safe_keep": lambda v: D.safe_keep(v.gt, v.rules, DecontamConfig(safe_keep_delta_as=5, safe_keep_mapq_min=25, safe_keep_nm_max=3)),
    "reads_to_drop": lambda v: D.drop_list(v.judged),
    "pre_counts": lambda v: D.counts(v.judged, "pre"),
    "post_counts": lambda v: D.counts(v.judged, "post"),
    "barnyard_composition": lambda v: v.composition,
    "contamination_bins": lambda v: D.contamination_bins(v.composition),
    "postclean_gate": lambda v: v.gate,
    "calls_decontam": lambda v: D.calls_decontam(v.simple_calls, v.rules, v.gate),
    "clean_anti": lambda v: D.clean(v.qc, D.drop_list(v.judged)).select("Read", "BC", "Genome", "as_"),
    "as_mean_assign": lambda v: v.as_mean,
    "contamination_rate": lambda v: v.rates,
    "pass_barcodes": lambda v: R.pass_barcodes(v.as_mean, POOL),
    "reads_to_discard": lambda v: R.reads_to_discard(v.winners, v.as_mean),
    "plate_sample_stats": lambda v: v.stats,
    "plate_grid": lambda v: R.plate_grid(v.stats, testkit.plate_map(v.spark)),
    "interpool_counts": lambda v: R.interpool_counts(R.as_mean_assign(v.all_winners), v.samples),
    "read_composition": lambda v: R.read_composition(v.all_winners, v.samples),
    "ecdf_points": lambda v: R.ecdf(v.groups),
    "heat_counts": lambda v: R.heat_counts(v.rates, "contam_rate", "n_reads", 10, 8),
    "hexagon_counts": lambda v: R.hexagons(v.rates, "n_reads", "contam_rate"),
    "sample_density": lambda v: R.densities(v.rates.join(v.samples, "BC"), "sample", "contam_rate"),
    "bic_single_soft": _soft,
    "ks_statistic": lambda v: R.ks_statistic(v.groups),
    "tsv_roundtrip": _tsv,
    "bam_roundtrip": _bam,
    "streaming_counts": _stream,
    "streaming_reads": lambda v: _streamed_reads(v).select(*TWO),
}


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, as in the SQL."""
    real = {f.name for f in df.schema if isinstance(f.dataType, DoubleType | FloatType)}
    return df.select(*[F.round(F.col(f"`{c}`").cast("double"), 6).alias(c) if c in real else F.col(f"`{c}`") for c in df.columns])


def _query(make: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _rounded(make(Views(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _query(make) for name, make in _MAKE.items()}
ORACLE_SQL: dict[str, str] = {name: _SQL[name] for name in QUERIES if name in _SQL}
