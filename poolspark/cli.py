"""The stages from a shell: ``python -m poolspark <command> --help``."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Callable
from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolspark.config import AssignConfig, DecontamConfig, MergeConfig, SampleConfig, samples_from_tsv
from poolspark.operators import assign, decontam, genotype, qc
from poolspark.plans import chunked, pipeline, samples
from poolspark.plans.shared import materialize
from poolspark.sources import bam, tables, workfolder


def _list(text: str) -> list[str]:
    return [x.strip() for x in text.split(",") if x.strip()]


def _options(parser: argparse.ArgumentParser, *configs: type) -> None:
    """One option for each parameter of the configurations that a shell can give."""
    seen = set()
    for config in configs:
        for f in fields(config):
            kind = next((t for t in (bool, int, float, str) if isinstance(f.default, t)), None)
            if f.default is None:
                kind = {"bool": bool, "int": int, "float": float, "str": str}[str(f.type).split(" ")[0]]
            if kind is None or f.name in seen:
                continue
            seen.add(f.name)
            flag = "--" + f.name.replace("_", "-")
            if kind is bool:
                parser.add_argument(flag, action=argparse.BooleanOptionalAction, default=None, dest=f.name)
            else:
                parser.add_argument(flag, type=kind, default=None, dest=f.name)


def _config(kind: type, args: argparse.Namespace):
    given = {f.name: getattr(args, f.name) for f in fields(kind) if getattr(args, f.name, None) is not None}
    return replace(kind(), **given)


def _samples(args: argparse.Namespace) -> list[SampleConfig]:
    """The samples of a JSON file, of a table, or of the options."""
    if args.config:
        return [SampleConfig.from_json(args.config)]
    if args.configs:
        return samples_from_tsv(args.configs)
    if not (args.sample and args.genome and args.bam and args.workdir):
        raise SystemExit("give --config, --configs, or all of --sample, --genome, --bam and --workdir")
    genomes, bams = _list(args.genome), _list(args.bam)
    if len(genomes) != len(bams) or len(set(genomes)) != len(genomes):
        raise SystemExit("--genome and --bam name equally many, each genome once")
    return [SampleConfig(args.sample, args.workdir, dict(zip(genomes, bams, strict=True)))]


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    tables.write_sorted(bam.read_bam(spark, args.bam, args.sample).drop("flag"), args.out)


def filter_(spark: SparkSession, args: argparse.Namespace) -> None:
    tables.write_sorted(qc.frequent_barcodes(tables.read_qc(spark, args.qc), args.min_barcode_freq, args.sample), args.out)


def chunks(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = tables.read_genomes(spark, args.filtered)
    qc.barcode_chunks(qc.distinct_barcodes(rows), args.chunk_size_cells).write.mode("overwrite").parquet(args.out)


def prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    for path in tables.migrate_all(spark, args.filtered, args.mapq_min, args.xa_max):
        print(path)


def assign_(spark: SparkSession, args: argparse.Namespace) -> None:
    """In one go, or by chunks of barcodes into a folder that several runs share."""
    config = _config(AssignConfig, args)
    if args.chunks is None:
        if args.score_chunk_range or args.skip_edges or args.skip_ecdf:
            raise ValueError("give --chunks to score by chunks")
        given = tables.load_model(spark, args.model) if args.model else None
        own = assign.Assignment(tables.read_genomes(spark, args.filtered), config, given)
        own.result().write.mode("overwrite").parquet(args.out)
        if args.save_model:
            tables.save_model(assign.edges_table(spark, own.edges()), own.tails, args.save_model)
        return
    state = [[p, tables.changed(spark, p)] for p in (*sorted(tables.discover(spark, args.filtered).values()), args.chunks)]
    own = chunked.ChunkedScoring(spark, args.out, config, json.dumps(state), args.force)
    own.reads(tables.read_genomes(spark, args.filtered), spark.read.parquet(args.chunks))
    now = own.score(args.score_chunk_range, args.batch_chunks, not args.skip_edges, not args.skip_ecdf)
    print(json.dumps({"scored": now, "finished": len(own.finished()), "of": len(own.chunk_ids()), "filter": own.filtered()}))


def _assigned(spark: SparkSession, path: str, quarantine: str | None = None) -> DataFrame:
    """Rows of the assign stage from Parquet, from chunks that are all scored, from text, or from what a sample's folder holds."""
    if tables.exists(spark, f"{path.rstrip('/')}.state/key.json"):
        return chunked.finished_rows(spark, path)
    if tables.exists(spark, f"{path}/_SUCCESS"):
        return spark.read.parquet(path)
    return tables.read_assign(spark, path if path.endswith((".tsv", ".tsv.gz", ".txt")) else workfolder.assign_outputs(spark, path), quarantine)


def genotyping(spark: SparkSession, args: argparse.Namespace) -> None:
    config, rows = _config(MergeConfig, args), _assigned(spark, args.assign, args.quarantine)
    eta = phi = None
    genomes = sorted(r[0] for r in rows.select("Genome").distinct().collect())
    if args.eta:
        eta = genotype.load_eta(workfolder.read_eta(spark, args.eta), genomes)
    if args.phi:
        phi = workfolder.read_phi(spark, args.phi)
    if args.topk:  # only the genomes that a barcode's line names are its candidates
        named = workfolder.read_topk(spark, args.topk).where(F.col("rank") <= config.topk_genomes)
        rows = rows.join(named.select(F.col("barcode").alias("BC"), F.col("genome").alias("Genome")), ["BC", "Genome"], "left_semi")
    own = genotype.Genotyping(rows, config, eta, phi)
    workfolder.write_tsv_file(tables.formatted_calls(materialize(own.calls(), "calls")), args.out)
    if args.models_out:
        workfolder.write_tsv_file(genotype.eta_table(spark, own.eta()), f"{args.models_out}/eta.tsv")
        if own.phi() is not None:
            workfolder.write_phi(own.phi(), f"{args.models_out}/phi.tsv", own.genomes)
            workfolder.write_tsv_file(genotype.chi(own.phi()).orderBy("genome"), f"{args.models_out}/chi.tsv")


def decontaminate(spark: SparkSession, args: argparse.Namespace) -> None:
    config, calls = _config(DecontamConfig, args), tables.read_calls(spark, args.calls)
    design = tables.read_design(spark, args.design, config.design_bc_mode, config.design_bc_n) if args.design else None
    rules = materialize(decontam.policy(calls, design, config), "rules")
    judged = materialize(decontam.judged(pipeline.with_p(_assigned(spark, args.assign)), rules, config), "judged")
    gate = decontam.postclean_gate(decontam.counts(judged, "post"), rules, config)
    out = f"{args.out}/{args.sample}"
    workfolder.write_tsv_file(decontam.drop_list(judged), f"{out}_reads_to_drop.tsv.gz")
    workfolder.write_tsv_file(decontam.calls_decontam(calls, rules, gate), f"{out}_cells_calls_decontam.tsv.gz")
    for when in ("pre", "post"):
        workfolder.write_tsv_file(decontam.counts(judged, when), f"{out}_{when}_barcode_composition.tsv.gz")
    workfolder.write_json(spark, f"{out}_decontam_params.json", {"sample": args.sample, "params": vars(config), "calls": args.calls, "assign": args.assign, "design": args.design})


def clean_bams(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, path in bam.clean_bams(spark, tables.read_drop_list(spark, args.reads_to_drop), args.out_dir, args.bam, args.bam_map, args.out_suffix).items():
        print(name, path, sep="\t")


def summarize(spark: SparkSession, args: argparse.Namespace) -> None:
    pool = samples.pool_genomes(args.pool_design, args.sample, _list(args.genome or ""))
    print(json.dumps(samples.summarize(spark, args.workdir, args.sample, pool, args.xa_max, args.contam_quantile, args.contam_threshold)))


def interpool(spark: SparkSession, args: argparse.Namespace) -> None:
    dirs = samples.workdirs_of(args.configs)
    print(json.dumps(samples.interpool(spark, dirs, args.outdir or f"{next(iter(dirs.values()))}/interpool")))


def plate(spark: SparkSession, args: argparse.Namespace) -> None:
    print(json.dumps(samples.plate(spark, args.workdir, args.plate_map, args.outdir, args.xa_max)))


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """Every stage of one sample or of several, each output written once for its parameters."""
    for own in _samples(args):
        own.check_bams()
        design = tables.read_design(spark, args.design) if args.design else None
        state = {g: [p, os.path.getsize(p), int(os.path.getmtime(p))] for g, p in sorted(own.genomes.items())}
        read = {g: bam.read_bam(spark, p).drop("flag") for g, p in own.genomes.items()}
        out = pipeline.run(
            spark, read, f"{own.workdir}/{own.sample}", own.sample, source_key=json.dumps(state), min_barcode_freq=args.min_barcode_freq or own.min_barcode_freq, design=design,
            assign_config=_config(AssignConfig, args), merge_config=_config(MergeConfig, args), decontam_config=_config(DecontamConfig, args), last=args.until, force=not args.resume,
        )
        if "assign" in out:
            final = out["assign"].where("assigned_class = 'winner'").select("BC", "Read", "Genome", F.col("as_").alias("AS"), "MAPQ", "NM", "XAcount")
            workfolder.write_tsv_file(final, f"{own.workdir}/{own.sample}/{workfolder.MERGED_WINNERS.format(sample=own.sample)}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="poolspark", description="Genomes of reads and calls of barcodes in pooled libraries.")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name: str, what: Callable, about: str, **needed: str) -> argparse.ArgumentParser:
        own = sub.add_parser(name, help=about, description=about)
        for option, text in needed.items():
            own.add_argument("--" + option.replace("_", "-"), required=True, help=text)
        own.set_defaults(what=what)
        return own

    command("extract", extract, "QC rows of a BAM file as Parquet sorted by barcode", bam="BAM file or folder of them", out="Parquet folder").add_argument("--sample", help="name put behind every barcode")
    own = command("filter", filter_, "rows of frequent barcodes", qc="Parquet of QC rows", out="filtered_<genome>_QCMapping.parquet")
    own.add_argument("--min-barcode-freq", type=int, default=10)
    own.add_argument("--sample")
    command("chunks", chunks, "barcodes cut into chunks", filtered="folder of filtered tables", out="Parquet folder").add_argument("--chunk-size-cells", type=int, default=5000)
    own = command("prepare", prepare, "filtered texts as Parquet beside them", filtered="folder of filtered texts")
    own.add_argument("--mapq-min", type=int, default=0)
    own.add_argument("--xa-max", type=int, default=-1)
    own = command("assign", assign_, "the genome of each read", filtered="folder of filtered tables", out="Parquet folder")
    own.add_argument("--chunks", help="Parquet of the chunks command")
    own.add_argument("--score-chunk-range", help="START:END, from 0, without END; ranges add up in one folder")
    own.add_argument("--model", help="folder of edges and tails to score with, without --chunks")
    own.add_argument("--save-model", help="folder for the edges and tails, without --chunks")
    own.add_argument("--batch-chunks", type=int, help="chunks that one job scores; by default as many as hold ten million reads")
    own.add_argument("--skip-edges", action="store_true", help="take the edges that are there")
    own.add_argument("--skip-ecdf", action="store_true", help="take the tail probabilities that are there")
    own.add_argument("--force", action="store_true", help="start anew where the folder holds chunks of another input")
    _options(own, AssignConfig)
    own = command("genotyping", genotyping, "the call of each barcode", assign="assign output, or a sample's folder", out="text file of calls")
    own.add_argument("--eta", help="a given ambient profile")
    own.add_argument("--phi", help="a given cross-mapping matrix")
    own.add_argument("--quarantine", help="folder that lists bad lines and unreadable files of text inputs")
    own.add_argument("--topk", help="lines of a barcode and its candidate genomes, best first")
    own.add_argument("--models-out", help="folder for the profile and the cross-mapping tables that were used")
    _options(own, MergeConfig)
    own = command("decontam", decontaminate, "reads and barcodes to drop", calls="text file of calls", assign="assign output, or a sample's folder", out="folder", sample="name of the outputs")
    own.add_argument("--design", help="table of barcodes and their expected genomes")
    _options(own, DecontamConfig)
    own = command("clean-bams", clean_bams, "BAM files without dropped reads", reads_to_drop="output of decontam", out_dir="folder")
    own.add_argument("--bam")
    own.add_argument("--bam-map", help="table of bam_id and bam_path")
    own.add_argument("--out-suffix", default=".clean.bam")
    own = command("summarize", summarize, "barcodes that pass and reads to discard of a pool", workdir="working folder", sample="name of the sample")
    own.add_argument("--pool-design", help="table of Genome and Pool")
    own.add_argument("--genome", help="the pool's genomes, without a design")
    own.add_argument("--xa-max", type=int, default=2)
    own.add_argument("--contam-quantile", type=float, default=0.2, help="share of barcodes on either side that are compared")
    own.add_argument("--contam-threshold", type=float, help="compare the barcodes up to this rate with those above it")
    command("interpool", interpool, "counts by genome of several samples", configs="table of sample, genome, bam, workdir").add_argument("--outdir")
    own = command("plate", plate, "contamination over a plate", workdir="working folder", plate_map="table of samples and wells")
    own.add_argument("--outdir")
    own.add_argument("--xa-max", type=int, default=2)
    own = command("run", run, "all stages")
    for option in ("--config", "--configs", "--sample", "--genome", "--bam", "--workdir", "--design"):
        own.add_argument(option)
    own.add_argument("--threads", type=int, help="cores of a local session")
    own.add_argument("--min-barcode-freq", type=int)
    own.add_argument("--chunk-size-cells", type=int, help="has no effect here: stages are not cut into chunks")
    own.add_argument("--until", choices=pipeline.STEPS, default=pipeline.STEPS[-1])
    own.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)
    _options(own, AssignConfig, MergeConfig, DecontamConfig)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if spark is None:
        build = SparkSession.builder.appName("poolspark")
        if "SPARK_MASTER" not in os.environ and getattr(args, "threads", None):
            build = build.master(f"local[{args.threads}]")
        spark = build.getOrCreate()
    try:
        args.what(spark, args)
    except (FileNotFoundError, ValueError) as e:
        print(f"poolspark {args.command}: {e}", file=sys.stderr)
        return 1
    return 0
