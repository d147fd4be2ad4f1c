"""Reports over several samples: between pools, and of a plate."""

from __future__ import annotations

import csv
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolspark.operators import reports
from poolspark.plans.shared import materialize
from poolspark.sources import tables, workfolder


def pool_genomes(design: str | None, sample: str, default: list[str]) -> list[str]:
    """The genomes of a sample's pool in upper case, from a table with columns Genome and Pool, else ``default``."""
    if design is None:
        return [g.upper() for g in default]
    with open(design, newline="") as f:
        rows = [{k.lower(): v for k, v in r.items()} for r in csv.DictReader(f, delimiter="\t")]
    if rows and not {"genome", "pool"} <= set(rows[0]):
        raise ValueError("a pool design has columns Genome and Pool")
    own = sorted({r["genome"].upper() for r in rows if r["pool"].upper() == sample.upper()})
    if not own:
        raise ValueError(f"no rows of pool {sample} in the design")
    return own


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def summarize(spark: SparkSession, workdir: str, sample: str, pool: list[str], xa_max: int = 2, q: float = 0.2, threshold: float | None = None) -> dict[str, str]:
    """A pool's barcodes that pass, its reads to discard, and the figures behind its plots; without winners an error."""
    rows = workfolder.read_winners(spark, workdir, sample)
    if rows is None:
        raise FileNotFoundError(f"no winner tables below {workdir}/{sample}")
    out = f"{workdir}/{sample}"
    reads = reports.winner_reads(rows, xa_max)
    assigned = reports.as_mean_assign(reads)
    rates = reports.contamination_rate(reads, assigned)
    passed = reports.pass_barcodes(assigned, pool).join(assigned.drop("assigned_genome"), "BC")
    groups = materialize(reports.low_high(rates, assigned, q, threshold), "groups")
    return {
        "hq_barcodes": workfolder.write_tsv_file(passed.select("BC", "assigned_genome", "total_n", "top1_as_mean", "as_gap").orderBy("BC"), f"{out}/{sample}_BCs_PASS_by_mapping.tsv"),
        "reads_to_discard": workfolder.write_tsv_file(reports.reads_to_discard(reads, assigned), f"{out}/Reads_to_discard_{sample}.tsv.gz"),
        "ecdf": workfolder.write_tsv_file(reports.ecdf(groups).orderBy("variable", "grp", F.asc_nulls_last("value")), f"{out}/{sample}_contamination_ecdf.tsv"),
        "ks": workfolder.write_tsv_file(reports.ks_statistic(groups).orderBy("variable"), f"{out}/{sample}_contamination_ks.tsv"),
        "hexagons": workfolder.write_tsv_file(reports.hexagons(rates, "n_reads", "contam_rate").orderBy("x", "y"), f"{out}/{sample}_contamination_hexagons.tsv"),
    }


def interpool(spark: SparkSession, workdirs: dict[str, str], out: str) -> dict[str, str]:
    """Barcodes by assigned genome and reads by genome of every sample; samples without a usable table are left out, none at all is an error."""
    counts, reads = [], []
    for sample, workdir in workdirs.items():
        try:
            rows = workfolder.read_winners(spark, workdir, sample, chunks=False)
        except ValueError:  # columns are missing
            continue
        if rows is None:
            continue
        own = reports.winner_reads(rows, xa_max=-1)
        samples = own.select("BC").distinct().withColumn("sample", F.lit(sample))
        counts.append(reports.interpool_counts(reports.as_mean_assign(own), samples))
        reads.append(reports.read_composition(own, samples))
    if not counts:
        raise FileNotFoundError("no usable winner table of any sample")
    return {
        "bc_counts": workfolder.write_tsv_file(_union(counts).orderBy("sample", "assigned_genome"), f"{out}/interpool_bc_counts.tsv"),
        "read_comp": workfolder.write_tsv_file(_union(reads).orderBy("sample", "Genome"), f"{out}/interpool_read_composition.tsv"),
    }


def plate(spark: SparkSession, workdir: str, plate_map: str, out: str | None = None, xa_max: int = 2) -> dict[str, str]:
    """Contamination by barcode, sample and well of all samples of a plate; samples without winners are left out, none at all is an error."""
    out, wells = out or f"{workdir}/PlateSummary", tables.read_plate_map(spark, plate_map)
    per = []
    for sample in sorted({r["sample"] for r in wells.select("sample").collect()}):  # as many as a plate has wells
        rows = workfolder.read_winners(spark, workdir, sample)
        if rows is not None:
            reads = reports.winner_reads(rows, xa_max)
            assigned = reports.as_mean_assign(reads)
            per.append(assigned.join(reports.contamination_rate(reads, assigned).drop("assigned_genome"), "BC").withColumn("sample", F.lit(sample)))
    if not per:
        raise FileNotFoundError("no winners of any sample of the plate map")
    every = _union(per)
    stats = reports.sample_stats(every.select("BC", "sample", "n_reads", "contam_rate"), None)
    return {
        "per_bc": workfolder.write_tsv_file(every, f"{out}/plate_per_bc.tsv.gz"),
        "per_sample": workfolder.write_tsv_file(stats.orderBy("sample"), f"{out}/plate_per_sample.tsv"),
        "density": workfolder.write_tsv_file(reports.densities(every, "sample", "contam_rate").orderBy("sample", "cell"), f"{out}/plate_density.tsv"),
        "heatmap": workfolder.write_tsv_file(reports.plate_grid(stats, wells).orderBy("row", "col"), f"{out}/plate_heatmap.tsv"),
    }


def workdirs_of(path: str) -> dict[str, str]:
    """{sample: workdir} of a table with columns sample, genome, bam, workdir; a sample in two folders is an error."""
    out: dict[str, str] = {}
    with open(path, newline="") as f:
        reader = csv.DictReader(f, delimiter="\t")
        if missing := {"sample", "genome", "bam", "workdir"} - set(reader.fieldnames or ()):
            raise ValueError(f"no columns {', '.join(sorted(missing))}")
        for row in reader:
            workdir = os.path.abspath(os.path.expanduser(row["workdir"]))
            if out.setdefault(row["sample"], workdir) != workdir:
                raise ValueError(f"sample {row['sample']} has more than one workdir")
    return out
