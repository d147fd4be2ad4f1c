"""The stages in order, each written once for its parameters and those before it."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from poolspark.config import AssignConfig, DecontamConfig, MergeConfig
from poolspark.operators import assign, decontam, genotype, qc, reports
from poolspark.sources import tables, workfolder


@dataclass
class Workdir:
    """Stage outputs under ``path``; an output is named by a hash of all parameters it depends on.

    A stage is done when its JSON note in ``_sentinels`` is there, which is written last and names stage, parameters and output.
    """

    spark: SparkSession
    path: str
    force: bool = False

    def stage(self, name: str, params: object, make: Callable[[], DataFrame]) -> DataFrame:
        key = hashlib.sha256(json.dumps([name, params], sort_keys=True, default=str).encode()).hexdigest()[:16]
        out = f"{self.path}/{name}-{key}"
        note = f"{self.path}/_sentinels/{name}.{key}.done.json"
        if self.force or not tables.exists(self.spark, note):
            make().write.mode("overwrite").parquet(out)
            workfolder.write_json(self.spark, note, {"step": name, "params": params, "outputs": {name: out}, "created_at": datetime.now(UTC).isoformat()})
        return self.spark.read.parquet(out)


STEPS = ("filter", "assign", "calls", "policy", "judged", "drops", "gate", "calls_decontam", "as_mean", "rates")


def run(
    spark: SparkSession, by_genome: dict[str, DataFrame], workdir: str, sample: str, *, source_key: str, min_barcode_freq: int = 10, normalize: bool = True, design: DataFrame | None = None, assign_config: AssignConfig = AssignConfig(),
    merge_config: MergeConfig = MergeConfig(), decontam_config: DecontamConfig = DecontamConfig(), last: str = STEPS[-1], force: bool = False,
) -> dict[str, DataFrame]:
    """All stages up to ``last``; ``source_key`` names the state of the inputs, so a changed input makes new outputs."""
    work, out = Workdir(spark, workdir, force), {}
    base = [source_key, sample, min_barcode_freq, normalize, sorted(by_genome)]
    params = [base]
    steps: dict[str, tuple[object, Callable[[], DataFrame]]] = {
        "filter": (None, lambda: qc.union_genomes({g: qc.frequent_barcodes(df, min_barcode_freq, sample if normalize else None) for g, df in by_genome.items()})),
        "assign": (asdict(assign_config), lambda: assign.Assignment(out["filter"], assign_config).result()),
        "calls": (asdict(merge_config), lambda: genotype.Genotyping(out["assign"], merge_config).calls()),
        "policy": (asdict(decontam_config), lambda: decontam.policy(out["calls"], design, decontam_config)),
        "judged": (None, lambda: decontam.judged(with_p(out["assign"]), out["policy"], decontam_config)),
        "drops": (None, lambda: decontam.drop_list(out["judged"])),
        "gate": (None, lambda: decontam.postclean_gate(decontam.counts(out["judged"], "post"), out["policy"], decontam_config)),
        "calls_decontam": (None, lambda: decontam.calls_decontam(out["calls"], out["policy"], out["gate"])),
        "as_mean": (None, lambda: reports.as_mean_assign(reports.winner_reads(out["assign"]))),
        "rates": (None, lambda: reports.contamination_rate(reports.winner_reads(out["assign"]), out["as_mean"])),
    }
    for name in STEPS:
        own, make = steps[name]
        params.append(own)
        out[name] = work.stage(name, params, make)
        if name == last:
            break
    return out


def with_p(rows: DataFrame) -> DataFrame:
    return rows.selectExpr("BC AS barcode", "Read AS read_id", "Genome AS genome", "as_", "MAPQ AS mapq", "NM AS nm", "XAcount AS xa", "assigned_class AS cls", "p_as")
