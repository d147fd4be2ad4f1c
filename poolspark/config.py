"""Parameters of the stages.

Fixed values: names and defaults of all parameters here are those of the exchanged configurations, but that models
are learned from all barcodes unless a sample is asked for.
"""

from __future__ import annotations

import csv
import json
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class AssignConfig:
    alpha: float = 0.05
    k: int = 10
    mapq_min: int = 20
    xa_max: int = 2
    #: barcodes that models are learned from; 0 is all
    sample_barcodes: int = 0
    seed: int = 42
    rescue_window: int = 500
    #: rows of each genome that are read at most, for trial runs
    max_rows_per_genome: int | None = None
    #: lowest value, highest value and number of bins
    as_bins: tuple[int, int, int] = (0, 200, 2000)
    mapq_bins: tuple[int, int, int] = (0, 60, 120)
    delta_as_bins: tuple[int, int, int] = (0, 100, 200)
    delta_mapq_bins: tuple[int, int, int] = (0, 60, 120)


@dataclass(frozen=True)
class MergeConfig:
    beta: float = 1.0
    w_as: float = 1.0
    w_mapq: float = 1.0
    w_nm: float = 1.0
    ambient_const: float = 1e-3
    w_confident: float = 1.0
    w_ambiguous: float = 1.0
    winner_only: bool = True
    min_reads: int = 5
    single_mass_min: float = 0.6
    ratio_top1_top2_min: float = 2.0
    doublet_minor_min: float = 0.2
    empty_bic_margin: float = 10.0
    bic_margin: float = 6.0
    near_tie_margin: float = 2.0
    empty_top1_max: float = 0.6
    empty_ratio12_max: float = 1.5
    empty_reads_max: int | None = None
    empty_jsd_max: float | None = None
    jsd_normalize: bool = True
    eta_iters: int = 2
    eta_seed_quantile: float = 0.02
    empty_tau_quantile: float = 0.95
    alpha_grid: float = 0.02
    rho_grid: float = 0.05
    max_alpha: float = 0.5
    topk_genomes: int = 3
    topk_reclass: bool = False
    winner_discount: bool = False
    winner_discount_mode: str = "winner_ratio"
    max_hits: int | None = None
    hits_delta_mapq: int | None = None
    hits_guard: int = 500
    min_mapq: int = 0
    max_xa: int = -1
    xmap_enabled: bool = True
    xmap_chi_threshold: float = 0.05
    xmap_phi_min_reads: int = 500
    xmap_phi_ratio12_min: float = 2.0
    xmap_min_anchors: int = 10
    #: "exact", or "zero" for a run in which no read counts are known
    n_reads_mode: str = "exact"

    def __post_init__(self):
        if not 0 < self.max_alpha <= 1:
            raise ValueError("max_alpha must lie in (0, 1]")
        if self.winner_discount_mode not in ("winner_ratio", "total_ratio"):
            raise ValueError("winner_discount_mode is winner_ratio or total_ratio")

    def alphas(self) -> int:
        return int((self.max_alpha + 1e-9) / self.alpha_grid) + 1

    def rhos(self) -> int:
        return int((0.8 + 1e-9) / self.rho_grid) + 1


@dataclass(frozen=True)
class DecontamConfig:
    ambiguous_policy: str = "design_rescue"
    doublet_policy: str = "top12"
    indist_policy: str = "top12"
    weak_doublet_policy: str = "top1"
    strict_design: bool = True
    min_reads_post_clean: int = 100
    min_allowed_frac: float = 0.90
    decontam_alpha: float | None = None
    require_p_as: bool = False
    safe_keep_delta_as: int = 0
    safe_keep_mapq_min: int | None = None
    safe_keep_nm_max: int | None = None
    design_bc_mode: str = "before-dash"
    design_bc_n: int = 10


@dataclass(frozen=True)
class SampleConfig:
    sample: str
    workdir: str
    genomes: dict[str, str] = field(default_factory=dict)
    min_barcode_freq: int = 10
    chunk_size_cells: int = 5000

    @classmethod
    def from_json(cls, path: str) -> SampleConfig:
        raw = json.loads(Path(path).read_text())
        return cls(raw["sample"], raw["workdir"], dict(raw["genomes"]), int(raw.get("min_barcode_freq", 10)), int(raw.get("chunk_size_cells", 5000)))

    def check_bams(self) -> None:
        for genome, bam in self.genomes.items():
            if not Path(bam).exists():
                raise FileNotFoundError(f"{genome}: {bam}")


def samples_from_tsv(path: str) -> list[SampleConfig]:
    """One configuration for each sample of a table with columns sample, genome, bam, workdir."""
    seen: dict[str, tuple[str, dict[str, str]]] = {}
    with open(path, newline="") as f:
        for row in csv.DictReader(f, delimiter="\t"):
            workdir, genomes = seen.setdefault(row["sample"], (row["workdir"], {}))
            if workdir != row["workdir"]:
                raise ValueError(f"sample {row['sample']} has more than one workdir")
            if row["genome"] in genomes:
                raise ValueError(f"sample {row['sample']} has genome {row['genome']} twice")
            genomes[row["genome"]] = row["bam"]
    return [SampleConfig(s, w, g) for s, (w, g) in seen.items()]
