"""From reads' genomes to the genotype call of each barcode."""

from __future__ import annotations

import math
import warnings

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poolspark.config import MergeConfig
from poolspark.plans.ordered import quantiles, running_sums
from poolspark.plans.shared import materialize, materialize_bucketed

READ = ("barcode", "read_id")
TINY = 1e-12


def from_assign(rows: DataFrame) -> DataFrame:
    """Columns under the names of this stage."""
    return rows.select(F.col("BC").alias("barcode"), F.col("Read").alias("read_id"), F.col("Genome").alias("genome"), "as_", F.col("MAPQ").alias("mapq"), F.col("NM").alias("nm"), F.col("XAcount").alias("xa"), F.col("assigned_class").alias("cls"))


def reduce_per_genome(rows: DataFrame) -> DataFrame:
    """One row for each barcode, read and genome: column-wise extremes; ambiguous if any row is."""
    # dealt by read alone, so that what compares a read's genomes needs no further shuffle
    own = rows.na.drop(subset=["barcode", "read_id", "genome"]).repartition(*READ)
    cls = F.when(F.coalesce(F.max(F.col("cls") == "ambiguous"), F.lit(False)), "ambiguous").otherwise(F.coalesce(F.max("cls"), F.lit("ambiguous")))
    return own.groupBy(*READ, "genome").agg(F.max("as_").alias("as_"), F.max("mapq").alias("mapq"), F.min("nm").alias("nm"), F.max("xa").alias("xa"), cls.alias("cls"))


def read_quality(rows: DataFrame, min_mapq: int = 0, max_xa: int = -1) -> DataFrame:
    if min_mapq > 0:
        rows = rows.where(F.col("mapq") >= min_mapq)
    return rows.where(F.col("xa") <= max_xa) if max_xa >= 0 else rows


def promiscuous(rows: DataFrame, max_hits: int | None, delta_mapq: int | None, guard: int = 500) -> DataFrame:
    """Without the ambiguous rows of reads that have more than ``max_hits`` genomes near their best quality.

    Reads with more than ``guard`` such rows are exempt; so are rows without a quality.
    """
    if not max_hits or max_hits <= 0 or delta_mapq is None:
        return rows
    by = Window.partitionBy(*READ)
    seen = F.when((F.col("cls") == "ambiguous") & F.col("mapq").isNotNull(), F.col("mapq"))
    out = rows.withColumn("seen", seen).withColumns({"best": F.max("seen").over(by), "rows": F.count("seen").over(by)})
    out = out.withColumn("near", F.sum(F.when(F.col("seen") >= F.col("best") - delta_mapq, 1).otherwise(0)).over(by))
    lost = F.col("seen").isNotNull() & (F.col("near") > max_hits) & (F.col("rows") <= guard)
    return out.where(~lost).drop("seen", "best", "rows", "near")


def composite(config: MergeConfig) -> Column:
    """Null where a part is missing; such a row is last."""
    return F.col("as_") * F.lit(config.w_as) + F.col("mapq") * F.lit(config.w_mapq) - F.col("nm") * F.lit(config.w_nm)


def posteriors(reduced: DataFrame, config: MergeConfig = MergeConfig()) -> DataFrame:
    """(barcode, read_id, genome, l, l_amb, w_read): hard or soft assignment of a read's unit mass.

    Where all classes weigh the same, the class is not asked for, and Spark leaves out what only gives it.
    """
    by = Window.partitionBy(*READ)
    if config.w_ambiguous == config.w_confident:
        w_read = F.lit(config.w_confident)
    else:
        w_read = F.max(F.when(F.col("cls") == "ambiguous", config.w_ambiguous).otherwise(config.w_confident)).over(by)
    rows = reduced.na.drop(subset=["barcode", "read_id", "genome"]).withColumn("score", composite(config)).withColumn("w_read", w_read)
    if config.winner_only:
        top = rows.withColumn("rn", F.row_number().over(by.orderBy(F.desc_nulls_last("score"), "genome"))).where("rn = 1")
        return top.select(*READ, "genome", F.col("w_read").alias("l"), (F.col("w_read") * config.ambient_const).alias("l_amb"), "w_read")
    gap = F.greatest(F.least((F.col("score") - F.max("score").over(by)) * config.beta, F.lit(50.0)), F.lit(-50.0))
    rows = rows.withColumn("e", F.when(F.col("score").isNotNull(), F.exp(gap)).otherwise(0.0)).withColumn("denom", F.sum("e").over(by) + config.ambient_const)
    return rows.select(*READ, "genome", (F.col("e") / F.col("denom") * F.col("w_read")).alias("l"), (F.lit(config.ambient_const) / F.col("denom") * F.col("w_read")).alias("l_amb"), "w_read")


def mass_by_genome(post: DataFrame) -> DataFrame:
    return post.groupBy("barcode", "genome").agg(F.sum("l").alias("c"))


def profiles(post: DataFrame) -> DataFrame:
    """(barcode, genome, w_read, n, l) of hard assignment: a barcode's reads of one genome and weight, n of them with the mass l together.

    With hard assignment a read is nothing but its genome and weight, so everything
    about a barcode follows from this table of a few rows for each, whatever its
    reads.  It is pre-aggregated and written in sorted buckets of barcodes, one file each; what
    groups or joins by barcode after it moves nothing.
    """
    spark = post.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = post.groupBy("barcode", "genome", "w_read").agg(F.count("*").alias("n"), F.sum("l").alias("l"))
    return materialize_bucketed(own.repartition(buckets, "barcode"), "profiles", buckets, "barcode", sort=["barcode", "genome"])


def mass_pivot(mass: DataFrame, genomes: list[str]) -> DataFrame:
    return mass.groupBy("barcode").pivot("genome", genomes).sum("c").na.fill(0.0)


def n_reads(post: DataFrame, mode: str = "exact") -> DataFrame:
    """Distinct reads of each barcode; all zero in mode ``zero``."""
    if mode == "zero":
        return post.select("barcode").distinct().withColumn("n_reads", F.lit(0).cast("long"))
    return post.groupBy("barcode").agg(F.count_distinct("read_id").alias("n_reads"))


def topk_genomes(mass: DataFrame, k: int = 3) -> DataFrame:
    """(barcode, rank, genome, c) of each barcode's k heaviest genomes."""
    rank = F.row_number().over(Window.partitionBy("barcode").orderBy(F.desc("c"), "genome"))
    return mass.withColumn("rank", rank).where(F.col("rank") <= k).select("barcode", "rank", "genome", "c")


def topk_restrict(reduced: DataFrame, top: DataFrame) -> DataFrame:
    return reduced.join(top.select("barcode", "genome"), ["barcode", "genome"], "left_semi")


def reclass_topk(reduced: DataFrame, config: MergeConfig = MergeConfig()) -> DataFrame:
    """New classes within the rows left: the only winner, else the only rescued row, else the unique best score."""
    by = Window.partitionBy(*READ)
    score = F.coalesce(composite(config), F.lit(float("-inf")))
    own = reduced.withColumn("score", score).withColumns(
        {"n_win": F.sum(F.when(F.col("cls") == "winner", 1).otherwise(0)).over(by), "n_res": F.sum(F.when(F.col("cls") == "rescued", 1).otherwise(0)).over(by), "best": F.max("score").over(by)}
    )
    own = own.withColumn("n_best", F.sum(F.when(F.col("score") == F.col("best"), 1).otherwise(0)).over(by))
    win = F.when(F.col("n_win") == 1, F.col("cls") == "winner").when(F.col("n_res") == 1, F.col("cls") == "rescued").otherwise((F.col("score") == F.col("best")) & (F.col("n_best") == 1) & (F.col("best") > float("-inf")))
    return own.withColumn("cls", F.when(win, "winner").otherwise("ambiguous")).select(reduced.columns)


def barcode_stats(mass: DataFrame) -> DataFrame:
    """Composition of each barcode; ratio12 is null where there is no second genome."""
    w = Window.partitionBy("barcode")
    ranked = mass.withColumns({"rank": F.row_number().over(w.orderBy(F.desc("c"), "genome"))})
    at = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    own = ranked.groupBy("barcode").agg(F.sum("c").alias("n_effective"), at(1, "genome").alias("top_genome"), at(1, "c").alias("c1"), F.coalesce(at(2, "c"), F.lit(0.0)).alias("c2"))
    tot = F.greatest(F.col("n_effective"), F.lit(TINY))
    own = own.withColumns({"p_top1": F.col("c1") / tot, "p_top2": F.col("c2") / tot})
    ratio = F.when(F.col("p_top2") > 0, F.col("p_top1") / F.greatest("p_top2", F.lit(TINY)))
    return own.withColumns({"ratio12": ratio, "doublet_minor_frac": F.when(F.col("p_top2") > 0, F.least("p_top1", "p_top2")).otherwise(0.0)}).drop("c1", "c2")


# ---- ambient profile


def compositions(mass: DataFrame, reads: DataFrame, genomes: list[str]) -> DataFrame:
    """One row for each barcode: n_reads, n_effective, ``cs`` (its mass on each of ``genomes``), and p_top1 and ratio12 with the guards of the seeding step, where both are finite.

    All that the profile is learned from; the rounds need no shuffle of it.
    """
    heavy = F.sort_array(F.collect_list("c"), asc=False)
    own = mass.groupBy("barcode").agg(F.sum("c").alias("n_effective"), _masses(genomes).alias("cs"), heavy.alias("heavy")).join(reads, "barcode", "left")
    p1, p2 = [F.coalesce(F.get("heavy", F.lit(i)), F.lit(0.0)) / (F.col("n_effective") + TINY) for i in (0, 1)]
    return own.select("barcode", "n_reads", "n_effective", "cs", p1.alias("p_top1"), (p1 / (p2 + TINY)).alias("ratio12"))


def _masses(genomes: list[str]) -> Column:
    return F.array(*[F.coalesce(F.sum(F.when(F.col("genome") == g, F.col("c"))), F.lit(0.0)) for g in genomes])


def _few_reads(rows: DataFrame, config: MergeConfig) -> DataFrame:
    return rows if config.empty_reads_max is None else rows.where(F.coalesce("n_reads", F.lit(0)) <= config.empty_reads_max)


def eta_initial_seed(mass: DataFrame, reads: DataFrame, config: MergeConfig = MergeConfig()) -> DataFrame:
    """Barcodes of the lowest total mass: the share ``eta_seed_quantile`` of them, one at least."""
    return _initial_seed(mass.groupBy("barcode").agg(F.sum("c").alias("n_effective")).join(reads, "barcode", "left"), config)


def _initial_seed(own: DataFrame, config: MergeConfig) -> DataFrame:
    eff = _few_reads(own, config)
    n = eff.count()
    take = max(1, -int(-(min(max(config.eta_seed_quantile, 1e-6), 1.0) * n) // 1))
    ranked = running_sums(eff.select("barcode", F.struct("n_effective", "barcode").alias("place")), "place", {"rank": F.lit(1)})
    return ranked.where(F.col("rank") <= take).select("barcode")


def eta_of(mass: DataFrame, seed: DataFrame, genomes: list[str]) -> dict[str, float]:
    """Share of each genome in the seed barcodes' mass; uniform without seeds. One number for each genome."""
    return _shares(mass.join(seed, "barcode", "left_semi").agg(_masses(genomes).alias("cs")).first()["cs"], genomes)


def _eta_of(own: DataFrame, genomes: list[str]) -> dict[str, float] | None:
    """``eta_of`` the rows of a table of compositions; None if there are none."""
    got = own.agg(F.count("*").alias("n"), *[F.sum(F.get("cs", F.lit(i))).alias(f"c{i}") for i in range(len(genomes))]).first()
    return _shares([got[f"c{i}"] for i in range(len(genomes))], genomes) if got["n"] else None


def _shares(masses: list[float], genomes: list[str]) -> dict[str, float]:
    raw = {g: c + TINY for g, c in zip(genomes, masses, strict=True)}
    total = sum(raw.values())
    return {g: v / total for g, v in raw.items()}


def eta_table(spark, eta: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(sorted(eta.items()), "genome string, eta double")


def load_eta(rows: DataFrame, genomes: list[str]) -> dict[str, float]:
    """A given profile (genome, eta), normalised; every genome must have a value, others are left out."""
    got = {r[0]: float(r[1]) for r in rows.collect()}
    if missing := sorted(set(genomes) - set(got)):
        raise ValueError(f"no eta for {', '.join(missing)}")
    total = sum(got[g] for g in genomes)
    if abs(total - 1) > 0.01:
        warnings.warn(f"eta adds up to {total:.4g} and is normalised", stacklevel=2)
    return {g: got[g] / total for g in genomes}


def eta_differences(eta: dict[str, float]) -> list[tuple[str, str, float]]:
    """(genome, genome, difference of their shares) of every pair, by name; a short list."""
    return [(a, b, eta[a] - eta[b]) for a in sorted(eta) for b in sorted(eta) if a < b]


def jsd_to_eta(mass: DataFrame, eta: dict[str, float], normalize: bool = True) -> DataFrame:
    """(barcode, jsd): Jensen-Shannon divergence of a barcode's composition from the profile."""
    own = mass.groupBy("barcode").agg(F.sum("c").alias("n_effective"), _masses(sorted(eta)).alias("cs"))
    return own.select("barcode", _jsd(eta, sorted(eta), normalize).alias("jsd"))


def _jsd(eta: dict[str, float], genomes: list[str], normalize: bool) -> Column:
    """The divergence of a row of compositions, whose ``cs`` follow ``genomes``."""
    total = sum(eta.values()) + TINY
    qs = F.array(*[F.lit(max(eta[g] / total, TINY)) for g in genomes])

    def term(c: Column, q: Column) -> Column:
        p = F.greatest(c / (F.col("n_effective") + TINY), F.lit(TINY))
        m = (p + q) / 2
        return p * F.log(p / m) + q * F.log(q / m)

    return F.aggregate(F.zip_with("cs", qs, term), F.lit(0.0), lambda acc, x: acc + x) / F.lit(2 * (math.log(2) if normalize else 1.0))


def _candidates(own: DataFrame, config: MergeConfig) -> DataFrame:
    """Compositions that are mixed and of few reads; all of them if none is."""
    cand = _few_reads(own.where((F.col("p_top1") <= config.empty_top1_max) & (F.col("ratio12") <= config.empty_ratio12_max)), config)
    return own if cand.isEmpty() else cand


def _near_profile(cand: DataFrame, eta: dict[str, float], genomes: list[str], config: MergeConfig) -> DataFrame:
    own = cand.withColumn("jsd", F.round(_jsd(eta, genomes, config.jsd_normalize), 9))
    (tau,) = quantiles(own, "jsd", [config.empty_tau_quantile])
    return own.where(F.col("jsd") <= F.round(F.lit(tau).cast("double"), 9))


def jsd_seed(mass: DataFrame, reads: DataFrame, eta: dict[str, float], config: MergeConfig = MergeConfig()) -> DataFrame:
    """Candidates of mixed composition whose divergence is within the ``empty_tau_quantile``."""
    own = materialize(compositions(mass, reads, sorted(eta)), "compositions")
    return _near_profile(_candidates(own, config), eta, sorted(eta), config).select("barcode", "jsd")


def learn_eta(mass: DataFrame, reads: DataFrame, genomes: list[str], config: MergeConfig = MergeConfig()) -> dict[str, float]:
    """The profile after ``eta_iters`` rounds; a round reads one row for each barcode and moves only counts of divergences."""
    own = materialize(compositions(mass, reads, genomes), "compositions")
    eta = _eta_of(own.join(_initial_seed(own, config), "barcode", "left_semi"), genomes) or _shares([0.0] * len(genomes), genomes)
    cand = _candidates(own, config) if config.eta_iters else own
    for _ in range(config.eta_iters):
        new = _eta_of(_near_profile(cand, eta, genomes, config), genomes)
        if new is None:
            break
        eta = new
    return eta


# ---- cross-mapping and discount


def phi_matrix(mass: DataFrame, reads: DataFrame, genomes: list[str], config: MergeConfig = MergeConfig()) -> DataFrame:
    """(anchor, target, phi): mean composition of barcodes that surely hold the anchor; identity with too few."""
    spark = mass.sparkSession
    every = spark.createDataFrame([(a, b) for a in genomes for b in genomes], "anchor string, target string")
    stats = barcode_stats(mass).join(reads, "barcode")
    ratio = F.coalesce("ratio12", F.lit(1e308))
    anchors = stats.where((F.col("n_reads") >= config.xmap_phi_min_reads) & (ratio >= config.xmap_phi_ratio12_min)).select("barcode", F.col("top_genome").alias("anchor"))
    own = anchors.join(mass, "barcode").groupBy("anchor", F.col("genome").alias("target")).agg(F.sum("c").alias("c"))
    n = anchors.groupBy("anchor").agg(F.count("*").alias("n"))
    full = every.join(F.broadcast(n), "anchor", "left").join(F.broadcast(own), ["anchor", "target"], "left")
    tot = F.sum(F.coalesce("c", F.lit(0.0))).over(Window.partitionBy("anchor"))
    known = (F.coalesce("n", F.lit(0)) >= config.xmap_min_anchors) & (tot > 0)
    phi = F.when(known, F.coalesce("c", F.lit(0.0)) / tot).otherwise((F.col("anchor") == F.col("target")).cast("double"))
    return full.select("anchor", "target", phi.alias("phi"))


def chi(phi: DataFrame) -> DataFrame:
    """(genome, chi): the largest share that another genome draws."""
    return phi.groupBy(F.col("anchor").alias("genome")).agg(F.max(F.when(F.col("anchor") != F.col("target"), F.col("phi")).otherwise(0.0)).alias("chi"))


def winner_discount(post: DataFrame, mode: str = "winner_ratio") -> DataFrame:
    """(barcode, genome, discount): the factor of a genome's mass, 1 for the one with most winner mass; from posteriors or profiles."""
    sums = post.groupBy("barcode", "genome").agg(F.sum(F.when(F.col("w_read") >= 0.5, F.col("l")).otherwise(0.0)).alias("wm"), F.count_if(F.col("w_read") >= 0.5).alias("nw"), F.sum("l").alias("tm"))
    w = Window.partitionBy("barcode")
    own = sums.withColumns({"top": F.first("genome").over(w.orderBy(F.desc("wm"), "genome")), "most": F.max("wm").over(w)})
    num = F.col("wm") if mode == "winner_ratio" else F.col("tm")
    factor = F.when(F.col("most") <= 0, 1.0).when(F.col("genome") == F.col("top"), 1.0).when(F.col("nw") == 0, 0.0).otherwise(F.least(num / F.col("most"), F.lit(1.0)))
    return own.select("barcode", "genome", factor.alias("discount"))


def discounted(post: DataFrame, mode: str) -> DataFrame:
    """``post`` with its masses discounted; posteriors or profiles."""
    return post.join(winner_discount(post, mode), ["barcode", "genome"]).withColumn("l", F.col("l") * F.col("discount")).select(post.columns)


# ---- likelihoods


def signatures(post: DataFrame, eta: dict[str, float], top: DataFrame, k: int, phi: DataFrame | None = None, chis: DataFrame | None = None, threshold: float = 0.05, soft: bool = False) -> DataFrame:
    """One row for each barcode: n reads and an array of (cnt, e, ls, xs), equal reads counted together; from posteriors or profiles.

    ``e`` is a read's likelihood under the profile, ``ls`` those of the k
    candidates in order, ``xs`` the same with cross-mapping where a candidate's
    chi exceeds ``threshold``.  With hard assignment a barcode has as many
    different vectors as genomes and weights, however many reads it has.  With
    ``soft`` assignment nearly every read may differ: barcodes of more than
    ``MOST`` vectors then have several rows, told apart by ``part`` of ``parts``,
    each with the counts of the whole barcode; see ``criteria``.
    """
    spark = post.sparkSession
    profile = F.broadcast(eta_table(spark, eta))
    cand = top.select("barcode", "rank", F.col("genome").alias("cand"))
    counted = "n" in post.columns
    if counted:  # of profiles: one read's mass
        post = post.withColumn("l", F.col("l") / F.col("n"))
    of_read = (lambda x: x) if counted else F.sum
    rows = post.join(profile, "genome", "left").join(cand.groupBy("barcode").agg(F.sort_array(F.collect_list(F.struct("rank", "cand"))).alias("cands")), "barcode", "left")
    ls = [of_read(F.when(F.try_element_at("cands", F.lit(i + 1))["cand"] == F.col("genome"), F.col("l")).otherwise(0.0)) for i in range(k)]
    xs = ls
    if phi is not None:
        active = {r["genome"] for r in chis.where(F.col("chi") > threshold).collect()}  # at most one for each genome
        rule = {(r["anchor"], r["target"]): r["phi"] for r in phi.collect() if r["anchor"] in active}
        xs = []
        for i in range(k):
            c = F.try_element_at("cands", F.lit(i + 1))["cand"]
            own = F.when(c == F.col("genome"), F.col("l")).otherwise(0.0)
            for a in sorted(active):
                drawn = F.lit(0.0)
                for b in sorted(eta):
                    drawn = F.when(F.col("genome") == b, F.col("l") * rule[(a, b)]).otherwise(drawn)
                own = F.when(c == a, drawn).otherwise(own)
            xs.append(of_read(own))
    of = [of_read(F.col("l") * F.coalesce("eta", F.lit(0.0))).alias("e"), F.array(*ls).alias("ls"), F.array(*xs).alias("xs")]
    if counted:
        per = rows.select("barcode", "n", (F.col("n") * F.col("w_read")).alias("w"), *of)
    else:
        per = rows.groupBy(*READ).agg(F.max("w_read").alias("w"), *of).withColumn("n", F.lit(1).cast("long"))
    alike = per.groupBy("barcode", F.round("e", 12).alias("e"), F.transform("ls", lambda x: F.round(x, 12)).alias("ls"), F.transform("xs", lambda x: F.round(x, 12)).alias("xs")).agg(F.sum("n").alias("cnt"), F.sum("w").alias("w"))
    totals = [F.sum("cnt").alias("n_reads"), F.sum("w").alias("n_reads_eff")]
    sigs = F.collect_list(F.struct("cnt", "e", "ls", "xs")).alias("sigs")
    if not soft:
        return alike.groupBy("barcode").agg(*totals, sigs)
    alike = materialize(alike, "signatures")
    whole = alike.groupBy("barcode").agg(*totals, F.ceil(F.count("*") / MOST).cast("int").alias("parts"))
    dealt = alike.drop("w").join(whole, "barcode").withColumn("part", F.pmod(F.xxhash64("e", "ls", "xs"), "parts").cast("int"))
    return dealt.groupBy("barcode", "parts", "part", "n_reads", "n_reads_eff").agg(sigs)


def _ll(s: str) -> str:
    return f"aggregate(sigs, 0D, (acc, x) -> acc + x.cnt * ln(greatest({s}, {TINY}D)))"


def _bic(ll: str, params: int) -> str:
    return f"round(-2 * {ll} + {params} * ln(greatest(n_reads, 1)), 9)"


def bic_empty(sigs: DataFrame) -> DataFrame:
    return sigs.withColumn("bic_empty", F.expr(_bic(_ll("x.e"), 0)))


#: Signatures of a barcode, and numbers of all its grids together, that are evaluated at a time.
BLOCK, CELLS = 2048, 1 << 19

#: Signatures that one row may hold on average; a barcode of more is dealt out to several rows.
MOST = 8192


def _shapes(k: np.ndarray, cnt: list, grid: int):
    """Places of barcodes that have the same numbers of candidates and of signatures, as many as may be evaluated at a time."""
    m = np.fromiter(map(len, cnt), np.int64, len(cnt))
    shapes, of = np.unique(np.stack([k, m], 1), axis=0, return_inverse=True)
    for i, (kk, mm) in enumerate(shapes.tolist()):
        own = np.flatnonzero(of.ravel() == i)
        step = max(1, CELLS // (grid * max(1, min(mm, BLOCK))))
        for j in range(0, len(own), step):
            yield kk, mm, own[j : j + step]


def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of each combination of values in columns of equal length, and the combination of each row."""
    code = np.zeros(len(parts[0]), np.int64)
    for x in parts:
        values, of = np.unique(x, return_inverse=True)
        code = np.unique(code * len(values) + of.ravel(), return_inverse=True)[1].ravel()
    return np.unique(code, return_index=True)[1], code


def _grid_sums(cnt: np.ndarray, parts: list[np.ndarray], values) -> np.ndarray:
    """Log-likelihoods of all grid points of barcodes of one shape, one row for each; ``values`` gives the likelihoods of signatures, one row for each, from their ``parts``.

    ``cnt`` and ``parts`` have barcodes first and signatures last.  With hard assignment
    few signatures differ, so each combination of parts is evaluated once.
    """
    total, (n, m) = 0.0, cnt.shape
    for a in range(0, max(m, 1), BLOCK):
        own = cnt[:, a : a + BLOCK]
        flat = [p[:, a : a + BLOCK].ravel() for p in parts]
        first, of = _distinct(flat)
        alike = 2 * len(first) <= len(of)
        x = np.log(np.maximum(values(*[(p[first] if alike else p)[:, None] for p in flat]), TINY))
        total = total + np.einsum("bs,bsg->bg", own, (x[of] if alike else x).reshape(*own.shape, x.shape[1]))
    return total


def _criterion(total: np.ndarray, n: np.ndarray, params: int) -> np.ndarray:
    return np.round(-2 * total + params * np.log(np.maximum(n, 1))[:, None], 9)


def _single_sums(count, amb, x, kk: int, alpha) -> np.ndarray:
    """One row for each barcode; candidates, then alpha."""
    one = lambda c: _grid_sums(count, [amb, x[:, c]], lambda e, v: (1 - alpha) * v + alpha * e)
    return np.concatenate([one(c) for c in range(kk)], 1)


def _doublet_sums(count, amb, x, c: int, d: int, alpha, rho) -> np.ndarray:
    """One row for each barcode and the pair c, d of candidates; alpha, then rho."""

    def values(e, v, w):
        mixed = rho * v + (1 - rho) * w
        return ((1 - alpha)[:, None] * mixed[:, None] + alpha[:, None] * e[:, None]).reshape(len(e), -1)

    return _grid_sums(count, [amb, x[:, c], x[:, d]], values)


def _pairs(kk: int) -> list[tuple[int, int]]:
    return [(c, d) for c in range(kk - 1) for d in range(c + 1, kk)]


def _axes(config: MergeConfig) -> tuple[np.ndarray, np.ndarray]:
    return np.arange(config.alphas()) * config.alpha_grid, 0.1 + np.arange(config.rhos()) * config.rho_grid


SINGLE, DOUBLET = "struct<bic: double, c: int, i: int>", "struct<bic: double, c: int, d: int, i: int, j: int>"


def _arrays(own: np.ndarray, m: int, size: int, cnt, e, flat):
    """Counts, profile likelihoods and those of the candidates, one row for each barcode."""
    take = lambda xs, width: np.array([xs[i] for i in own], np.float64).reshape(len(own), width)
    return take(cnt, m), take(e, m), take(flat, m * size).reshape(len(own), m, size).transpose(0, 2, 1)


def _columns(likelihoods: str) -> list[Column]:
    """The arguments of the grids: a barcode's signatures as plain arrays."""
    return [F.col("n_reads"), F.col("k"), F.col("sigs.cnt"), F.col("sigs.e"), F.flatten(F.col(f"sigs.{likelihoods}"))]


def bic_single(sigs: DataFrame, top: DataFrame, config: MergeConfig = MergeConfig()) -> DataFrame:
    """Adds single: struct(bic, c, i): the first minimum over candidates, then alpha = i * alpha_grid.

    The grids run in NumPy on Arrow batches, barcodes of one shape together.
    """
    size, (alpha, _) = config.topk_genomes, _axes(config)

    @F.pandas_udf("bic double, c int, i int")
    def best(n: pd.Series, k: pd.Series, cnt: pd.Series, e: pd.Series, xs: pd.Series) -> pd.DataFrame:
        out, reads, cnt, e, xs = np.full((len(n), 3), np.nan), n.to_numpy(), cnt.tolist(), e.tolist(), xs.tolist()
        for kk, m, own in _shapes(k.to_numpy(np.int64), cnt, size * len(alpha)):
            if kk < 1:
                continue
            count, amb, x = _arrays(own, m, size, cnt, e, xs)
            bic = _criterion(_single_sums(count, amb, x, kk, alpha), reads[own], 1)
            at = bic.argmin(1)
            out[own] = np.stack([bic[np.arange(len(own)), at], at // len(alpha), at % len(alpha)], 1)
        return pd.DataFrame(out, columns=["bic", "c", "i"]).astype({"c": "Int32", "i": "Int32"})

    return _with_k(sigs, top).withColumn("single", best(*_columns("xs")))


def bic_doublet(sigs: DataFrame, config: MergeConfig = MergeConfig()) -> DataFrame:
    """Adds doublet: struct(bic, c, d, i, j): the first minimum over pairs c < d of candidates, alpha, and rho = 0.1 + j * rho_grid."""
    size, (alpha, rho) = config.topk_genomes, _axes(config)

    @F.pandas_udf("bic double, c int, d int, i int, j int")
    def best(n: pd.Series, k: pd.Series, cnt: pd.Series, e: pd.Series, ls: pd.Series) -> pd.DataFrame:
        out, reads, cnt, e, ls = np.full((len(n), 5), np.nan), n.to_numpy(), cnt.tolist(), e.tolist(), ls.tolist()
        for kk, m, own in _shapes(k.to_numpy(np.int64), cnt, len(alpha) * len(rho)):
            if kk < 2:
                continue
            count, amb, x = _arrays(own, m, size, cnt, e, ls)
            for c, d in _pairs(kk):
                bic = _criterion(_doublet_sums(count, amb, x, c, d, alpha, rho), reads[own], 2)
                at = bic.argmin(1)
                found = bic[np.arange(len(own)), at]
                less = ~(found >= out[own, 0])  # the first pair meets a missing value
                out[own[less]] = np.stack([found, np.full(len(own), c), np.full(len(own), d), at // len(rho), at % len(rho)], 1)[less]
        return pd.DataFrame(out, columns=["bic", "c", "d", "i", "j"]).astype(dict.fromkeys("cdij", "Int32"))

    return sigs.withColumn("doublet", best(*_columns("ls")))


def criteria(sigs: DataFrame, top: DataFrame, config: MergeConfig = MergeConfig(), figures: DataFrame | None = None) -> DataFrame:
    """One row for each barcode with n_reads, n_reads_eff, cands, k, bic_empty, single and doublet, and the columns of ``figures`` (barcode, ...).

    The grids forget how rows are dealt, so tables by barcode are joined before them.

    A barcode whose signatures are in several rows has its grids summed over
    them place by place, so no task ever holds all its signatures.
    """
    names = ["barcode", "n_reads", "n_reads_eff", "cands", "k", "bic_empty", "single", "doublet"]
    if "part" not in sigs.columns:
        if figures is not None:
            sigs, names = sigs.join(figures, "barcode", "left"), [*names, *figures.columns[1:]]
        return bic_doublet(bic_single(bic_empty(sigs), top, config), config).select(names)
    sigs = materialize(sigs, "signature-rows")  # read by both branches
    one = bic_doublet(bic_single(bic_empty(sigs.where("parts = 1")), top, config), config).select(names)
    rows = _with_k(sigs.where("parts > 1"), top)
    key = ["barcode", "n_reads", "n_reads_eff", "cands", "k"]
    places = rows.select(*key, F.posexplode(_all_sums(config)(F.col("k"), F.col("sigs.cnt"), F.col("sigs.e"), F.flatten("sigs.ls"), F.flatten("sigs.xs"))))
    summed = places.groupBy(*key, "pos").agg(F.sum("col").alias("ll"))
    grids = summed.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "ll"))), lambda v: v["ll"]).alias("lls"))  # as many as the grids have places
    every = one.unionByName(grids.withColumn("best", _best_of_sums(config)("n_reads", "k", "lls")).select(*key, "best.bic_empty", "best.single", "best.doublet"))
    return every if figures is None else every.join(figures, "barcode", "left")


def _all_sums(config: MergeConfig):
    """Of a row's signatures: the log-likelihood of the profile, of the single grid, and of the doublet grids of all pairs."""
    size, (alpha, rho) = config.topk_genomes, _axes(config)

    @F.pandas_udf("array<double>")
    def sums(k: pd.Series, cnt: pd.Series, e: pd.Series, ls: pd.Series, xs: pd.Series) -> pd.Series:
        out, cnt, e, ls, xs = [None] * len(k), cnt.tolist(), e.tolist(), ls.tolist(), xs.tolist()
        for kk, m, own in _shapes(k.to_numpy(np.int64), cnt, max(size, len(rho)) * len(alpha)):
            count, amb, x = _arrays(own, m, size, cnt, e, xs)
            parts = [_grid_sums(count, [amb], lambda e: e)]
            if kk:
                parts.append(_single_sums(count, amb, x, kk, alpha))
            _, _, x = _arrays(own, m, size, cnt, e, ls)
            parts += [_doublet_sums(count, amb, x, c, d, alpha, rho) for c, d in _pairs(kk)]
            for i, row in zip(own, np.concatenate(parts, 1), strict=True):
                out[i] = row
        return pd.Series(out)

    return sums


def _best_of_sums(config: MergeConfig):
    alpha, rho = _axes(config)

    @F.pandas_udf(f"bic_empty double, single {SINGLE}, doublet {DOUBLET}")
    def best(n: pd.Series, k: pd.Series, lls: pd.Series) -> pd.DataFrame:
        out = []
        for reads, kk, lls_ in zip(n.to_numpy(), k.to_numpy(np.int64), lls, strict=True):
            ll, reads, single, doublet = np.asarray(lls_)[None], np.array([reads]), (None,) * 3, (None,) * 5
            end = 1 + kk * len(alpha)
            if kk:
                bic = _criterion(ll[:, 1:end], reads, 1)[0]
                single = (float(bic.min()), *map(int, divmod(bic.argmin(), len(alpha))))
            if kk > 1:
                bic = _criterion(ll[:, end:], reads, 2)[0]
                pair, at = divmod(int(bic.argmin()), len(alpha) * len(rho))
                doublet = (float(bic.min()), *_pairs(kk)[pair], *divmod(at, len(rho)))
            out.append((float(_criterion(ll[:, :1], reads, 0)[0, 0]), dict(zip(("bic", "c", "i"), single, strict=True)), dict(zip(("bic", "c", "d", "i", "j"), doublet, strict=True))))
        return pd.DataFrame(out, columns=["bic_empty", "single", "doublet"])

    return best


def _with_k(sigs: DataFrame, top: DataFrame) -> DataFrame:
    cands = top.groupBy("barcode").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "genome"))), lambda x: x["genome"]).alias("cands"))
    return sigs.join(cands, "barcode", "left").withColumn("k", F.coalesce(F.array_size("cands"), F.lit(0)))


def call_decision(post: DataFrame, mass: DataFrame, eta: dict[str, float], config: MergeConfig = MergeConfig(), phi: DataFrame | None = None, top: DataFrame | None = None) -> DataFrame:
    """The genotype call of each barcode with the figures it rests on; missing values are null.

    ``top``: the candidates, if they come from another mass than the composition.
    """
    top = top if top is not None else topk_genomes(mass, config.topk_genomes)
    chis = chi(phi) if phi is not None else None
    figures = barcode_stats(mass).join(jsd_to_eta(mass, eta, config.jsd_normalize).withColumnRenamed("jsd", "jsd_to_eta"), "barcode", "left")
    own = criteria(signatures(post, eta, top, config.topk_genomes, phi, chis, config.xmap_chi_threshold, soft=not config.winner_only), top, config, figures)
    c = F.col
    low = (c("n_reads") < config.min_reads) | (c("k") == 0)
    inf = F.lit(1e308)
    s, d = F.coalesce("single.bic", inf), F.coalesce("doublet.bic", inf)
    ratio = F.coalesce("ratio12", inf)
    empty = (c("bic_empty") + config.empty_bic_margin < F.least(s, d)) & (c("p_top1") <= config.empty_top1_max) & (ratio <= config.empty_ratio12_max)
    if config.empty_reads_max is not None:
        empty &= c("n_reads") <= config.empty_reads_max
    if config.empty_jsd_max is not None:
        empty &= c("jsd_to_eta") <= config.empty_jsd_max
    one_fits, two_fit = c("single.bic").isNotNull(), c("doublet.bic").isNotNull()
    both = one_fits & two_fit
    core = F.when(both & (s + config.bic_margin < d), "single").when(both & (d + config.bic_margin < s), "doublet").when(both, "ambiguous").when(one_fits, "single").when(two_fit, "doublet").otherwise("uncalled")
    own = own.withColumns({"low": low, "is_empty": ~low & empty, "core": core, "gap": F.when(both, F.abs(s - d))})
    live = ~c("low") & ~c("is_empty")
    model = F.when(c("low"), None).when(c("is_empty"), "empty").when(c("core") == "uncalled", None).when(s <= d, "single").otherwise("doublet")
    near = F.when(live, F.coalesce(c("gap") <= config.near_tie_margin, F.lit(False)))
    own = own.withColumns({"model": model, "near_tie_sd": near})
    one, two = live & (c("model") == "single"), live & (c("model") == "doublet")
    clean = (c("p_top1") >= config.single_mass_min) & (ratio >= config.ratio_top1_top2_min) & ~c("near_tie_sd")
    strong = (c("doublet_minor_frac") >= config.doublet_minor_min) & ~c("near_tie_sd")
    call = (
        F.when(c("low"), "low_reads").when(c("is_empty"), "empty").when(c("core") == "single", F.when(clean, "single_clean").otherwise("dirty_singlet"))
        .when(c("core") == "doublet", F.when(strong, "doublet").otherwise("weak_doublet")).otherwise(c("core"))
    )
    g = lambda i: F.try_element_at("cands", i + 1)
    alpha = F.when(one, c("single.i") * F.lit(config.alpha_grid)).when(two, c("doublet.i") * F.lit(config.alpha_grid))
    own = own.withColumns({"call": call, "genome_1": F.when(one, g(c("single.c"))).when(two, g(c("doublet.c"))), "genome_2": F.when(two, g(c("doublet.d"))), "alpha": alpha, "rho": F.when(two, 0.1 + c("doublet.j") * F.lit(config.rho_grid))})
    out = {
        "bic_best": F.when(c("is_empty"), c("bic_empty")).when(one, c("single.bic")).when(two, c("doublet.bic")),
        "bic_single": F.when(~c("low"), c("single.bic")), "bic_doublet": F.when(~c("low"), c("doublet.bic")), "bic_gap_sd": F.when(live, c("gap")), "purity_best": 1 - c("alpha"),
    }
    own = own.withColumns(out)
    if chis is not None:
        own = own.join(F.broadcast(chis.withColumnRenamed("genome", "chi_genome")), F.when(live, g(c("single.c"))) == c("chi_genome"), "left").withColumnRenamed("chi", "chi_g1")
        own = own.withColumn("xmap_activated", F.coalesce(c("chi_g1") > config.xmap_chi_threshold, F.lit(False)))
    else:
        own = own.withColumns({"chi_g1": F.lit(None).cast("double"), "xmap_activated": F.lit(False)})
    return own.select(
        "barcode", "call", "model", "genome_1", "genome_2", "alpha", "rho", "n_reads", "n_reads_eff", "n_effective", "p_top1", "p_top2", "ratio12", "jsd_to_eta", "bic_empty", "bic_best", "bic_single", "bic_doublet",
        "bic_gap_sd", "near_tie_sd", "doublet_minor_frac", "purity_best", "xmap_activated", "chi_g1",
    )


class Genotyping:
    """The calling stage over an assign table."""

    def __init__(self, assign: DataFrame, config: MergeConfig = MergeConfig(), eta: dict[str, float] | None = None, phi: DataFrame | None = None):
        self.config = config
        reduced = read_quality(promiscuous(reduce_per_genome(from_assign(assign)), config.max_hits, config.hits_delta_mapq, config.hits_guard), config.min_mapq, config.max_xa)
        if config.topk_reclass and config.topk_genomes >= 2:
            reduced = materialize(reduced, "reduced")
            first = topk_genomes(mass_by_genome(posteriors(reduced, config)), config.topk_genomes)
            own = reclass_topk(topk_restrict(reduced, first), config)
            reduced = own if not own.isEmpty() else reduced
        post = posteriors(reduced, config)
        #: what all steps read: profiles of hard assignment, else the posteriors
        self.post = profiles(post) if config.winner_only else materialize(post, "posteriors")
        self.genomes = sorted(r[0] for r in self.post.select("genome").distinct().collect())
        if config.winner_only:
            self.mass = mass_by_genome(self.post)
            exact = config.n_reads_mode != "zero"
            self.reads = self.post.groupBy("barcode").agg((F.sum("n") if exact else F.lit(0).cast("long")).alias("n_reads"))
        else:
            self.mass = materialize(mass_by_genome(self.post), "mass")
            self.reads = n_reads(self.post, config.n_reads_mode)
        self._eta, self._phi = eta, phi

    def eta(self) -> dict[str, float]:
        if self._eta is None:
            self._eta = learn_eta(self.mass, self.reads, self.genomes, self.config)
        return self._eta

    def phi(self) -> DataFrame | None:
        if not self.config.xmap_enabled:
            return None
        if self._phi is None:  # written once: a row for each pair of genomes, read for the rule, the active anchors and chi
            self._phi = materialize(phi_matrix(self.mass, self.reads, self.genomes, self.config), "phi")
        return self._phi

    def calls(self) -> DataFrame:
        post = discounted(self.post, self.config.winner_discount_mode) if self.config.winner_discount else self.post
        mass = mass_by_genome(post) if self.config.winner_discount else self.mass
        # a discount changes likelihoods and composition, but not who the candidates are
        return call_decision(post, mass, self.eta(), self.config, self.phi(), topk_genomes(self.mass, self.config.topk_genomes))
