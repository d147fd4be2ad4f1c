"""From calls to allowed genomes, dropped reads and barcodes, and contamination reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poolspark.config import DecontamConfig
from poolspark.functions import barcode

# The classes of contamination rates and their upper ends.
BINS = (("0-1%", 0.01), ("1-5%", 0.05), ("5-10%", 0.10), ("10-20%", 0.20), ("20-50%", 0.50), ("50-100%", 1.0000001))


def with_expected(calls: DataFrame, design: DataFrame | None, config: DecontamConfig = DecontamConfig()) -> DataFrame:
    """Adds bc_key and expected_genome, null for barcodes that the design does not name."""
    own = calls.withColumn("bc_key", barcode.design_key(F.col("barcode"), config.design_bc_mode, config.design_bc_n))
    if design is None:
        return own.withColumn("expected_genome", F.lit(None).cast("string"))
    named = design.where("expected_genome is not null and trim(expected_genome) <> ''").groupBy("bc_key").agg(F.min("expected_genome").alias("expected_genome"))
    return own.join(named, "bc_key", "left")


def _text(c: str) -> Column:
    """Trimmed text; empty for null and for the words that stand for it."""
    flat = F.trim(F.coalesce(F.col(c), F.lit("")))
    return F.when(F.lower(flat).isin("nan", "none"), "").otherwise(flat)


def _names(*texts: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.array(*texts), lambda x: x != "")))


def policy(calls: DataFrame, design: DataFrame | None, config: DecontamConfig = DecontamConfig()) -> DataFrame:
    """barcode, bc_key, call, model, genome_1, genome_2, expected_genome, allowed (sorted array), action, reason, flags.

    The decision table is a list of (condition, allowed, reason); the first that
    holds decides.  An empty set of allowed genomes drops the barcode.
    """
    rows = with_expected(calls, design, config)
    if "indist_set" not in rows.columns:
        rows = rows.withColumn("indist_set", F.lit(None).cast("string"))
    call, model, g1, g2, exp = (_text(c) for c in ("call", "model", "genome_1", "genome_2", "expected_genome"))
    none, pair, first, own = F.array().cast("array<string>"), _names(g1, g2), _names(g1), _names(exp)
    listed = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(_text("indist_set"), ","), lambda x: F.trim(x)), lambda x: x != "")))
    or_else = lambda *sets: F.coalesce(*[F.when(F.size(x) > 0, x) for x in sets], none)
    is_empty = (call == "empty") | (model == "empty")
    ambiguous, weak, indist = call.startswith("ambiguous"), call == "weak_doublet", call == "indistinguishable"
    doublet = (model == "doublet") | call.isin("doublet_confident", "ambiguous_weak_doublet")
    single = (model == "single") | call.isin("single_clean", "ambiguous_dirty_singlet")
    both_d, both_i = config.doublet_policy == "top12", config.indist_policy == "top12"
    on = config.ambiguous_policy
    yes = F.lit(True)

    weak_known = {"drop": (none, "weak_doublet_drop"), "top12": (or_else(pair, own), "weak_doublet_top12")}.get(config.weak_doublet_policy, (own, "weak_doublet_expected_only"))
    weak_free = {"drop": (none, "weak_doublet_drop"), "top12": (pair, "weak_doublet_top12")}.get(config.weak_doublet_policy, (first, "weak_doublet_top1"))
    known = [
        (ambiguous & F.lit(on == "drop"), none, "ambiguous_policy_drop"),
        (doublet, *((or_else(pair, own), "doublet_top12") if both_d else (own, "doublet_expected_only"))),
        (indist, *((or_else(listed, pair, own), "indist_top12") if both_i else (own, "indist_expected_only"))),
        (weak, *weak_known),
        (yes, own, "design_expected_only"),
    ]
    unknown = {"top12_rescue": (pair, "unknown_expected_top12_rescue"), "top1_rescue": (first, "unknown_expected_top1_rescue")}.get(on, (none, "unknown_expected_drop"))
    rescue = {"top12_rescue": (pair, "ambiguous_top12_rescue"), "top1_rescue": (first, "ambiguous_top1_rescue"), "design_rescue": (none, "ambiguous_no_design_drop")}.get(on, (none, "ambiguous_policy_drop"))
    free = [
        (ambiguous, *rescue),
        (doublet, *((pair, "doublet_top12") if both_d else (first, "doublet_fallback_top1"))),
        (indist, *((or_else(listed, pair), "indist_top12") if both_i else (first, "indist_fallback_top1"))),
        (single, first, "single_top1"),
        (weak, *weak_free),
        (yes, none, "unknown_call_drop"),
    ]
    table = [(is_empty, none, "call_empty")]
    flags = [F.when(is_empty, "empty")]
    if design is None:
        table += free
    else:
        unnamed = exp == ""
        if config.strict_design:
            table.insert(0, (unnamed, none, "unknown_in_design_strict"))
            flags[0] = F.when(is_empty & ~unnamed, "empty")
        table += [(unnamed, *unknown), *known]
        live = ~unnamed & ~is_empty
        flags += [
            F.when(unnamed & (F.lit(config.strict_design) | ~is_empty), "unknown_in_design"), F.when(live & (exp == g2) & (exp != g1), "expected_is_top2"),
            F.when(live & (exp != g1) & (exp != g2) & ~F.array_contains(listed, exp), "design_mismatch"),
        ]
    allowed, reason = none, F.lit("unknown_call_drop")
    for cond, value, why in reversed(table):
        allowed, reason = F.when(cond, value).otherwise(allowed), F.when(cond, F.lit(why)).otherwise(reason)
    out = rows.withColumns({"allowed": allowed, "reason": reason, "flags": F.concat_ws(";", *flags)})
    out = out.withColumn("action", F.when(F.size("allowed") > 0, "keep_cleaned").otherwise("drop_barcode"))
    return out.select("barcode", "bc_key", "call", "model", "genome_1", "genome_2", "expected_genome", "allowed", "action", "reason", "flags")


def winners(rows: DataFrame) -> DataFrame:
    """One row for each barcode and read: among rows of class winner if the table has any, else among all."""
    only = rows.where("cls = 'winner'")
    pool = rows if only.isEmpty() else only
    order = [F.desc(F.coalesce("as_", F.lit(-999999))), F.desc(F.coalesce("mapq", F.lit(-1))), F.asc(F.coalesce("nm", F.lit(999999))), F.asc("genome")]
    return pool.withColumn("rn", F.row_number().over(Window.partitionBy("barcode", "read_id").orderBy(*order))).where("rn = 1").drop("rn")


def safe_keep(rows: DataFrame, rules: DataFrame, config: DecontamConfig) -> DataFrame:
    """(barcode, read_id, best_allowed_as, best_disallowed_as, safe_keep), from one aggregation."""
    own = rows.join(rules.select("barcode", "allowed"), "barcode", "left").withColumn("ok", F.coalesce(F.array_contains("allowed", F.col("genome")), F.lit(False)))
    yes = lambda f, c: f(F.when(F.col("ok"), F.col(c)))
    best = own.groupBy("barcode", "read_id").agg(yes(F.max, "as_").alias("best_allowed_as"), F.max(F.when(~F.col("ok"), F.col("as_"))).alias("best_disallowed_as"), yes(F.max, "mapq").alias("best_mapq"), yes(F.min, "nm").alias("best_nm"))
    keep = F.col("best_allowed_as") >= F.col("best_disallowed_as") - config.safe_keep_delta_as
    if config.safe_keep_mapq_min is not None:
        keep &= F.col("best_mapq") >= config.safe_keep_mapq_min
    if config.safe_keep_nm_max is not None:
        keep &= F.col("best_nm") <= config.safe_keep_nm_max
    return best.select("barcode", "read_id", "best_allowed_as", "best_disallowed_as", (F.coalesce(keep, F.lit(False)) & F.lit(config.safe_keep_delta_as > 0)).alias("safe_keep"))


def judged(rows: DataFrame, rules: DataFrame, config: DecontamConfig = DecontamConfig()) -> DataFrame:
    """The winner of each read of a called barcode with confident, keep, dropped and reason."""
    own = winners(rows.join(rules.select("barcode"), "barcode", "left_semi")).join(rules.select("barcode", "bc_key", "allowed", "action"), "barcode", "left")
    if config.safe_keep_delta_as > 0:
        own = own.join(safe_keep(rows, rules, config).select("barcode", "read_id", "safe_keep"), ["barcode", "read_id"], "left")
    else:
        own = own.withColumn("safe_keep", F.lit(False))
    sure = F.lit(True)
    if config.decontam_alpha is not None:
        sure = F.coalesce(F.col("p_as") <= config.decontam_alpha, F.lit(not config.require_p_as))
    lost = F.coalesce("action", F.lit("keep_cleaned")) != "keep_cleaned"
    inside = F.coalesce(F.array_contains("allowed", F.col("genome")), F.lit(False)) | F.coalesce("safe_keep", F.lit(False))
    own = own.withColumns({"confident": sure, "drop_barcode": lost})
    own = own.withColumn("keep", ~F.col("drop_barcode") & F.col("confident") & inside)
    own = own.withColumn("dropped", F.col("confident") & ~F.col("keep"))
    return own.withColumn("reason", F.when(F.col("dropped"), F.when(F.col("drop_barcode"), "drop_barcode").otherwise("mismatch_winner")))


def drop_list(rows: DataFrame) -> DataFrame:
    return rows.where("dropped").select("read_id", "barcode", "bc_key", F.array_join("allowed", ",").alias("allowed_set"), F.col("genome").alias("winner_genome"), "p_as", "reason")


def counts(rows: DataFrame, which: str) -> DataFrame:
    """Confident (``pre``) or kept (``post``) winners of each barcode and genome."""
    return rows.where("confident" if which == "pre" else "keep").groupBy("barcode", "genome").agg(F.count("*").alias("n_winner_reads"))


def composition(pre: DataFrame, expected: DataFrame) -> DataFrame:
    """What each barcode holds, against what its design names."""
    own = pre.join(expected.select("barcode", "expected_genome"), "barcode", "left")
    out = own.groupBy("barcode", "expected_genome").agg(
        F.sum("n_winner_reads").alias("total_reads"), F.min_by("genome", F.struct(-F.col("n_winner_reads"), "genome")).alias("top_genome"), F.max("n_winner_reads").alias("top_reads"),
        F.sum(F.when(F.col("genome") == F.col("expected_genome"), F.col("n_winner_reads")).otherwise(0)).alias("expected_reads"),
    )
    share = F.when(F.col("expected_genome").isNotNull(), F.col("expected_reads") / F.col("total_reads"))
    return out.withColumns({"top_frac": F.col("top_reads") / F.col("total_reads"), "expected_frac": share}).withColumn("contamination_rate", 1 - F.col("expected_frac"))


def contamination_bins(comp: DataFrame) -> DataFrame:
    """Barcodes in each class of contamination for every expected genome, empty classes included."""
    spark = comp.sparkSession
    own = comp.where("expected_genome is not null")
    label = F.lit(None).cast("string")
    for name, end in reversed(BINS):
        label = F.when(F.col("contamination_rate") < end, name).otherwise(label)
    n = own.groupBy("expected_genome", label.alias("bin_label")).agg(F.count("*").alias("n"))
    every = own.select("expected_genome").distinct().crossJoin(F.broadcast(spark.createDataFrame([(b,) for b, _ in BINS], "bin_label string")))
    return every.join(n, ["expected_genome", "bin_label"], "left").select("expected_genome", "bin_label", F.coalesce("n", F.lit(0)).alias("n_barcodes"))


def postclean_gate(post: DataFrame, rules: DataFrame, config: DecontamConfig = DecontamConfig()) -> DataFrame:
    """Whether enough allowed reads are left, for every called barcode."""
    own = rules.select("barcode", "allowed").join(post, "barcode", "left")
    inside = F.coalesce(F.array_contains("allowed", F.col("genome")), F.lit(False))
    n = F.coalesce("n_winner_reads", F.lit(0))
    out = own.groupBy("barcode").agg(F.sum(n).alias("post_total_reads"), F.sum(F.when(inside, n).otherwise(0)).alias("post_allowed_reads"))
    out = out.withColumn("post_allowed_frac", F.when(F.col("post_total_reads") > 0, F.col("post_allowed_reads") / F.col("post_total_reads")).otherwise(0.0))
    few, mixed = F.col("post_allowed_reads") < config.min_reads_post_clean, F.col("post_allowed_frac") < config.min_allowed_frac
    reason = F.when(few, f"allowed_reads_post<{config.min_reads_post_clean}").when(mixed, f"allowed_frac_post<{config.min_allowed_frac}").otherwise("keep")
    return out.withColumns({"keep_postclean": ~few & ~mixed, "drop_reason": reason})


def calls_decontam(calls: DataFrame, rules: DataFrame, gate: DataFrame) -> DataFrame:
    own = rules.select("barcode", "expected_genome", F.array_join("allowed", ",").alias("allowed_set"), "action", "reason", "flags")
    return calls.join(own, "barcode", "left").join(gate, "barcode", "left")


def clean(reads: DataFrame, drops: DataFrame, id_col: str = "Read") -> DataFrame:
    """Alignments without those of dropped reads."""
    ids = drops.where("read_id is not null").select(F.col("read_id").alias(id_col)).distinct()
    return reads.join(ids, id_col, "left_anti")
