"""Small cases with values worked out by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from poolspark.config import AssignConfig, DecontamConfig, MergeConfig
from poolspark.functions import barcode
from poolspark.operators import assign, decontam, genotype, qc, reports
from poolspark.plans import ordered


def one(df, column):
    return df.first()[column]


def test_edges_are_left_ends_of_the_bins_that_reach_the_targets(spark):
    hist = spark.createDataFrame([("mapq", b, n) for b, n in enumerate([0, 0, 5, 5, 0, 10, 0, 0, 0, 0]) if n], "metric string, bin int, n long")
    edges = assign.collect_edges(assign.decile_edges(hist, AssignConfig(k=4, mapq_bins=(0, 10, 10))))
    assert edges["mapq"] == [2.0, 3.0, 5.0]


def test_decile_counts_edges_below(spark):
    df = spark.createDataFrame([(2.0,), (2.5,), (5.0,), (6.0,), (None,)], "v double").select(assign.decile(F.col("v"), [2.0, 3.0, 5.0], 4).alias("d"))
    assert [r["d"] for r in df.collect()] == [1, 2, 3, 4, 4]


def test_tail_probabilities(spark):
    hist = spark.createDataFrame([("as", 1, 0, 4), ("as", 1, 20, 3), ("as", 1, 114, 2), ("as", 1, 200, 1)], "metric string, decile int, bin int, n long")
    p = {r["bin"]: r["p"] for r in assign.tail_prob(hist).where("metric = 'as'").collect()}
    assert [round(p[b], 9) for b in (0, 10, 20, 114, 198, 200)] == [1.0, 0.6, 0.6, 0.3, 0.1, 0.1]


def _mass(spark, rows):
    return spark.createDataFrame(rows, "barcode string, genome string, c double")


def test_jsd(spark):
    eta = {"A": 0.5, "B": 0.5}
    assert one(genotype.jsd_to_eta(_mass(spark, [("x", "A", 8.0), ("x", "B", 2.0)]), eta), "jsd") == pytest.approx(0.073104, abs=1e-6)
    assert one(genotype.jsd_to_eta(_mass(spark, [("x", "A", 3.0), ("x", "B", 3.0)]), eta), "jsd") == pytest.approx(0, abs=1e-9)
    assert one(genotype.jsd_to_eta(_mass(spark, [("x", "A", 1.0)]), {"A": 0.0, "B": 1.0}), "jsd") == pytest.approx(1, abs=1e-6)


def test_softmax(spark):
    rows = [("b", "r", g, s, 0, 0, 0, "ambiguous") for g, s in (("A", 150), ("B", 147), ("C", 120))]
    red = spark.createDataFrame(rows, "barcode string, read_id string, genome string, as_ int, mapq int, nm int, xa int, cls string")
    got = {r["genome"]: r for r in genotype.posteriors(red, MergeConfig(winner_only=False)).collect()}
    assert [round(got[g]["l"], 6) for g in "ABC"] == [0.951668, 0.047381, 0.0]
    assert got["A"]["l_amb"] == pytest.approx(0.000952, abs=1e-6)


def _call(spark, a, b, **options):
    config = MergeConfig(**options)
    post = spark.createDataFrame([("x", f"r{i}", "A" if i < a else "B", 1.0, 0.001, 1.0) for i in range(a + b)], "barcode string, read_id string, genome string, l double, l_amb double, w_read double")
    mass = genotype.mass_by_genome(post).unionByName(_mass(spark, [("x", "B", 0.0)])) if not b else genotype.mass_by_genome(post)
    return genotype.call_decision(post, mass, {"A": 0.5, "B": 0.5}, config).first()


@pytest.mark.parametrize(
    ("a", "b", "empty", "single", "doublet", "call", "model"),
    [
        (10, 0, 13.862944, 2.302585, 6.712380, "ambiguous", "single"), (9, 1, 13.862944, 8.804245, 11.106830, "ambiguous", "single"), (95, 5, 138.629436, 44.308219, 52.254689, "single_clean", "single"),
        (70, 30, 138.629436, 128.058322, 131.383201, "ambiguous", "single"), (50, 50, 138.629436, 172.002814, 147.839776, "doublet", "doublet"),
    ],
)
def test_likelihood_grid_and_call(spark, a, b, empty, single, doublet, call, model):
    r = _call(spark, a, b)
    assert (r["bic_empty"], r["bic_single"], r["bic_doublet"]) == pytest.approx((empty, single, doublet), abs=2e-5)
    assert (r["call"], r["model"]) == (call, model)


@pytest.mark.parametrize("most", [1, 7, 8192])
def test_signatures_dealt_to_several_rows_give_the_same_criteria(spark, monkeypatch, most):
    monkeypatch.setattr(genotype, "MOST", most)
    monkeypatch.setattr(genotype, "BLOCK", 3)
    post = spark.range(120).selectExpr("concat('b', id % 3) AS barcode", "concat('r', id) AS read_id", "explode(array('A', 'B', 'C')) AS genome", "1D AS w_read").selectExpr(
        "*", "(1 + pmod(hash(read_id, genome), 997)) / 3000 AS l", "0.001D AS l_amb"
    )
    post = post.where("NOT (barcode = 'b1' AND genome <> 'A')").where("NOT (barcode = 'b2' AND genome = 'C')")
    top, eta = genotype.topk_genomes(genotype.mass_by_genome(post), 3), {"A": 0.5, "B": 0.3, "C": 0.2}
    whole = {r["barcode"]: r for r in genotype.criteria(genotype.signatures(post, eta, top, 3), top).collect()}
    dealt = genotype.criteria(genotype.signatures(post, eta, top, 3, soft=True), top).collect()
    assert sorted(r["barcode"] for r in dealt) == sorted(whole) == ["b0", "b1", "b2"]
    for r in dealt:
        want = whole[r["barcode"]]
        assert (r["n_reads"], r["n_reads_eff"], r["cands"], r["k"]) == (want["n_reads"], want["n_reads_eff"], want["cands"], want["k"])
        assert r["bic_empty"] == pytest.approx(want["bic_empty"], abs=1e-6)
        for grid in ("single", "doublet"):
            (bic, *at), (bic_, *at_) = r[grid], want[grid]
            assert at == at_ and bic == (pytest.approx(bic_, abs=1e-6) if bic_ is not None else None)


def test_few_reads_are_not_called(spark):
    assert _call(spark, 3, 1)["call"] == "low_reads"


def test_near_tie_with_a_small_margin(spark):
    assert _call(spark, 9, 1, bic_margin=1.0, near_tie_margin=3.0)["call"] == "dirty_singlet"


def test_promiscuous_reads(spark):
    rows = [("b", "r", f"G{i}", 100, m, 0, 0, "ambiguous") for i, m in enumerate((40, 40, 39, 10))]
    red = spark.createDataFrame(rows, "barcode string, read_id string, genome string, as_ int, mapq int, nm int, xa int, cls string")
    assert genotype.promiscuous(red, 2, 1).count() == 0
    assert genotype.promiscuous(red, 3, 1).count() == 4
    assert genotype.promiscuous(red, 2, 1, guard=3).count() == 4
    assert genotype.promiscuous(red, None, 1).count() == 4


@pytest.mark.parametrize(
    ("classes", "scores", "winner"),
    [(("winner", "rescued"), (1, 9), "A"), (("rescued", "rescued", "ambiguous"), (5, 7, 6), "B"), (("rescued", "ambiguous"), (1, 9), "A"), (("ambiguous", "ambiguous"), (5, 5), None)],
)
def test_reclassification_tiers(spark, classes, scores, winner):
    rows = [("b", "r", "ABC"[i], s, 0, 0, 0, c) for i, (c, s) in enumerate(zip(classes, scores, strict=True))]
    red = spark.createDataFrame(rows, "barcode string, read_id string, genome string, as_ int, mapq int, nm int, xa int, cls string")
    won = [r["genome"] for r in genotype.reclass_topk(red).where("cls = 'winner'").collect()]
    assert won == ([winner] if winner else [])


def test_rescue_window(spark):
    schema = "Read string, BC string, Genome string, assigned_class string, frag_loc string"
    rows = [
        ("w", "b", "A", "winner", "chr1:1000:1200"), ("in", "b", "A", "ambiguous", "chr1:1700:5000"), ("out", "b", "A", "ambiguous", "chr1:1701:5000"), ("chr", "b", "A", "ambiguous", "chr2:1000:1200"),
        ("genome", "b", "B", "ambiguous", "chr1:1000:1200"), ("bc", "c", "A", "ambiguous", "chr1:1000:1200"), ("mate", "b", "A", "ambiguous", "chr1:9000:-1"), ("star", "b", "A", "ambiguous", "*:1000:1200"), ("none", "b", "A", "ambiguous", None),
    ]
    got = {r["Read"]: r["assigned_class"] for r in assign.friend_rescue(spark.createDataFrame(rows, schema)).collect()}
    assert {k for k, v in got.items() if v == "rescued"} == {"in"}
    assert got["w"] == "winner"


def test_keep_and_drop(spark):
    rules = spark.createDataFrame([("b1", "b1", ["A"], "keep_cleaned"), ("b2", "b2", [], "drop_barcode")], "barcode string, bc_key string, allowed array<string>, action string")
    rows = [("b1", "r1", "A", 9, 9, 0, 0, "winner", 0.01), ("b1", "r2", "B", 9, 9, 0, 0, "winner", None), ("b1", "r3", "B", 9, 9, 0, 0, "winner", 0.2), ("b2", "r4", "A", 9, 9, 0, 0, "winner", 0.01), ("b3", "r5", "A", 9, 9, 0, 0, "winner", 0.01)]
    reads = spark.createDataFrame(rows, "barcode string, read_id string, genome string, as_ int, mapq int, nm int, xa int, cls string, p_as double")
    out = {r["read_id"]: (r["keep"], r["dropped"], r["reason"]) for r in decontam.judged(reads, rules, DecontamConfig(decontam_alpha=0.05)).collect()}
    assert out == {"r1": (True, False, None), "r2": (False, True, "mismatch_winner"), "r3": (False, False, None), "r4": (False, True, "drop_barcode")}
    strict = {r["read_id"] for r in decontam.judged(reads, rules, DecontamConfig(decontam_alpha=0.05, require_p_as=True)).where("dropped").collect()}
    assert strict == {"r4"}


def test_post_clean_gate(spark):
    rules = spark.createDataFrame([(b, ["A"]) for b in ("few", "mixed", "good", "none")], "barcode string, allowed array<string>")
    post = spark.createDataFrame([("few", "A", 95), ("mixed", "A", 110), ("mixed", "B", 15), ("good", "A", 120)], "barcode string, genome string, n_winner_reads long")
    got = {r["barcode"]: (r["keep_postclean"], r["drop_reason"]) for r in decontam.postclean_gate(post, rules).collect()}
    assert got == {"few": (False, "allowed_reads_post<100"), "mixed": (False, "allowed_frac_post<0.9"), "good": (True, "keep"), "none": (False, "allowed_reads_post<100")}


def test_contamination_classes(spark):
    comp = spark.createDataFrame([(str(r), "A", r) for r in (0.0, 0.01, 0.05, 0.5, 1.0)], "barcode string, expected_genome string, contamination_rate double")
    got = {r["bin_label"]: r["n_barcodes"] for r in decontam.contamination_bins(comp).collect()}
    assert got == {"0-1%": 1, "1-5%": 1, "5-10%": 1, "10-20%": 0, "20-50%": 0, "50-100%": 2}


def test_normalised_barcodes(spark):
    df = spark.createDataFrame([(None,), ("",), ("AC-x-y",)], "b string").select(barcode.normalized(F.col("b"), " a b ").alias("n"))
    assert [r["n"] for r in df.collect()] == ["", "", "AC-a_b"]


@pytest.mark.parametrize(("mode", "n", "want"), [("before-dash", 10, "AACC"), ("full", 10, "AACC-s1"), ("last", 3, "ACC"), ("first", 3, "AAC")])
def test_design_keys(spark, mode, n, want):
    assert one(spark.createDataFrame([("AA_C.C-s:1",)], "b string").select(barcode.design_key(F.col("b"), mode, n).alias("k")), "k") == want


def test_frequent_barcodes(spark):
    rows = [(f"r{i}", b, 30, 1, 0, 0, "x") for i, b in enumerate(["CCC"] + ["AAA"] * 3 + ["BBB"] * 2)]
    df = spark.createDataFrame(rows, "Read string, BC string, MAPQ int, as_ int, NM int, XAcount int, frag_loc string")
    assert sorted(r["BC"] for r in qc.frequent_barcodes(df, 2).collect()) == ["AAA"] * 3 + ["BBB"] * 2
    assert qc.frequent_barcodes(df, 9).count() == 0
    mixed = df.withColumn("BC", F.when(F.col("BC") == "CCC", "AAA-other").otherwise(F.col("BC")))
    assert {r["BC"]: r["count"] for r in qc.frequent_barcodes(mixed, 4, "X").groupBy("BC").count().collect()} == {"AAA-X": 4}


def test_chunks(spark):
    bcs = spark.createDataFrame([(f"B{i}",) for i in range(5)], "BC string")
    assert [r["chunk_id"] for r in qc.barcode_chunks(bcs, 2).orderBy("BC").collect()] == [1, 1, 2, 2, 3]
    with pytest.raises(ValueError, match="positive"):
        qc.barcode_chunks(bcs, 0)


def test_wells(spark):
    got = {r["well"] for r in reports.wells(spark.createDataFrame([("s", "A1-3, b12")], "sample string, wells string")).collect()}
    assert got == {"A1", "A2", "A3", "B12"}
    for bad in ("A3-1", "Z1", "A13"):
        with pytest.raises(Exception, match="bad well range"):
            reports.wells(spark.createDataFrame([("s", bad)], "sample string, wells string")).collect()


def test_layout(spark):
    layout = spark.createDataFrame([("A", "AA_C", "GG"), ("B", "TT", "CC")], "row string, `1` string, `2` string")
    got = {r["well"]: r["barcode"] for r in reports.layout_barcodes(layout).collect()}
    assert got == {"A1": "AA_C", "A2": "GG", "B1": "TT", "B2": "CC"}
    assert {r["bc_key"] for r in reports.design_by_wells(spark.createDataFrame([("G1", "A1")], "sample string, wells string"), layout).collect()} == {"AAC"}


def test_winner_discount_modes(spark):
    post = spark.createDataFrame([("b", "1", "A", 4.0, 0.0, 1.0), ("b", "2", "B", 1.0, 0.0, 1.0), ("b", "3", "B", 0.4, 0.0, 0.4), ("b", "4", "C", 0.4, 0.0, 0.4)], "barcode string, read_id string, genome string, l double, l_amb double, w_read double")
    got = {m: {r["genome"]: round(r["discount"], 6) for r in genotype.winner_discount(post, m).collect()} for m in ("winner_ratio", "total_ratio")}
    assert got == {"winner_ratio": {"A": 1.0, "B": 0.25, "C": 0.0}, "total_ratio": {"A": 1.0, "B": 0.35, "C": 0.0}}


def test_given_profile_is_checked(spark):
    rows = spark.createDataFrame([("A", 2.0), ("B", 2.0), ("X", 9.0)], "genome string, eta double")
    assert genotype.load_eta(rows, ["A", "B"]) == {"A": 0.5, "B": 0.5}
    with pytest.raises(ValueError, match="C"):
        genotype.load_eta(rows, ["A", "C"])


def test_cross_mapping_replaces_the_anchor_likelihood(spark):
    rows = [("A", "A", 0.7), ("A", "B", 0.3), ("B", "A", 0.0), ("B", "B", 1.0)]
    phi = spark.createDataFrame(rows, "anchor string, target string, phi double")
    assert {r["genome"]: r["chi"] for r in genotype.chi(phi).collect()} == {"A": 0.3, "B": 0.0}
    post = spark.createDataFrame([("x", f"r{i}", "A" if i < 80 else "B", 1.0, 0.001, 1.0) for i in range(100)], "barcode string, read_id string, genome string, l double, l_amb double, w_read double")
    mass = genotype.mass_by_genome(post)
    own = genotype.call_decision(post, mass, {"A": 0.5, "B": 0.5}, MergeConfig(), phi).first()
    plain = genotype.call_decision(post, mass, {"A": 0.5, "B": 0.5}).first()
    assert own["xmap_activated"] and own["chi_g1"] == pytest.approx(0.3)
    assert own["bic_single"] > plain["bic_single"] and own["bic_doublet"] == plain["bic_doublet"]


def test_whole_stage_with_every_option(spark):
    from poolspark import testkit

    rows = assign.Assignment(testkit.qc(spark, "/root/testdata/sf0.001").drop("BC_raw")).result()
    config = MergeConfig(winner_only=False, topk_reclass=True, winner_discount=True, winner_discount_mode="total_ratio", max_hits=3, hits_delta_mapq=5, min_mapq=20, max_xa=2, xmap_phi_min_reads=5)
    calls = genotype.Genotyping(rows, config).calls()
    assert calls.groupBy("barcode").count().where("count > 1").count() == 0
    assert calls.count() > 100 and calls.where("call is null or n_reads is null").count() == 0


def test_sampled_models(spark):
    from poolspark import testkit

    rows = testkit.qc(spark, "/root/testdata/sf0.001").drop("BC_raw")
    own = assign.Assignment(rows, AssignConfig(sample_barcodes=20))
    assert own._sampled().select("BC").distinct().count() <= 20 < own.two.select("BC").distinct().count()
    assert qc.sample_barcodes(rows, 20, 1).count() == 20 and qc.sample_barcodes(rows, 0).count() == 150


@pytest.mark.parametrize("most", [0, 10**6])
def test_running_sums_over_ranges(spark, monkeypatch, most):
    from poolspark.plans import ordered
    from poolspark.plans.ordered import running_sums

    monkeypatch.setattr(ordered, "ONE_TASK", most)

    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit(2).alias("v")).repartition(7)
    got = {r["k"]: (r["n"], r["s"]) for r in running_sums(df, "k", {"n": F.lit(1), "s": F.col("v")}).collect()}
    assert got == {k: (k + 1, 2 * (k + 1)) for k in range(1000)}


@pytest.mark.parametrize("most", [0, 10**6])
def test_exact_quantiles(spark, monkeypatch, most):
    from poolspark.plans import ordered

    monkeypatch.setattr(ordered, "ONE_TASK", most)
    import numpy as np

    from poolspark.plans.ordered import quantiles

    v = [float(x) for x in np.random.default_rng(1).integers(0, 40, 333)]
    df = spark.createDataFrame([(x,) for x in v] + [(None,)], "v double").repartition(5)
    assert quantiles(df, "v", [0.0, 0.2, 0.5, 0.95, 1.0]) == pytest.approx([float(np.quantile(v, q)) for q in (0.0, 0.2, 0.5, 0.95, 1.0)])
    assert quantiles(df.where("v < 0"), "v", [0.5]) == [None]


@pytest.mark.parametrize("most", [3, 500_000])
def test_quantiles_of_groups(spark, monkeypatch, most):
    monkeypatch.setattr("poolspark.plans.ordered.ONE_TASK", most)
    rows = [(g, float(v % 7) if v % 5 else None) for g, n in (("a", 1), ("b", 2), ("c", 60), (None, 31)) for v in range(1, n + 1)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["mid"], r["high"]) for r in ordered.group_quantiles(df, "g", "v", {"mid": 0.5, "high": 0.95}).collect()}
    assert set(got) == {"a", "b", "c", None, "none"} and got.pop("none") == (None, None)
    for g, found in got.items():
        values = [v for h, v in rows if h == g and v is not None]
        assert found == pytest.approx((np.quantile(values, 0.5), np.quantile(values, 0.95)))


def test_heat_counts_keep_values_beyond_the_ranges(spark):
    df = spark.createDataFrame([(0.05, 3), (0.05, 40), (0.05, 41), (1.0, 5000), (-0.1, -2), (None, 3), (0.5, None)], "x double, y long")
    got = sorted(map(tuple, reports.heat_counts(df, "x", "y", 10, 8, (0.0, 1.0), (0.0, 40.0)).collect()))
    assert got == [(0, 0, 2), (0, 7, 2), (9, 7, 1)]


def test_barcode_goes_to_the_highest_mean_score(spark):
    rows = [("b", f"r{i}", "a", 50, 0) for i in range(5)] + [("b", "s1", "B", 90, 1), ("b", "s2", "B", 80, None), ("b", "t", "C", 200, 3)]
    table = spark.createDataFrame([(*r, "winner") for r in rows] + [("b", "u", "C", 300, 0, "ambiguous")], "BC string, Read string, Genome string, as_ int, XAcount int, assigned_class string")
    reads = reports.winner_reads(table)
    got = reports.as_mean_assign(reads).first().asDict()
    assert got == {"BC": "b", "total_n": 7, "assigned_genome": "B", "top1_as_mean": 85.0, "top1_n": 2, "second_genome": "A", "top2_as_mean": 50.0, "as_gap": 35.0}
    rate = reports.contamination_rate(reads, reports.as_mean_assign(reads)).first()
    assert (rate["n_reads"], rate["n_mismatch"]) == (7, 5)
    assert [r["Read"] for r in reports.reads_to_discard(reads, reports.as_mean_assign(reads)).collect()] == [f"r{i}" for i in range(5)]
    assert reports.as_mean_assign(reports.winner_reads(table, xa_max=-1)).first()["assigned_genome"] == "C"


def test_means_that_tie_go_to_more_reads_then_by_name(spark):
    rows = [("x", "1", "B", 10), ("x", "2", "B", 10), ("x", "3", "A", 10), ("y", "1", "B", 10), ("y", "2", "A", 10), ("z", "1", "A", None), ("z", "2", "B", 1)]
    got = reports.as_mean_assign(spark.createDataFrame(rows, "BC string, Read string, Genome string, as_ int"))
    assert {r["BC"]: r["assigned_genome"] for r in got.collect()} == {"x": "B", "y": "A", "z": "B"}


def test_discount_keeps_the_candidates(spark):
    """C holds more mass than B but no winner mass; with two candidates C stays one and B does not come in."""
    post = [("b", f"a{i}", "A", 1.0, 1.0) for i in range(20)] + [("b", f"b{i}", "B", 0.6, 0.6) for i in range(5)] + [("b", f"c{i}", "C", 0.4, 0.4) for i in range(10)]
    own = spark.createDataFrame([(*r[:4], 0.001, r[4]) for r in post], "barcode string, read_id string, genome string, l double, l_amb double, w_read double")
    config = genotype.MergeConfig(topk_genomes=2, winner_discount=True, xmap_enabled=False)
    seen = genotype.topk_genomes(genotype.mass_by_genome(own), 2)
    cut = genotype.discounted(own, config.winner_discount_mode)
    eta = {g: 1 / 3 for g in "ABC"}
    call = lambda **k: genotype.call_decision(cut, genotype.mass_by_genome(cut), eta, config, **k).first()
    assert [r["genome"] for r in seen.orderBy("rank").collect()] == ["A", "C"]
    assert call(top=seen)["bic_doublet"] != call()["bic_doublet"]


def test_best_alignments_by_read(spark):
    schema = "Read string, BC string, Genome string, MAPQ smallint, as_ int, NM int, XAcount smallint, frag_loc string"
    rows = [("r", "b", "A", 30, 90, 1, 0, "x"), ("r", "b", "A", 31, 90, 1, 2, "y"), ("r", "b", "A", 31, 90, 1, 1, "z"), ("r", "b", "B", 60, None, 0, 0, "x"), ("r", "b", "C", 60, 99, None, 0, None), ("r", "b", "D", None, 90, 1, None, "w")]
    own = spark.createDataFrame([*rows, ("s", "b", "B", 1, 2, 3, 0, "q"), (None, None, "B", 1, 2, 3, 0, "q"), ("r", "b", "A", 31, 90, 1, 1, "z")], schema)
    got = {r["Read"]: r for r in assign.by_read(own).collect()}
    assert [(g["Genome"], g["MAPQ"], g["as_"], g["NM"], g["XAcount"], g["frag_loc"]) for g in got["r"]["genomes"]] == [("B", 60, None, 0, 0, "x"), ("A", 31, 90, 1, 1, "z"), ("D", None, 90, 1, None, "w"), ("C", 60, 99, None, 0, None)]
    assert [got["r"][c] for c in ("g1", "nm1", "g2", "as2", "mq2", "gl", "asl", "nml", "n_genomes")] == ["B", 0, "A", 90, 31, "A", 90, 1, 4]
    assert (got["s"]["g1"], got["s"]["g2"], got["s"]["gl"], got[None]["n_genomes"]) == ("B", None, "B", 1)
    ranked = assign.rank_genomes(assign.dedup_read_genome(own)).where("Read = 'r'").orderBy("rk").collect()
    assert [r["Genome"] for r in ranked] == ["B", "A", "D", "C"] and [r["rk_worst"] for r in ranked].index(1) == 1


def test_rescue_agrees_with_all_pairs(spark):
    import random

    r = random.Random(7)
    rows = []
    for i in range(600):
        chrom, at = r.choice(["c1", "c2", "*"]), r.randrange(0, 9000)
        rows.append((f"r{i}", r.choice("xy"), r.choice("AB"), r.choice(["winner", "ambiguous", "ambiguous", None]), r.choice([f"{chrom}:{at}:{at + r.randrange(400, 700)}", f"{chrom}:{at}:-1", f"{chrom}:-1:-1", "", None])))
    ends = lambda f: [int(p) for p in f.split(":")[1:] if not p.startswith("-")] if f and f[0] != "*" else []
    near = lambda a: any(w[3] == "winner" and w[1:3] == a[1:3] and w[4] and w[4].split(":")[0] == a[4].split(":")[0] and abs(p - q) <= 500 for w in rows for p in ends(a[4]) for q in ends(w[4]))
    want = {a[0]: "rescued" if a[3] == "ambiguous" and near(a) else a[3] for a in rows}
    got = assign.friend_rescue(spark.createDataFrame(rows, "Read string, BC string, Genome string, assigned_class string, frag_loc string")).collect()
    assert len(got) == len(rows) and {x["Read"]: x["assigned_class"] for x in got} == want and "rescued" in want.values()


@pytest.mark.parametrize("options", [{}, {"winner_discount": True}, {"n_reads_mode": "zero"}, {"w_ambiguous": 0.25, "topk_genomes": 4}])
def test_profiles_give_the_calls_of_posteriors(spark, options):
    """Everything after hard assignment rests on counts by barcode, genome and weight."""
    from poolspark import testkit

    config = MergeConfig(xmap_phi_min_reads=5, **options)
    rows = assign.Assignment(testkit.qc(spark, "/root/testdata/sf0.001").drop("BC_raw")).result()
    post = genotype.posteriors(genotype.reduce_per_genome(genotype.from_assign(rows)), config)
    own = genotype.Genotyping(rows, config)
    assert own.post.columns == ["barcode", "genome", "w_read", "n", "l"]
    plain = lambda df: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)
    assert plain(own.mass) == plain(genotype.mass_by_genome(post)) and plain(own.reads) == plain(genotype.n_reads(post, config.n_reads_mode))
    slow = genotype.Genotyping(rows, config)
    slow.post, slow.mass, slow.reads = post, genotype.mass_by_genome(post), genotype.n_reads(post, config.n_reads_mode)
    assert plain(own.calls()) == plain(slow.calls())


def test_calls_move_nothing_after_the_profiles(spark):
    from poolspark import testkit

    rows = assign.Assignment(testkit.qc(spark, "/root/testdata/sf0.001").drop("BC_raw")).result()
    own = genotype.Genotyping(rows, MergeConfig())
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # tables by barcode are not small on a cluster
    try:
        plan = genotype.call_decision(own.post, own.mass, own.eta(), own.config, None, genotype.topk_genomes(own.mass, 3))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Bucketed: true" in plan


def _exchanges(df):
    """Shuffles of the plan before it runs."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_reads_are_dealt_once_for_their_genomes(spark):
    rows = spark.createDataFrame([("b", "r", "A", 9, 9, 0, 0, "winner")], "barcode string, read_id string, genome string, as_ int, mapq int, nm int, xa int, cls string")
    assert _exchanges(genotype.posteriors(genotype.reduce_per_genome(rows))) == 1


def _joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")


@pytest.mark.parametrize(("weight", "joins"), [(1.0, 0), (0.25, 2)])
def test_the_rescue_is_left_out_where_classes_weigh_the_same(spark, weight, joins):
    rows = [("r1", "b", "A", 30, 90, 0, 0, "winner", "c1:100:300"), ("r2", "b", "A", 30, 80, 0, 0, "ambiguous", "c1:350:600"), ("r2", "b", "B", 30, 70, 0, 0, "ambiguous", "c1:9000:-1"), ("r3", "b", "B", 30, 70, 0, 0, "ambiguous", "c1:1:2"), ("r4", "b", "A", 30, 60, 0, 0, "ambiguous", "c1:90:120")]
    own = assign.friend_rescue(spark.createDataFrame(rows, "Read string, BC string, Genome string, MAPQ int, as_ int, NM int, XAcount int, assigned_class string, frag_loc string"))
    post = genotype.posteriors(genotype.reduce_per_genome(genotype.from_assign(own)), MergeConfig(w_ambiguous=weight))
    assert _joins(post) == joins
    assert {r["read_id"]: (r["genome"], r["w_read"]) for r in post.collect()} == {"r1": ("A", 1.0), "r2": ("A", 1.0), "r3": ("B", weight), "r4": ("A", 1.0)}


def test_winners_are_read_without_the_rescue(spark):
    rows = [("r1", "b", "A", 90, "winner", "c1:100:300"), ("r2", "b", "A", 80, "ambiguous", "c1:350:600"), ("r3", "b", "B", 80, None, "c1:350:600")]
    own = assign.friend_rescue(spark.createDataFrame(rows, "Read string, BC string, Genome string, as_ int, assigned_class string, frag_loc string"))
    won = reports.winner_reads(own)
    assert _joins(won) == 0 and [r["Read"] for r in won.collect()] == ["r1"]


def test_equal_signatures_are_evaluated_once():
    import numpy as np

    seen, r = [], np.random.default_rng(1)
    cnt, e, v = r.integers(1, 9, (500, 4)).astype(float), r.choice([0.1, 0.2, 0.3], (500, 4)), r.choice([0.0, 1.0], (500, 4))
    grid = np.arange(26) * 0.02

    def values(e, v):
        seen.append(len(e))
        return (1 - grid) * v + grid * e

    got = genotype._grid_sums(cnt, [e, v], values)
    want = (np.log(np.maximum((1 - grid) * v[..., None] + grid * e[..., None], genotype.TINY)) * cnt[..., None]).sum(1)
    assert seen == [6] and np.allclose(got, want, rtol=1e-12)
