"""Commands, sample folders and reports over several samples."""

import gzip
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from poolspark import cli, testkit
from poolspark.operators import assign, genotype, qc
from poolspark.plans import samples
from poolspark.sources import bam, tables, workfolder

DIR = "/root/testdata/sf0.001"


def test_help_runs():
    for args in (["--help"], ["run", "--help"], ["assign", "--help"]):
        subprocess.check_call([sys.executable, "-m", "poolspark", *args], stdout=subprocess.DEVNULL, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_options_become_configurations():
    args = cli.parser().parse_args(["run", "--sample", "S", "--genome", "G1,G2", "--bam", "a,b", "--workdir", "w", "--threads", "1", "--alpha", "0.1", "--no-winner-only", "--empty-reads-max", "7", "--ambiguous-policy", "top12_rescue"])
    assert cli._config(cli.AssignConfig, args).alpha == 0.1
    assert (cli._config(cli.MergeConfig, args).winner_only, cli._config(cli.MergeConfig, args).empty_reads_max) == (False, 7)
    assert cli._config(cli.DecontamConfig, args).ambiguous_policy == "top12_rescue"
    assert cli._samples(args)[0].genomes == {"G1": "a", "G2": "b"}
    with pytest.raises(SystemExit):
        cli._samples(cli.parser().parse_args(["run", "--sample", "S"]))
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["nothing"])


def test_discovery_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.discover(spark, f"{tmp_path}/none")
    (tmp_path / "d").mkdir()
    with pytest.raises(FileNotFoundError):
        tables.read_genomes(spark, f"{tmp_path}/d")
    with pytest.raises(FileNotFoundError):
        tables.migrate_all(spark, f"{tmp_path}/d")
    assert cli.main(["assign", "--filtered", f"{tmp_path}/none", "--out", f"{tmp_path}/o"], spark) == 1


def test_stages_from_the_shell(spark, tmp_path):
    """From BAM files to a drop list and a clean BAM."""
    rows = testkit.qc(spark, DIR).where("CAST(substr(BC, 3, 6) AS INT) < 30").drop("BC").withColumnRenamed("BC_raw", "BC")
    for g in ("G1", "G2"):
        bam.write_bam(rows.where(F.col("Genome") == g).drop("Genome").coalesce(1), f"{tmp_path}/{g}.bam")
        ok = lambda *a: cli.main(list(a), spark)
        assert ok("extract", "--bam", f"{tmp_path}/{g}.bam", "--out", f"{tmp_path}/qc_{g}") == 0
        assert ok("filter", "--qc", f"{tmp_path}/qc_{g}", "--out", f"{tmp_path}/f/filtered_{g}_QCMapping.parquet", "--min-barcode-freq", "2", "--sample", "S") == 0
    assert ok("chunks", "--filtered", f"{tmp_path}/f", "--out", f"{tmp_path}/chunks", "--chunk-size-cells", "5") == 0
    assert ok("assign", "--filtered", f"{tmp_path}/f", "--out", f"{tmp_path}/a") == 0
    assert ok("assign", "--filtered", f"{tmp_path}/f", "--out", f"{tmp_path}/a2", "--chunks", f"{tmp_path}/chunks", "--score-chunk-range", "0:2") == 0
    some, every = spark.read.parquet(f"{tmp_path}/a2").drop("chunk_id"), spark.read.parquet(f"{tmp_path}/a")
    own = spark.read.parquet(f"{tmp_path}/chunks").where("chunk_id <= 2")
    assert sorted(map(str, some.collect())) == sorted(map(str, every.join(own, "BC", "left_semi").select(some.columns).collect())) and 0 < some.count() < every.count()
    assert ok("genotyping", "--assign", f"{tmp_path}/a", "--out", f"{tmp_path}/calls.tsv.gz", "--min-reads", "2") == 0
    assert ok("decontam", "--calls", f"{tmp_path}/calls.tsv.gz", "--assign", f"{tmp_path}/a", "--out", f"{tmp_path}/d", "--sample", "S", "--min-reads-post-clean", "1") == 0
    drops = tables.read_drop_list(spark, f"{tmp_path}/d/S_reads_to_drop.tsv.gz")
    assert workfolder.read_json(spark, f"{tmp_path}/d/S_decontam_params.json")["params"]["min_reads_post_clean"] == 1
    (tmp_path / "map.tsv").write_text(f"bam_id\tbam_path\none\t{tmp_path}/G1.bam\ntwo\t{tmp_path}/missing.bam\n")
    with pytest.warns(UserWarning, match="no BAM"):
        assert ok("clean-bams", "--reads-to-drop", f"{tmp_path}/d/S_reads_to_drop.tsv.gz", "--bam-map", f"{tmp_path}/map.tsv", "--out-dir", f"{tmp_path}/clean") == 0
    left = bam.read_bam(spark, f"{tmp_path}/clean/G1.clean.bam")
    want = bam.read_bam(spark, f"{tmp_path}/G1.bam").join(drops.withColumnRenamed("read_id", "Read"), "Read", "left_anti")
    assert left.count() == want.count() > 0
    assert ok("clean-bams", "--reads-to-drop", f"{tmp_path}/d/S_reads_to_drop.tsv.gz", "--out-dir", f"{tmp_path}/clean") == 1


def _winners(path, rows):
    path.parent.mkdir(parents=True)
    with gzip.open(path, "wt") as f:
        f.write("BC\tRead\tGenome\tAS\tXAcount\n" + "".join("\t".join(map(str, r)) + "\n" for r in rows))


def test_reports_over_samples(spark, tmp_path):
    one = [("b1", "r1", "g1", 90, 0), ("b1", "r2", "g1", 80, 0), ("b1", "r3", "G2", 10, 0), ("b2", "r4", "G2", 70, 5), ("b2", "r5", "g1", 60, 0)]
    _winners(tmp_path / "S1/final/S1_per_read_winner.tsv.gz", one)
    _winners(tmp_path / "S2/final/S2_per_read_winner.tsv.gz", [("c", "r", "G2", 5, 0)])
    (tmp_path / "S3/cell_map_ref_chunks").mkdir(parents=True)
    (tmp_path / "S3/cell_map_ref_chunks/S3_cell_genotype_reads_chunk_1.txt").write_text("BC\tRead\tGenome\tAS\nd\tr\tG3\t1\n")
    (tmp_path / "S3/cell_map_ref_chunks/S3_cell_genotype_reads_chunk_2.txt").write_text("")
    (tmp_path / "s.tsv").write_text("sample\tgenome\tbam\tworkdir\n" + "".join(f"{s}\tg1\tx\t{tmp_path}\n" for s in ("S1", "S2", "S3", "S4")))
    read = lambda p: [tuple(r) for r in spark.read.option("sep", "\t").option("header", True).csv(p).collect()]
    assert cli.main(["interpool", "--configs", f"{tmp_path}/s.tsv", "--outdir", f"{tmp_path}/i"], spark) == 0
    assert read(f"{tmp_path}/i/interpool_bc_counts.tsv") == [("S1", "G1", "1", "0.5"), ("S1", "G2", "1", "0.5"), ("S2", "G2", "1", "1.0")]
    assert [r[:3] for r in read(f"{tmp_path}/i/interpool_read_composition.tsv")] == [("S1", "G1", "3"), ("S1", "G2", "2"), ("S2", "G2", "1")]
    (tmp_path / "map.txt").write_text("S1\tA1-2\nS3\tB3\nS9\tC1\n")
    assert cli.main(["plate", "--workdir", str(tmp_path), "--plate-map", f"{tmp_path}/map.txt"], spark) == 0
    assert [r[:3] for r in read(f"{tmp_path}/PlateSummary/plate_per_sample.tsv")] == [("S1", "2", "4"), ("S3", "1", "1")]
    assert len(read(f"{tmp_path}/PlateSummary/plate_heatmap.tsv")) == 96 and len(read(f"{tmp_path}/PlateSummary/plate_per_bc.tsv.gz")) == 3
    assert cli.main(["summarize", "--workdir", str(tmp_path), "--sample", "S1", "--genome", "G2"], spark) == 0
    assert read(f"{tmp_path}/S1/Reads_to_discard_S1.tsv.gz") == [("b1", "r3", "G2", "G1")] and read(f"{tmp_path}/S1/S1_BCs_PASS_by_mapping.tsv") == []
    (tmp_path / "pools.tsv").write_text("Genome\tPool\ng1\ts1\ng3\tother\n")
    assert samples.pool_genomes(f"{tmp_path}/pools.tsv", "S1", []) == ["G1"]
    for bad in (lambda: samples.pool_genomes(f"{tmp_path}/pools.tsv", "S8", []), lambda: samples.plate(spark, f"{tmp_path}/none", f"{tmp_path}/map.txt"), lambda: samples.interpool(spark, {"S9": str(tmp_path)}, "x"), lambda: samples.summarize(spark, str(tmp_path), "S9", [])):
        with pytest.raises((ValueError, FileNotFoundError)):
            bad()


def test_files_of_models_and_json(spark, tmp_path):
    path = str(tmp_path)
    (tmp_path / "eta.tsv").write_text("\teta\nA\t0.5\nB\t1.5\nC\t9\n")
    with pytest.warns(UserWarning, match="normalised"):
        assert genotype.load_eta(workfolder.read_eta(spark, f"{path}/eta.tsv"), ["A", "B"]) == {"A": 0.25, "B": 0.75}
    with pytest.raises(ValueError, match="no eta"):
        genotype.load_eta(workfolder.read_eta(spark, f"{path}/eta.tsv"), ["A", "Z"])
    assert genotype.eta_differences({"B": 0.75, "A": 0.25}) == [("A", "B", -0.5)]
    phi = spark.createDataFrame([("A", "A", 0.9), ("A", "B", 0.1), ("B", "A", 0.0), ("B", "B", 1.0)], "anchor string, target string, phi double")
    workfolder.write_phi(phi, f"{path}/phi.tsv.gz", ["A", "B"])
    assert sorted(map(tuple, workfolder.read_phi(spark, f"{path}/phi.tsv.gz").collect())) == sorted(map(tuple, phi.collect()))
    workfolder.write_tsv_file(genotype.chi(phi), f"{path}/chi.tsv")
    assert dict(map(tuple, workfolder.read_chi(spark, f"{path}/chi.tsv").collect())) == {"A": 0.1, "B": 0.0}
    (tmp_path / "topk.tsv").write_text("x\tG1\tG2\n\ny\tG3\t\n")
    assert sorted(map(tuple, workfolder.read_topk(spark, f"{path}/topk.tsv").collect())) == [("x", 1, "G1"), ("x", 2, "G2"), ("y", 1, "G3")]
    workfolder.write_json(spark, f"{path}/n.json", {"a": [1, None]})
    workfolder.write_json(spark, f"{path}/n.json", {"a": [2]})
    assert workfolder.read_json(spark, f"{path}/n.json") == {"a": [2]} and workfolder.read_json(spark, f"{path}/m.json") is None
    assert json.loads((tmp_path / "n.json").read_text()) == {"a": [2]} and not (tmp_path / "n.json.tmp").exists()


def test_one_header_over_many_parts(spark, tmp_path):
    df = spark.range(1000).repartition(7).select("id", F.when(F.col("id") % 2 == 0, "x").alias("t"))
    for name in ("a.tsv.gz", "a.tsv"):
        workfolder.write_tsv_file(df, f"{tmp_path}/{name}")
        lines = (gzip.open if name.endswith("gz") else open)(f"{tmp_path}/{name}", "rt").read().splitlines()
        assert lines[0] == "id\tt" and sorted(int(x.split("\t")[0]) for x in lines[1:]) == list(range(1000))
        assert not (tmp_path / f"{name}.parts").exists()


def test_outputs_of_the_first_pattern_that_fits(spark, tmp_path):
    own = tmp_path / "chunks/cell_map_ref_chunks"
    own.mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        workfolder.assign_outputs(spark, str(tmp_path))
    (own / "b_filtered.tsv").write_text("x")
    (own / "c_filtered.tsv.gz").write_bytes(b"")  # empty
    assert [os.path.basename(p) for p in workfolder.assign_outputs(spark, str(tmp_path))] == ["b_filtered.tsv"]
    (own / "a_filtered.tsv.gz").write_bytes(b"x")
    (own / "S_chunk_1.txt").write_text("x")
    assert [os.path.basename(p) for p in workfolder.assign_outputs(spark, str(tmp_path))] == ["a_filtered.tsv.gz"]
    assert [os.path.basename(p) for p in workfolder.chunk_lists(spark, str(tmp_path))] == ["S_chunk_1.txt"]


def test_chunk_ranges_and_row_caps(spark):
    chunks = spark.createDataFrame([(f"b{i}", 1 + i // 2) for i in range(8)], "BC string, chunk_id long")
    assert sorted(r["BC"] for r in qc.chunk_slice(chunks, "1:3").collect()) == ["b2", "b3", "b4", "b5"]
    for bad in ("3", "2:2", "a:b", "-1:2", ":"):
        with pytest.raises(ValueError, match="START:END"):
            qc.chunk_slice(chunks, bad)
    rows = testkit.qc(spark, DIR)
    assert {r["count"] for r in qc.cap_rows(rows, 7).groupBy("Genome").count().collect()} == {7} and qc.cap_rows(rows, None) is rows
    capped = assign.Assignment(rows.drop("BC_raw"), cli.AssignConfig(max_rows_per_genome=20)).filtered
    assert capped.count() == 100


def test_migration_follows_a_newer_source(spark, tmp_path):
    rows = testkit.qc(spark, DIR).drop("BC_raw", "Genome").limit(20).withColumnRenamed("as_", "AS")
    source = f"{tmp_path}/filtered_G_QCMapping.txt"
    tables.write_tsv(rows, source, header=True)
    (target,) = tables.migrate_all(spark, str(tmp_path))
    assert target.endswith("filtered_G_QCMapping.parquet") and tables.read_qc(spark, target).count() == 20
    tables.write_tsv(rows.limit(5), source, header=True)
    os.utime(source, (os.path.getmtime(source) + 60,) * 2)
    tables.migrate_all(spark, str(tmp_path))
    assert tables.read_qc(spark, target).count() == 5
