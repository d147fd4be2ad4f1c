"""Models from counts that add up."""

import pytest
from pyspark.sql import functions as F

from poolspark import catalogue, cli
from poolspark.config import AssignConfig
from poolspark.operators import assign
from poolspark.sources import tables, workfolder
from poolspark.streaming import models

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def own(spark):
    return assign.Assignment(catalogue.Views(spark, DIR).qc.drop("BC_raw"))


def plain(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def test_batches_add_up_to_the_whole(spark, own, tmp_path):
    state = models.ModelState(spark, f"{tmp_path}/s")
    part = lambda i: own.two.where(F.pmod(F.xxhash64("Read"), F.lit(3)) == i)
    state.add(part(0), 0)
    state.add(part(1), 1)
    some = plain(state.models()[1])
    state.add(part(2), 2)
    edges, tails = state.models()
    assert plain(edges) == plain(assign.decile_edges(own.hist())) and plain(tails) == plain(own.tails) != some
    state.add(part(1), 1)  # the same batch again
    assert plain(state.models()[1]) == plain(own.tails)
    state.add(part(2).where("false"), 2)
    assert plain(state.models()[1]) == some


def test_no_reads_no_models(spark, tmp_path):
    edges, tails = models.ModelState(spark, f"{tmp_path}/s").models()
    assert edges.collect() == [] and tails.collect() == []


def test_values_beyond_the_bins_and_missing_ones(spark, tmp_path):
    rows = [("r1", "b", 250, 60, 0, 100, 60, 1), ("r2", "b", None, 10, 0, 5, 10, 1), ("r3", "b", 200, 0, 0, None, None, None), ("r4", "b", -3, 60, 0, 90, 3, 0), ("r5", "b", 40, 61, 1, 40, 20, 0)]
    two = spark.createDataFrame([(r, b, "G1", a, m, n, None if a2 is None and m2 is None else "G2", a2, m2, n2) for r, b, a, m, n, a2, m2, n2 in rows], "Read string, BC string, g1 string, as1 int, mq1 short, nm1 int, g2 string, as2 int, mq2 short, nm2 int")
    state = models.ModelState(spark, f"{tmp_path}/s")
    state.add(two, 7)
    edges, tails = state.models()
    want = assign.decile_edges(assign.winner_hist(two))
    assert plain(edges) == plain(want)
    assert plain(tails) == plain(assign.tail_prob(assign.delta_hist(assign.best_two_delta(two), assign.collect_edges(want))))


def test_a_stream_that_starts_again_counts_once(spark, own, tmp_path):
    own.two.repartition(3).write.parquet(f"{tmp_path}/in")
    state = models.ModelState(spark, f"{tmp_path}/s")
    read = lambda: spark.readStream.schema(own.two.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    state.follow(read(), f"{tmp_path}/c").awaitTermination()
    state.follow(read(), f"{tmp_path}/c").awaitTermination()
    state.follow(read(), f"{tmp_path}/lost").awaitTermination()  # all batches once more, as after a lost checkpoint
    assert state.counts().select("batch_id").distinct().count() == 3
    assert plain(state.models()[1]) == plain(own.tails)


def test_model_files_from_the_shell(spark, tmp_path):
    rows = catalogue.Views(spark, DIR).qc.drop("BC_raw")
    for g in ("G0", "G1", "G2"):
        tables.write_sorted(rows.where(F.col("Genome") == g).drop("Genome"), f"{tmp_path}/f/filtered_{g}_QCMapping.parquet")
    run = lambda *a: cli.main(list(a), spark)
    assert run("assign", "--filtered", f"{tmp_path}/f", "--out", f"{tmp_path}/a", "--save-model", f"{tmp_path}/m") == 0
    assert run("assign", "--filtered", f"{tmp_path}/f", "--out", f"{tmp_path}/b", "--model", f"{tmp_path}/m", "--k", "10") == 0
    assert plain(spark.read.parquet(f"{tmp_path}/a")) == plain(spark.read.parquet(f"{tmp_path}/b"))
    assert run("genotyping", "--assign", f"{tmp_path}/a", "--out", f"{tmp_path}/calls.tsv", "--models-out", f"{tmp_path}/g", "--xmap-phi-min-reads", "5") == 0
    assert {r["genome"] for r in workfolder.read_eta(spark, f"{tmp_path}/g/eta.tsv").collect()} == {"G0", "G1", "G2"}
    assert workfolder.read_phi(spark, f"{tmp_path}/g/phi.tsv").count() == 9 and workfolder.read_chi(spark, f"{tmp_path}/g/chi.tsv").count() == 3
    (tmp_path / "topk.tsv").write_text("".join(f"{r['BC']}\tG1\tG2\n" for r in rows.select("BC").distinct().collect()))
    assert run("genotyping", "--assign", f"{tmp_path}/a", "--out", f"{tmp_path}/top.tsv", "--topk", f"{tmp_path}/topk.tsv") == 0
    named = {r[0] for r in tables.read_calls(spark, f"{tmp_path}/top.tsv").select("genome_1").distinct().collect()}
    assert named <= {"G1", "G2", "", None} and AssignConfig().sample_barcodes == 0
