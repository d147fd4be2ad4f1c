"""Scoring by chunks: ranges add up, lost runs go on, models are learned once."""

import pytest
from pyspark.sql import functions as F

from poolspark import catalogue, cli
from poolspark.config import AssignConfig
from poolspark.operators import assign, qc
from poolspark.plans import chunked

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return catalogue.Views(spark, DIR).qc.drop("BC_raw").localCheckpoint()


@pytest.fixture(scope="module")
def chunks(spark, rows):
    return qc.barcode_chunks(qc.distinct_barcodes(rows), 40).localCheckpoint()


@pytest.fixture(scope="module")
def whole(rows):
    return plain(assign.Assignment(rows).result().where("BC <> ''"))


def plain(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def start(spark, folder, rows, chunks, **options):
    own = chunked.ChunkedScoring(spark, str(folder), **options)
    own.reads(rows, chunks)
    return own


def test_ranges_add_up_to_one_run(spark, tmp_path, rows, chunks, whole):
    own = start(spark, tmp_path / "a", rows, chunks)
    assert own.chunk_ids() == [1, 2, 3, 4]
    assert own.score("2:9") == [3, 4]
    with pytest.raises(ValueError, match="2 of 4 chunks"):
        own.result()
    part = own.result(partly=True)
    assert {r[0] for r in part.select("BC").distinct().collect()} <= {r["BC"] for r in chunks.where("chunk_id > 2").collect()}
    assert own.score("0:2", batch=1) == [1, 2]
    assert plain(own.result()) == plain(chunked.finished_rows(spark, str(tmp_path / "a"))) == whole
    assert own.score() == []


def test_a_lost_run_goes_on(spark, tmp_path, rows, chunks, whole, monkeypatch):
    own, real = start(spark, tmp_path / "a", rows, chunks), chunked.workfolder.write_json

    def lost(spark, path, value):
        if "/manifest/2-" in path:  # rows of chunk 2 are there, but not its note
            raise KeyboardInterrupt
        real(spark, path, value)

    monkeypatch.setattr(chunked.workfolder, "write_json", lost)
    with pytest.raises(KeyboardInterrupt):
        own.score(batch=1)
    monkeypatch.setattr(chunked.workfolder, "write_json", real)
    first = sorted(p for p in (tmp_path / "a" / "chunk_id=1").iterdir())
    monkeypatch.setattr(assign, "winner_hist", None)  # models are there and not learned again
    again = chunked.ChunkedScoring(spark, str(tmp_path / "a"))
    assert sorted(again.finished()) == [1]
    assert again.score(learn_edges=False, learn_tails=False) == [2, 3, 4]
    assert sorted(p for p in (tmp_path / "a" / "chunk_id=1").iterdir()) == first
    assert plain(again.result()) == whole


def test_state_belongs_to_one_configuration(spark, tmp_path, rows, chunks):
    start(spark, tmp_path / "a", rows, chunks).score("0:1")
    with pytest.raises(ValueError, match="another input or configuration"):
        chunked.ChunkedScoring(spark, str(tmp_path / "a"), AssignConfig(alpha=0.2))
    with pytest.raises(ValueError, match="another input or configuration"):
        chunked.ChunkedScoring(spark, str(tmp_path / "a"), source="changed")
    anew = start(spark, tmp_path / "a", rows, chunks, config=AssignConfig(alpha=0.2), force=True)
    assert anew.finished() == {}
    anew.score()
    assert plain(anew.result()) == plain(assign.Assignment(rows, AssignConfig(alpha=0.2)).result().where("BC <> ''"))


def test_models_are_asked_for(spark, tmp_path, rows, chunks):
    own = start(spark, tmp_path / "a", rows, chunks)
    with pytest.raises(FileNotFoundError, match="no edges"):
        own.score(learn_edges=False)
    with pytest.raises(ValueError, match="no reads"):
        chunked.ChunkedScoring(spark, str(tmp_path / "b")).score()


def test_counters_of_the_filter(spark, tmp_path, rows, chunks):
    own = start(spark, tmp_path / "a", rows, chunks)
    low, many = ~F.coalesce(F.col("MAPQ") >= 20, F.lit(False)), ~F.coalesce(F.col("XAcount") <= 2, F.lit(False))
    assert own.filtered() == {"n_rows": rows.count(), "n_low_mapq": rows.where(low).count(), "n_many_hits": rows.where(~low & many).count(), "n_kept": qc.alignment_filter(rows).count()}
    counts = own.score("0:1") and own.finished()[1]
    assert sum(counts.values()) == own.result(partly=True).count()


def test_barcodes_without_a_chunk_and_empty_tables(spark, tmp_path, rows, chunks):
    some = start(spark, tmp_path / "a", rows, chunks.where("chunk_id = 2"))
    assert some.score() == [2]
    full = {r["metric"]: r["n"] for r in assign.Assignment(rows).hist().groupBy("metric").agg(F.sum("n").alias("n")).collect()}
    two = some.reads().drop("genomes", "chunk_id")
    assert {r["metric"]: r["n"] for r in assign.winner_hist(two).groupBy("metric").agg(F.sum("n").alias("n")).collect()} == full
    none = start(spark, tmp_path / "b", rows.where("false"), chunks)
    assert none.score() == [] and none.result().collect() == []


def test_ranges_from_the_shell(spark, tmp_path, rows, chunks, whole, capsys):
    from poolspark.sources import tables

    for g in [r[0] for r in rows.select("Genome").distinct().collect()]:
        tables.write_sorted(rows.where(F.col("Genome") == g).drop("Genome"), f"{tmp_path}/f/filtered_{g}_QCMapping.parquet")
    chunks.write.parquet(f"{tmp_path}/chunks")
    run = lambda *more: cli.main(["assign", "--filtered", f"{tmp_path}/f", "--chunks", f"{tmp_path}/chunks", "--out", f"{tmp_path}/a", *more], spark)
    assert run("--score-chunk-range", "0:2") == 0 and run("--score-chunk-range", "2:4", "--skip-edges", "--skip-ecdf") == 0
    assert '"scored": [3, 4]' in capsys.readouterr().out
    assert plain(cli._assigned(spark, f"{tmp_path}/a")) == whole
    assert run("--score-chunk-range", "4:2") == 1
    assert cli.main(["assign", "--filtered", f"{tmp_path}/f", "--out", f"{tmp_path}/x", "--score-chunk-range", "0:1"], spark) == 1


def test_many_small_chunks_are_few_jobs_and_files(spark, tmp_path, rows, whole, monkeypatch):
    small = qc.barcode_chunks(qc.distinct_barcodes(rows), 2).localCheckpoint()
    own = start(spark, tmp_path / "a", rows, small)
    done = own.score()
    assert len(done) == 75 == len(list((tmp_path / "a").glob("chunk_id=*/*.parquet")))
    assert len(list((tmp_path / "a.state" / "manifest").glob("*.json"))) == 1
    assert len(list((tmp_path / "a.state" / "reads").rglob("*.parquet"))) <= 4
    assert sum(own.sizes().values()) == own.reads().where("chunk_id > 0").count()
    assert plain(own.result()) == whole
    monkeypatch.setattr(chunked, "BATCH_READS", max(own.sizes().values()))
    parts = list(own._batches(done, None))
    assert [c for p in parts for c in p] == done and 1 < len(parts) < 75
    assert all(sum(own.sizes()[c] for c in p) <= chunked.BATCH_READS for p in parts)
