"""Readers, writers, the stage pipeline and the stream."""

import gzip

import pytest
from pyspark.sql import functions as F

from poolspark import testkit
from poolspark.config import MergeConfig, SampleConfig, samples_from_tsv
from poolspark.plans import pipeline
from poolspark.schema import QC
from poolspark.sources import bam, tables
from poolspark.streaming import counts

ROWS = [("r1", "AAA-1", 30, 90, 1, 2, "chr1:100:300"), ("r2", None, 0, None, None, 0, "chr2:5:-1"), ("r3", "CCC", 60, -4, 0, 0, "chr1:7:7")]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, QC)


def same(df):
    return sorted(map(tuple, df.select(*QC.fieldNames()).collect()), key=repr) == sorted(ROWS, key=repr)


def test_tsv(spark, rows, tmp_path):
    tables.write_tsv(rows, f"{tmp_path}/a", compression="gzip")
    assert same(tables.read_qc_tsv(spark, f"{tmp_path}/a"))
    tables.write_tsv(rows.withColumnRenamed("as_", "AS"), f"{tmp_path}/b", header=True)
    assert same(tables.read_qc_tsv(spark, f"{tmp_path}/b", header=True))


def test_sorted_parquet_and_schema_check(spark, rows, tmp_path):
    tables.write_sorted(rows, f"{tmp_path}/p")
    assert same(tables.read_qc(spark, f"{tmp_path}/p"))
    tables.write_sorted(rows.where("false"), f"{tmp_path}/e")
    assert tables.read_qc(spark, f"{tmp_path}/e").count() == 0
    rows.drop("NM").write.parquet(f"{tmp_path}/bad")
    with pytest.raises(ValueError, match="columns"):
        tables.read_qc(spark, f"{tmp_path}/bad")


def test_discovery_prefers_parquet_only_if_it_is_complete(spark, rows, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.discover(spark, f"{tmp_path}/none")
    tables.write_sorted(rows, f"{tmp_path}/filtered_Zm_v5_QCMapping.parquet")
    assert set(tables.discover(spark, str(tmp_path))) == {"Zm_v5"}
    (tmp_path / "filtered_B_QCMapping.tsv").write_text("Read\tBC\tMAPQ\tAS\tNM\tXAcount\n" + "r\tb\t1\t2\t3\t4\n")
    (tmp_path / "filtered_Zm_v5_QCMapping.tsv").write_text("Read\tBC\tMAPQ\tAS\tNM\tXAcount\n")
    found = tables.discover(spark, str(tmp_path))
    assert set(found) == {"B", "Zm_v5"} and all(p.endswith(".tsv") for p in found.values())
    got = tables.read_genomes(spark, str(tmp_path)).collect()
    assert [(r["Genome"], r["as_"], r["frag_loc"]) for r in got] == [("B", 2, "")]


def test_bam(spark, rows, tmp_path):
    bam.write_bam(rows, f"{tmp_path}/b")
    back = bam.read_bam(spark, f"{tmp_path}/b")
    assert same(back)
    assert {r["BC"] for r in bam.read_bam(spark, f"{tmp_path}/b", "S").collect()} == {"AAA-S", "CCC-S", ""}
    one = rows.coalesce(1)
    bam.write_bam(one, f"{tmp_path}/one")
    source = next((tmp_path / "one").glob("*.bam"))
    bam.clean_bam(spark, str(source), spark.createDataFrame([("r2",), (None,)], "read_id string"), f"{tmp_path}/clean")
    assert {r["Read"] for r in bam.read_bam(spark, f"{tmp_path}/clean").collect()} == {"r1", "r3"}
    with gzip.open(source) as f, gzip.open(next((tmp_path / "clean").glob("*.bam"))) as g:
        assert bam.header(f) == bam.header(g)


def test_sam(spark, tmp_path):
    lines = ["@HD\tVN:1.6", "a\t1\tchr1\t101\t30\t5M\t=\t301\t0\t*\t*\tCB:Z:AAA\tAS:i:90\tNM:i:1\tXA:Z:x;y;", "b\t0\tchr2\t6\t0\t5M\t*\t0\t0\t*\t*\tBC:Z:CCC", "c\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*", "d\t256\tchr1\t9\t1\t5M\t*\t0\t0\t*\t*", "e\t2048\tchr1\t9\t1\t5M\t*\t0\t0\t*\t*"]
    (tmp_path / "x.sam").write_text("\n".join(lines) + "\n")
    got = sorted(map(tuple, bam.read_sam(spark, f"{tmp_path}/x.sam").collect()))
    assert got == [("a", "AAA", 30, 90, 1, 2, "chr1:100:300"), ("b", "CCC", 0, None, None, 0, "chr2:5:-1")]


def test_calls_text(spark):
    df = spark.createDataFrame([("b", 0.123456789, None, 3)], "barcode string, alpha double, model string, n int")
    assert tuple(tables.formatted_calls(df).first()) == ("b", "0.123457", "", "3")
    with pytest.raises(ValueError, match="more than one call"):
        tables.formatted_calls(df.union(df))


def test_aliases(spark):
    df = spark.createDataFrame([("r", "b", "g")], "read_id string, Barcode string, GENOME string")
    assert tables.renamed(df, ("Read", "BC", "Genome")).columns == ["Read", "BC", "Genome"]
    with pytest.raises(ValueError, match="Genome"):
        tables.renamed(df.drop("GENOME"), ("Genome",))


def test_plate_map(spark, tmp_path):
    (tmp_path / "m.txt").write_text("# plate\nG1\tA1-12,B3 # all\n\n")
    assert [tuple(r) for r in tables.read_plate_map(spark, f"{tmp_path}/m.txt").collect()] == [("G1", "A1-12,B3")]


def test_sample_tables(tmp_path):
    (tmp_path / "s.tsv").write_text("sample\tgenome\tbam\tworkdir\ns\tA\ta.bam\tw\ns\tB\tb.bam\tw\n")
    assert samples_from_tsv(f"{tmp_path}/s.tsv") == [SampleConfig("s", "w", {"A": "a.bam", "B": "b.bam"})]
    (tmp_path / "s.tsv").write_text("sample\tgenome\tbam\tworkdir\ns\tA\ta.bam\tw\ns\tA\tb.bam\tw\n")
    with pytest.raises(ValueError, match="twice"):
        samples_from_tsv(f"{tmp_path}/s.tsv")


def test_pipeline_keeps_stage_outputs(spark, tmp_path):
    all_rows = testkit.qc(spark, "/root/testdata/sf0.001").drop("BC").withColumnRenamed("BC_raw", "BC")
    by = {f"G{i}": all_rows.where(F.col("Genome") == f"G{i}").drop("Genome") for i in range(5)}
    out = pipeline.run(spark, by, str(tmp_path), "S1", source_key="a", min_barcode_freq=5)
    assert out["calls_decontam"].count() == out["calls"].count() > 100
    made = {p.name: p.stat().st_mtime for p in tmp_path.iterdir()}
    pipeline.run(spark, by, str(tmp_path), "S1", source_key="a", min_barcode_freq=5)
    assert {p.name: p.stat().st_mtime for p in tmp_path.iterdir()} == made
    pipeline.run(spark, by, str(tmp_path), "S1", source_key="a", min_barcode_freq=5, merge_config=MergeConfig(min_reads=6), last="calls")
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("calls-")]) == 2


def test_stream_counts(spark, rows, tmp_path):
    rows.union(rows).repartition(3).write.parquet(f"{tmp_path}/in")
    got = {r["BC"]: r["n_rows"] for r in counts.run(spark, f"{tmp_path}/in", QC).collect()}
    assert got == {"AAA-1": 2, None: 2, "CCC": 2}


def test_assign_and_calls_tables(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("Barcode\tread_id\tGenome\tAS\tMAPQ\tNM\tassigned_class\tp_as\nb\tr\tA\t90\tx\t\twinner\t0.5\n")
    got = tables.read_assign(spark, f"{tmp_path}/a.tsv").first()
    assert (got["BC"], got["Read"], got["as_"], got["MAPQ"], got["NM"], got["p_as"]) == ("b", "r", 90, None, None, 0.5)
    (tmp_path / "c.tsv").write_text("BC\tcall\nb\tdoublet\n")
    calls = tables.read_calls(spark, f"{tmp_path}/c.tsv")
    assert calls.columns == ["barcode", "call", "model", "genome_1", "genome_2", "indist_set"]
    (tmp_path / "d.tsv").write_text("read_id\tx\nr1\t1\nr1\t2\n\t3\n")
    assert [r["read_id"] for r in tables.read_drop_list(spark, f"{tmp_path}/d.tsv").collect()] == ["r1"]
    (tmp_path / "e.tsv").write_text("barcode\texpected_genome\nAA_C-x\tG1\n")
    assert tuple(tables.read_design(spark, f"{tmp_path}/e.tsv").first()) == ("AAC", "G1")


def test_migration_runs_once(spark, rows, tmp_path):
    tables.write_tsv(rows.withColumnRenamed("as_", "AS"), f"{tmp_path}/t", header=True)
    tables.migrate(spark, f"{tmp_path}/t", f"{tmp_path}/p", mapq_min=30, xa_max=2)
    assert {r["Read"] for r in tables.read_qc(spark, f"{tmp_path}/p").collect()} == {"r1", "r3"}
    before = (tmp_path / "p" / "_SUCCESS").stat().st_mtime_ns
    tables.migrate(spark, f"{tmp_path}/t", f"{tmp_path}/p")
    assert (tmp_path / "p" / "_SUCCESS").stat().st_mtime_ns == before


def test_models_are_kept(spark, tmp_path):
    from poolspark.operators import assign

    own = assign.Assignment(testkit.qc(spark, "/root/testdata/sf0.001").drop("BC_raw"))
    edges, tails = assign.decile_edges(own.hist()), assign.tail_prob(own.deltas(own.edges()))
    tables.save_model(edges, tails, f"{tmp_path}/m")
    e, t = tables.load_model(spark, f"{tmp_path}/m")
    assert assign.collect_edges(e) == own.edges() and t.count() == tails.count()
    again = assign.assign_raw(own.reads, assign.collect_edges(e), t)
    assert sorted(map(str, again.collect())) == sorted(map(str, own.raw().collect()))


def test_quality_histogram_stream(spark, rows, tmp_path):
    rows.write.parquet(f"{tmp_path}/in")
    assert {r["MAPQ"]: r["n_rows"] for r in counts.run(spark, f"{tmp_path}/in", QC, counts.quality_histogram).collect()} == {30: 1, 0: 1, 60: 1}


def test_bucketed_tables_lie_in_the_shared_folder(spark):
    from poolspark.plans import shared

    own = shared.materialize_bucketed(spark.range(100), "probe", 4, "id")
    assert own.count() == 100
    plain = lambda p: p.replace("file:", "").lstrip("/")
    assert all(plain(f).startswith(plain(shared.shared_dir(spark))) for f in own.inputFiles())
    name = [t.name for t in spark.catalog.listTables() if t.name.startswith("poolspark_probe_")]
    assert len(name) == 1
    shared._forget(spark, name[0])
    assert not spark.catalog.tableExists(name[0])


def test_all_genomes_in_one_scan(spark, rows, tmp_path):
    for g in ("A", "B 1+x", "Zm_v5"):
        tables.write_sorted(rows, f"{tmp_path}/filtered_{g}_QCMapping.parquet")
    got = tables.read_genomes(spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["Genome"]: r["count"] for r in got.groupBy("Genome").count().collect()} == dict.fromkeys(("A", "B 1+x", "Zm_v5"), rows.count())
    assert got.drop("Genome").columns == QC.fieldNames() and same(got.where("Genome = 'B 1+x'").drop("Genome"))
    rows.drop("NM").write.parquet(f"{tmp_path}/filtered_C_QCMapping.parquet")
    with pytest.raises(ValueError, match="columns"):
        tables.read_genomes(spark, str(tmp_path))


def test_texts_of_several_headers(spark, tmp_path):
    (tmp_path / "filtered_A_QCMapping.tsv").write_text("Read\tBC\tMAPQ\tAS\tNM\tXAcount\nr\tb\t1\t2\t3\t4\n")
    (tmp_path / "filtered_B_QCMapping.tsv").write_text("Read\tBC\tMAPQ\tAS\tNM\tXAcount\ns\tb\t5\tx\t\t4\n")
    (tmp_path / "filtered_C_QCMapping.txt").write_text("BC\tRead\tMAPQ\tas\tNM\tXAcount\tfrag_loc\nb\tt\t1\t2\t3\t4\tchr1:1:2\n")
    got = tables.read_genomes(spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert sorted((r["Genome"], r["Read"], r["as_"], r["NM"], r["frag_loc"]) for r in got.collect()) == [("A", "r", 2, 3, ""), ("B", "s", None, None, ""), ("C", "t", 2, 3, "chr1:1:2")]


def test_bad_lines_and_files_are_set_aside(spark, tmp_path):
    import gzip

    head = "Read\tBC\tGenome\tAS\n"
    whole = {f"p{i}.tsv.gz": head + "".join(f"r{i}_{j}\tb\tG\t{j}\n" for j in range(200)) for i in range(5)}
    whole["p1.tsv.gz"] += "lost\tb\n" + "more\tb\tG\t1\t2\t3\n" + "odd\tb\tG\tx\n"
    for name, text in whole.items():
        data = gzip.compress(text.encode())
        (tmp_path / name).write_bytes(data[: len(data) // 2] if name in ("p3.tsv.gz", "p4.tsv.gz") else data)
    paths = [f"{tmp_path}/{n}" for n in sorted(whole)]
    own = tables.read_checked(spark, paths, ("BC", "Read", "Genome"))
    assert [p[-9:] for p in own.bad_files] == ["p3.tsv.gz", "p4.tsv.gz"]
    assert sorted(r["line"].split("\t")[0] for r in own.bad_lines.collect()) == ["lost", "more"]
    rows = tables.read_assign(spark, paths, quarantine=f"{tmp_path}/q")
    assert rows.count() == 601 and rows.where("Read = 'odd'").first()["as_"] is None
    listed = {r["path"][-9:]: (r["n_bad_lines"], r["readable"]) for r in spark.read.parquet(f"{tmp_path}/q/files").collect()}
    assert listed == {"p1.tsv.gz": (2, True), "p3.tsv.gz": (None, False), "p4.tsv.gz": (None, False)}
    assert spark.read.parquet(f"{tmp_path}/q/lines").count() == 2
    with pytest.raises(ValueError, match="none of 2 files"):
        tables.read_checked(spark, paths[3:])
    with pytest.raises(ValueError, match="no column"):
        tables.read_checked(spark, paths[:1], ("MAPQ",))


def test_bam_rows_pass_in_arrow_batches(spark, tmp_path):
    rows = spark.range(25_000).selectExpr("concat('r', id) AS Read", "'B' AS BC", "30S AS MAPQ", "IF(id % 3 = 0, NULL, 90) AS as_", "0 AS NM", "1S AS XAcount", "'chr1:1:-1' AS frag_loc")
    bam.write_bam(rows.coalesce(1), f"{tmp_path}/b")
    own = bam._Reader({"path": f"{tmp_path}/b"})
    batches = [b for p in own.partitions() for b in own.read(p)]
    assert [b.num_rows for b in batches] == [10_000, 10_000, 5_000]
    assert bam.read_bam(spark, f"{tmp_path}/b").drop("flag").exceptAll(rows).count() == 0 and sum(b.column("as_").null_count for b in batches) == 8334
