"""The corpus pipeline, stage by stage."""

import hashlib
import struct

import corpus_pipeline
import pytest
from poolspark.llm import queries
from tests.llm import brute

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR).cache()
        out.append(docs)
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_keep_the_columns_of_documents(spark, outputs):
    want = spark.read.parquet(f"{DIR}/documents.parquet").dtypes
    assert [o.dtypes for o in outputs[:-1]] == [want] * 4


def test_quality_keeps_good_documents(spark, outputs):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    kept = {r["doc_id"] for r in outputs[0].collect()}
    own = labels.collect()
    assert sum((r["quality"] == 1) == (r["doc_id"] in kept) for r in own) > 0.95 * len(own)


def test_lines_near_duplicates_and_leaks(spark, outputs):
    quality, lines, near, leaks, _ = outputs
    want = {i: t for i, (_, _, t) in brute.dedup_lines(rows(quality)).items()}
    assert dict(rows(lines)) == want
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    groups = brute.components(rows(lines))
    assert {i for i, _ in rows(near)} == {i for i, (_, root) in groups.items() if i == root}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    found = {i for i, _ in brute.leaks(rows(near), items)}
    assert {i for i, _ in rows(leaks)} == {i for i, _ in rows(near)} - found


def test_tokens_of_what_is_left(outputs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.word_vocabulary())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in outputs[4].collect()}
    for i, text in rows(outputs[3]):
        ids = tok.encode(text, add_special_tokens=False).ids
        assert got[i] == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())


def test_run_is_the_stages_in_order(spark, outputs):
    got = sorted(map(tuple, corpus_pipeline.run(spark, DIR).collect()))
    assert got == sorted(map(tuple, outputs[4].collect()))


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{DIR}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DIR}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


AWKWARD = [
    (1, "the first line of a longer text that stays as it is\nand a second one", "en"), (None, None, "en"), (None, "", None), (3, None, None), (4, "  \n ", "de"), (5, "", "en"),
    (6, " ".join(f"w{k}" for k in range(80)), "en"), (7, " ".join(f"w{k}" for k in range(1, 81)), "en"), (7, "another text under the same id that is a copy of nothing at all", "en"),
    (None, " ".join(f"w{k}" for k in range(2, 82)), "fr"), (8, " ".join(f"w{k}" for k in range(80)), "en"), (8, " ".join(f"w{k}" for k in range(80)), "en"), (9, "z" * 2_500_000, "en"),
]


@pytest.fixture
def awkward(spark, tmp_path):
    spark.createDataFrame([(i, "b " * 30) for i in range(2)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_on_awkward_tables(spark, awkward):
    names = "score long, drop_id long, keys string, lost long, leak_id long, component_id long, sid long, w long"
    extra = (1, 2, "k", 3, 4, 5, 6, 7)
    docs = spark.createDataFrame([(*r, *extra) for r in AWKWARD], f"doc_id long, text string, lang string, {names}")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, awkward)
        assert [c for c in out.columns if c != "n_chars"] == docs.columns, name
        kept[name] = sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in out.collect())
    every = sorted((i or 0, len(t or "")) for i, t, _ in AWKWARD)
    assert kept["quality classifier"] == kept["benchmark decontamination"] == every
    assert len(kept["line dedup"]) == len(AWKWARD)
    # the copies of 6 go; 7 has a text of its own beside its copy, rows without an id have others beside theirs
    assert kept["near duplicates"] == [x for x in every if x[0] != 8]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, awkward)
    assert last.count() == len(AWKWARD)


def test_stages_on_an_empty_table(spark, awkward):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, awkward).collect() == []
