"""The text operators against SQL, the tokenizers library and plain versions."""

import hashlib
import random
import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from poolspark.llm import bpe, components, decontam, jaccard_join, labelled, line_dedup, quality_mil, quality_rules, queries, secrets, sharding, token_count, url_filter
from tests import oracle
from tests.llm import brute

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
ODD = [
    None, "", "   ", "\n\t", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "It's I'LL we'RE 'sx ''s 12.5% ½", "İstanbul ΣΑΣ J̌ é ﬁ 中文 한국어 ​ ẞ",
    "x\x1cy\x85z\xa0w v", "\U0001f600\U0001f44d\U0001f3fd", "a" * 60_000, "ÀÉÎ" * 2000, "<|endoftext", "<| |>", "a b c d e " * 5000, "one line of text here\n" * 40,
]


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(DIR)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIR}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], DOCS)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.word_vocabulary())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    oracle.check(spark, duck, queries.QUERIES[name], queries.ORACLE_SQL[name], DIR)


# ---- every operator on awkward tables

APPLY = {
    "bpe": lambda d: bpe.digests(bpe.encode(d, queries.word_vocabulary(), decode=True)),
    "tokens": lambda d: token_count.token_counts(d, queries.word_vocabulary()),
    "lines": lambda d: line_dedup.digests(line_dedup.dedup(d)),
    "shards": lambda d: sharding.shard_map(d, 1000),
    "rules": lambda d: quality_rules.judge(d, [[quality_rules.Term("symbols", True, 0.5)]]),
    "mil": lambda d: quality_mil.judge(d, None),
    "near": lambda d: jaccard_join.near_duplicates(d),
    "secrets": lambda d: secrets.digests(secrets.scan(d)),
}


@pytest.mark.parametrize("name", APPLY)
def test_empty_tables(spark, name):
    assert APPLY[name](spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("name", APPLY)
def test_nulls_repeated_rows_and_clashing_columns(spark, name):
    rows = [(None, None, 1, "x"), (None, "some words of text in a row", 1, "x"), (5, None, None, None), (7, "some words of text in a row", 2, "y"), (7, "some words of text in a row", 2, "y"), (8, "Some words of\ntext in a row", 3, "z")]
    names = {"bpe": "words", "tokens": "n_tokens", "lines": "key", "shards": "base", "rules": "n_words", "mil": "score", "near": "token", "secrets": "hit"}
    df = spark.createDataFrame(rows, f"doc_id long, text string, {names[name]} long, label string")
    got = APPLY[name](df).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)


# ---- tokens


def test_tokens_match_the_library(spark, odd, docs, tokenizer):
    path = queries.word_vocabulary()
    for table in (odd, docs):
        table = table.select("doc_id", "text")
        got = {r["doc_id"]: r for r in bpe.digests(bpe.encode(table, path, decode=True, buckets=3)).collect()}
        n = {r["doc_id"]: r for r in token_count.token_counts(table, path, limit=50).collect()}
        for i, text in table.collect():
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids
            text_back = tokenizer.decode(ids, skip_special_tokens=False)
            assert got[i]["n_tokens"] == n[i]["n_tokens"] == len(ids)
            assert got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
            assert got[i]["decoded_sha256"] == hashlib.sha256(text_back.encode()).hexdigest()
            assert (n[i]["n_bytes"], n[i]["over_limit"]) == (len((text or "").encode()), len(ids) > 50)


def test_workers_may_forget_merged_words(tokenizer, monkeypatch):
    text = lambda b, c: f"hello\nworlds{c}\nx{b}".encode()
    rows = [{"bucket": b, "chunk_id": c, "n": 3, "pos": b"", "words": pa.compress(text(b, c), "zstd", asbytes=True), "size": len(text(b, c))} for b in range(2) for c in range(4)]
    batch = pa.RecordBatch.from_pylist(rows)
    run = lambda: [b.to_pylist() for b in bpe._encode_words(queries.word_vocabulary(), [batch])]
    first = run()
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 2)
    assert run() == first and len(first) == 8


def test_splitting_slices_and_single_characters(tokenizer):
    split = bpe.splitter(queries.word_vocabulary())
    texts = ["Éa" + chr(c) + "b1" + chr(c) for c in [*range(1, 0xD800, 7), *range(0x1F300, 0x1F600)]]
    arr = pa.array(texts)
    for part in (arr, arr.slice(5, 4000)):
        words, counts = split(part)
        want = [split.slow(t) for t in part.to_pylist()]
        assert counts.tolist() == [len(w) for w in want]
        assert words.to_pylist() == [x for w in want for x in w]


def test_decode_takes_ids_from_anywhere(spark, tokenizer):
    ids = tokenizer.encode("Some words, 12!").ids
    df = spark.createDataFrame([(1, bytearray(struct.pack(f"<{len(ids)}I", *ids))), (2, bytearray())], "doc_id long, ids binary")
    assert dict(map(tuple, bpe.decode(df, queries.word_vocabulary()).collect())) == {1: tokenizer.decode(ids, skip_special_tokens=False), 2: ""}


def test_whole_tokens_are_single(tokenizer):
    own = token_count.whole_tokens(queries.word_vocabulary()).to_pylist()
    assert len(own) > 10_000
    assert all(len(tokenizer.encode(w, add_special_tokens=False).ids) == 1 for w in random.Random(1).sample([w for w in own if w.isalpha() and w.islower()], 300))


# ---- lines


def test_lines_match_the_plain_version(spark, odd, docs):
    for table in (odd, docs):
        table = table.select("doc_id", "text")
        want = brute.dedup_lines([tuple(r) for r in table.collect()])
        assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.dedup(table, shards=5).collect()} == want


def test_index_is_incremental_and_reversible(spark, docs):
    rows = docs.select("doc_id", "text")
    parts = [rows.where(F.col("doc_id") % 3 == k) for k in range(3)]
    index = line_dedup.LineIndex.empty(spark, 4)
    drops = lambda ix: sorted((r["doc_id"], sorted(map(bytes, r["keys"]))) for r in ix.drops().collect())
    table = lambda df: sorted(map(lambda r: tuple(bytes(x) if isinstance(x, bytearray) else x for x in r), df.collect()))
    one = index.insert(parts[0]).insert(parts[1])
    before = drops(one), table(one.counts)
    three = one.insert(parts[2])
    assert drops(three) == drops(line_dedup.index(rows, shards=4))
    back = three.delete(parts[2].select("doc_id"))
    assert (drops(back), table(back.counts)) == before
    assert sum(len(line_dedup.CuckooFilter.load(r["filter"], r["size"])) for r in back.filters.collect()) == back.counts.count()


def _fresh(index):
    """Everything that an index says, and what its filters hold."""
    drops = sorted((r["doc_id"], sorted(map(bytes, r["keys"]))) for r in index.drops().collect())
    counts = sorted((bytes(r["key"]), r["n_docs"], r["first_doc"]) for r in index.counts.collect())
    parts = [line_dedup.CuckooFilter.load(r["filter"], r["size"]) for r in index.filters.collect()]
    hashes = line_dedup._hashes([c[0] for c in counts])
    known = np.zeros(len(hashes), bool)
    for f in parts:
        known |= f.contains(hashes)
    return drops, counts, sum(map(len, parts)), bool(known.all())


def test_false_positives_survive_deletion_and_insertion(spark):
    """Three-bit fingerprints in one shard: the filters take nearly every key for known."""
    table = lambda ids: spark.createDataFrame([(i, "\n".join(f"line number {k} of the text" for k in range(3 * i, 3 * i + 15))) for i in ids], DOCS)
    empty = line_dedup.LineIndex.empty(spark, 1, bits=3)
    index = empty.insert(table(range(20))).insert(table(range(20, 40)))
    assert _fresh(index) == _fresh(empty.insert(table(range(40))))
    index = index.delete(table(range(5, 25)).select("doc_id"))
    assert _fresh(index) == _fresh(empty.insert(table([*range(5), *range(25, 40)])))
    index = index.insert(table(range(5, 25)))
    said = _fresh(index)
    assert said == _fresh(empty.insert(table(range(40))))
    assert said[3] and said[2] == len(said[1])


def test_a_change_writes_what_it_touches(spark, monkeypatch):
    """One document of two lines in, then out of, an index of thousands of keys in several shards."""
    rows = spark.createDataFrame([(i, "\n".join(f"line number {k} of text {i}" for k in range(20))) for i in range(200)], DOCS)
    index, written, real = line_dedup.index(rows, shards=16), {}, line_dedup.materialize

    def counted(df, label):
        out = real(df, label)
        written[label] = written.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(line_dedup, "materialize", counted)
    before = _fresh(index)
    more = index.insert(spark.createDataFrame([(500, "line number 3 of text 7\nnobody has this line")], DOCS))
    assert more.counts.count() == index.counts.count() + 1 == 4001
    assert {k: written[k] for k in ("line-refs", "line-counts")} == {"line-refs": 2, "line-counts": 2} and written["line-filters"] <= 2
    written.clear()
    back = more.delete(spark.createDataFrame([(500,), (12345,)], "doc_id long"))
    assert written["line-gone"] == 1 and written["line-counts"] == 2 and written["line-filters"] <= 1 and sum(written.values()) < 20
    assert _fresh(back) == before
    assert _fresh(back.compacted()) == before


def test_logs_are_compacted_and_shards_split(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "COMPACT", 3)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 50)
    table = lambda ids: spark.createDataFrame([(i, "\n".join(f"line number {k} of the text" for k in range(9 * i, 9 * i + 15))) for i in ids], DOCS)
    index, held = line_dedup.LineIndex.empty(spark), set()
    for k, ids in enumerate(([0, 1], [2, 3, 4], range(5, 40), [40], range(41, 60))):
        index = index.insert(table(ids))
        held |= set(ids)
        if k % 2:
            index = index.delete(table([ids[0]]).select("doc_id"))
            held -= {ids[0]}
    index = index.insert(table([2]))  # deleted before
    held.add(2)
    assert _fresh(index) == _fresh(line_dedup.LineIndex.empty(spark).insert(table(sorted(held))))
    assert max(map(len, index.logs.values())) < 3 and index.shards > 4


def test_hot_lines_are_joined_by_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LEAST", 3)
    monkeypatch.setattr(line_dedup, "HOT_KEYS", 50)
    rows = [(i, f"a line that all hold\nown line of {i}\nline shared by pairs {i // 2}") for i in range(60)] + [(None, "a line that all hold\nx")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: f"own line of {i}" + ("" if i % 2 else f"\nline shared by pairs {i // 2}") for i in range(60)} | {None: "a line that all hold\nx"}


def test_long_runs_of_blanks_and_long_texts(spark):
    rows = [(1, "x" + " " * 400_000 + "y"), (2, "some line of text\n" * 60_000), (3, " \tSome line of TEXT" + " " * 300_000), (4, "z" * 3_000_000)]
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], len(r["text"])) for r in line_dedup.dedup(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {1: (1, 0, 400_002), 2: (60_001, 0, 18 * 60_000), 3: (1, 1, 0), 4: (1, 0, 3_000_000)}


def test_strip_keeps_clashing_columns(spark):
    rows = [(1, "one long line here", 7, "k"), (2, "one long line here\nb", 8, "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, drop_id int, keys string")
    got = line_dedup.strip(df, line_dedup.index(df).drops(), counts=False)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(1, "one long line here", 7, "k"), (2, "b", 8, "l")]


def test_cuckoo_filter():
    r = np.random.default_rng(3)
    keys = r.integers(0, 2**63, 5000).astype(np.uint64)
    f = line_dedup.CuckooFilter(5000)
    f.insert(keys)
    assert f.contains(keys).all() and len(f) == 5000
    assert f.contains(r.integers(0, 2**63, 20_000).astype(np.uint64)).mean() < 0.005
    f.remove(keys[:2500])
    assert f.contains(keys[2500:]).all() and f.contains(keys[:2500]).mean() < 0.005 and len(f) == 2500
    g = line_dedup.CuckooFilter.load(f.dump(), f.size())
    assert (g.table == f.table).all()
    full = line_dedup.CuckooFilter(8)
    full.insert(keys[:200])  # far more than fits: the stash keeps the rest
    assert full.contains(keys[:200]).all()


# ---- shards


@pytest.mark.parametrize("limit", [2000, 30_000, 10**9])
def test_shards_match_the_plain_version(spark, docs, limit):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sharding.shard_map(docs, limit).collect()
    assert {r["doc_id"]: r["shard"] for r in got} == brute.shard_of(rows, limit)
    assert all(r["shard_bytes"] <= limit or r["shard_docs"] == 1 for r in got)
    assert all(r["depth"] == len(r["shard"]) for r in got)


def test_equal_ids_still_fit(spark):
    df = spark.createDataFrame([(7, "x" * 100)] * 50, DOCS)
    got = sharding.shard_map(df, 450).collect()
    assert len(got) == 50 and all(r["shard_bytes"] <= 450 for r in got)


def test_a_text_longer_than_a_shard_stands_alone(spark):
    rows = [(i, "x" * 100) for i in range(40)] + [(99, "é" * 2_000_000), (None, None)]
    got = {r["doc_id"]: r for r in sharding.shard_map(spark.createDataFrame(rows, DOCS), 500).collect()}
    assert (got[99]["shard_docs"], got[99]["shard_bytes"]) == (1, 4_000_000) and len(got) == 42
    assert all(r["shard_bytes"] <= 500 for i, r in got.items() if i != 99)


def test_shards_are_written(spark, docs, tmp_path):
    sharding.write_shards(docs, f"{tmp_path}/s", 60_000)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == docs.count() and back.select("shard").distinct().count() > 4


# ---- quality


def test_counts_match_the_plain_version(spark, odd, docs):
    for table in (odd, docs):
        got = {r["doc_id"]: tuple(r)[1:6] for r in quality_rules.judge(table, []).collect()}
        assert got == {r["doc_id"]: brute.counts(r["text"]) for r in table.collect()}
    long = [("v%d " % (i % 997)) + "w w w \n" for i in range(3000)]
    own = quality_rules.text_counts(pa.array(["x", "".join(long), None]).slice(1))
    assert tuple(int(own[c][0]) for c in quality_rules.COUNTS[:5]) == brute.counts("".join(long))


def test_learned_list_finds_planted_rules():
    r = np.random.default_rng(5)
    x = pd.DataFrame({n: r.random(900) for n, *_ in quality_rules.RATIOS})
    bad = (x["symbols"] > 0.8) | ((x["upper"] > 0.6) & (x["bangs"] > 0.5))
    rules = quality_rules.learn(x, bad.to_numpy())
    said = np.zeros(len(x), bool)
    for rule in rules:
        said |= quality_rules._covers(rule, x)
    assert (said == bad).mean() > 0.97
    assert quality_rules.learn(x, np.zeros(len(x), bool)) == []


def test_rules_become_one_ordered_expression(spark):
    rules = [[quality_rules.Term("symbols", True, 0.5)], [quality_rules.Term("upper", True, 0.5), quality_rules.Term("digits", False, 0.1)]]
    texts = {1: "a b c d e " * 20, 2: "a* b* c* " * 0 + " ".join(f"w{i}*" for i in range(60)), 3: " ".join(f"W{chr(65 + i % 26) * 3}{chr(65 + i // 26)}" for i in range(60)), 4: "few words"}
    got = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(list(texts.items()), DOCS), rules).collect()}
    assert got[2]["rule"] == "symbols > 0.5" and not got[2]["kept"]
    assert got[3]["rule"] == "upper > 0.5 and digits <= 0.1" and not got[3]["kept"]
    assert got[1]["base_failed"] and got[4]["base_failed"] and not got[1]["kept"]


def test_rules_on_held_out_labels(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    rules = quality_rules.fit(docs, labels.where("doc_id % 2 = 0"))
    own = quality_rules.judge(docs, rules).where("not base_failed").join(labels.where("doc_id % 2 = 1"), "doc_id")
    assert own.where("kept = (quality = 1)").count() > 0.95 * own.count()
    assert quality_rules.fit(docs, labels.where("quality = 1")) == []


def test_attention_gradients():
    r = np.random.default_rng(2)
    bags = np.array([1, 3, 2])
    x, y = r.standard_normal((6, 5)).astype(np.float32), np.array([1, 0, 1], np.float32)
    model = quality_mil.AttentionModel.new(5)
    model.w = {k: v.astype(np.float64) + 0.1 for k, v in model.w.items()}
    loss = lambda: -np.mean(np.where(y == 1, np.log(model.forward(x, bags)[5]), np.log(1 - model.forward(x, bags)[5])))
    for name, g in model.gradients(x, bags, y).items():
        at = tuple(0 for _ in g.shape)
        model.w[name][at] += 1e-5
        up = loss()
        model.w[name][at] -= 2e-5
        down = loss()
        model.w[name][at] += 1e-5
        assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-4), name


def test_classifier_on_held_out_labels(spark):
    big = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    own = quality_mil.judge(docs, quality_mil.fit(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert (own["predicted"] == own["quality"]).mean() > 0.95
    assert own["score"].between(0, 1).all()
    assert quality_mil.fit(docs, labels.where("quality = 1")) is None


def test_held_out_rows_are_never_learned_from(spark, docs):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    seen = labelled.sample(docs, labels, 1000, where="crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
    assert seen.where(labelled.id_crc(F.col("doc_id")) % 4 == 2).count() == 0
    assert seen.count() > 0
    assert labelled.sample(docs, labels, 5).count() == 5


def test_passages_are_the_same_in_slices(odd):
    texts = pa.array(ODD)
    x, bags = quality_mil.passages(texts)
    for i in range(len(ODD)):
        one, n = quality_mil.passages(texts.slice(i, 1))
        a = int(bags[:i].sum())
        assert n[0] == bags[i] and np.allclose(one, x[a : a + n[0]], atol=1e-6)


def test_long_labelled_texts_are_learned_from(spark):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 9)))
    long = " ".join(word() for _ in range(500_000))
    assert len(long) > quality_mil.SLICE_BYTES
    rows = [(4, long), (5, "short text"), (5, "another text of this id"), (6, "not labelled"), (8, None)]
    got = {x["doc_id"]: len(x["x"]) // (2 * 260) for x in quality_mil.learned(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(4, 1), (5, 0), (8, 1), (4, 0), (None, 1), (6, None)], "doc_id long, quality int")).collect()}
    held = spark.createDataFrame([(i,) for i in (4, 5, 8)], "doc_id long").where(labelled.id_crc(F.col("doc_id")) % 4 == 2).collect()
    want = {4: -(-500_000 // quality_mil.PASSAGE), 5: 1, 8: 1}
    assert got == {i: n for i, n in want.items() if i not in {x[0] for x in held}} and 4 in got


def test_the_last_passage_of_a_long_text_is_learned_from(spark):
    text = lambda i, end: " ".join(f"word{k % (7 + i)}" for k in range(64 * 60)) + end
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    fitted = lambda end: quality_mil.fit(spark.createDataFrame([(i, text(i, end if i == 1 else " a b c")) for i in range(20)], DOCS), labels)
    assert not np.allclose(fitted(" a b c").w["W"], fitted(" ! ? 5").w["W"])


def test_learned_passages_are_bounded_by_whole_documents(spark):
    rows = [(i, "word " * 64 * n) for i, n in ((1, 3), (2, 50), (4, 2), (5, 1), (9, 4))]
    labels = spark.createDataFrame([(i, 1) for i, _ in rows], "doc_id long, quality int")
    got = {r["doc_id"]: (r["n"], len(r["x"])) for r in quality_mil.learned(spark.createDataFrame(rows, DOCS), labels, passages_learned=8).collect()}
    assert got and sum(n for n, _ in got.values()) <= 8 and 2 not in got
    assert all((n, n * 520) == x for i, x in got.items() for n in [dict(rows)[i].count("word") // 64])


def test_whole_verdict_matches_the_plain_version(spark):
    got = queries.QUERIES["op5_quality_rules"](spark, DIR).collect()
    table = spark.read.parquet(f"{DIR}/documents.parquet")
    rules = quality_rules.fit(table, spark.read.parquet(f"{DIR}/labels.parquet"))
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    plain = [[(t.ratio, t.above, t.bound) for t in rule] for rule in rules]
    assert rules and {r["doc_id"]: r["kept"] for r in got} == {i: brute.rule_verdict(plain, t) for i, t in texts.items()}


def test_scores_match_the_plain_version(spark, odd):
    table = spark.read.parquet(f"{DIR}/documents.parquet")
    model = quality_mil.fit(table, spark.read.parquet(f"{DIR}/labels.parquet"))
    some = table.select("doc_id", "text").where("doc_id < 40").unionByName(odd.where("length(text) < 5000 or text is null").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    got = {r["doc_id"]: r["score"] for r in quality_mil.judge(some, model).collect()}
    for i, text in some.collect():
        assert got[i] == pytest.approx(brute.attention_score(model.w, brute.passages(text, quality_mil.PASSAGE, quality_mil.CLASSES)), abs=2e-4), i


def test_pieces_of_a_long_text_score_like_the_whole(monkeypatch):
    r = random.Random(2)
    text = "  é" + "".join(r.choice("abcé .\n\t!") for _ in range(60_000))
    x, bags = quality_mil.passages(pa.array([text]))
    model = quality_mil.AttentionModel.new(x.shape[1])
    model.w |= {"mean": np.float32(0), "std": np.float32(1)}
    whole = float(model.score(x, bags)[0])
    monkeypatch.setattr(quality_mil, "SLICE_BYTES", 5000)
    parts = quality_mil.pieces(text)
    assert len(parts) > 8 and "".join(parts) == text
    assert np.allclose(np.concatenate([quality_mil.passages(pa.array([p]))[0] for p in parts]), x)
    assert model.score_pieces(quality_mil.passages(pa.array([p]))[0] for p in parts) == pytest.approx(whole, abs=1e-6)
    assert quality_mil.pieces("x" * 20_000) == ["x" * 20_000]


# ---- URLs


def test_url_rules_and_words(spark):
    cases = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"), "http://a.net": ("a.net", "", None, "allow"), "https://WWW.Example.NET/en/1?q#f": ("www.example.net", "/en/1", "example.net/en/", "allow"), "http://example.net/enx": ("example.net", "/enx", "net/", "block"),
        "http://notexample.com/de/1": ("notexample.com", "/de/1", None, "allow"), "http://b.example.com/de/1": ("b.example.com", "/de/1", "example.com/de/", "block"), "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"), "ftp://h?x=1#y": ("h", "", None, "allow"),
        "http://h.com/casino-1": ("h.com", "/casino-1", None, "block"), "http://h.com/casinox": ("h.com", "/casinox", None, "allow"), "http://h.com/CASINOS": ("h.com", "/CASINOS", None, "block"), "http://h.com/cheap/cheap": ("h.com", "/cheap/cheap", None, "allow"), "http://h.com/cheap/pills": ("h.com", "/cheap/pills", None, "block"),
        "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://porn.org/fr/": ("porn.org", "/fr/", "org/fr/", "allow"),
    }
    terms = url_filter.vocabulary(spark)
    got = url_filter.judge(spark.createDataFrame([(i, u, "z") for i, u in enumerate(cases)], "page_id long, url string, host string"), terms).collect()
    assert {list(cases)[r["page_id"]]: tuple(r)[1:5] for r in got} == cases
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), terms).collect() == []
    assert terms.count() > 1000


def test_weights_of_a_given_vocabulary(spark, monkeypatch):
    terms = spark.createDataFrame([("alpha", 3), ("Beta-x", 2), ("gamma", 1), ("gamma", 2), ("am", 5), (None, 9), ("", 9), ("delta", None)], "term string, weight int")
    urls = ["http://h/alpha", "http://h/gamma", "http://h/gamma/gamma", "http://h/beta-x?gamma", "http://h/beta-xy?gamma", "http://h/delta", "x" * 500_000 + "/alpha", "http://h/gamma", None, "http://h/gamma"]
    pages = spark.createDataFrame([(None if i == 7 else min(i, 8), u) for i, u in enumerate(urls)], "page_id long, url string")
    got = url_filter.judge(pages, terms, reject_at=3).collect()
    assert sorted(((r["page_id"], r["verdict"], r["strict_hits"], r["soft_hits"]) for r in got), key=repr) == sorted(
        [(0, "block", 1, 0), (1, "allow", 0, 1), (2, "allow", 0, 1), (3, "block", 0, 2), (4, "allow", 0, 1), (5, "allow", 0, 0), (6, "block", 1, 0), (None, "allow", 0, 1), (8, "allow", 0, 0), (8, "allow", 0, 1)], key=repr
    )
    assert {r["verdict"] for r in url_filter.judge(pages, terms.where("false")).collect()} == {"allow"}
    monkeypatch.setattr(url_filter, "MOST_TERMS", 2)
    with pytest.raises(ValueError, match="more than 2 terms"):
        url_filter.collect_terms(terms)


def test_a_worker_builds_an_automaton_once():
    calls = []
    terms = lambda: calls.append(1) or {"casino": 2}
    assert url_filter._automaton("k", terms) is url_filter._automaton("k", terms) and len(calls) == 1
    assert url_filter.hits("http://x/casino.casino", url_filter._automaton("k", terms)) == {"casino": 2}


# ---- near duplicates


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, k) for k in range(4000, 4100)]
    root = {v: v for e in edges for v in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {v: find(v) for v in root}
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {v: got.get(v, v) for v in want} == want


def _near(df, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(df, **options).collect()}


def test_near_duplicates_match_the_plain_version(spark, odd):
    for table in (odd, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        assert _near(table) == brute.components([(r["doc_id"], r["text"]) for r in table.collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_many_near_copies_and_a_shared_passage(spark, seed):
    r = random.Random(seed)
    base = [f"w{r.randrange(9999)}" for _ in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(r.randrange(0, 6)):
            own[r.randrange(120)] = f"v{r.randrange(9999)}"
        rows.append((i, " ".join(own)))
    passage = " ".join(f"h{k}" for k in range(60))
    rows += [(i, f"{passage} " + " ".join(f"u{r.randrange(10**6)}" for _ in range(r.randrange(1, 30)))) for i in range(150, 300)]
    rows += [(i, f"{passage} tail") for i in range(300, 340)]
    r.shuffle(rows)
    assert _near(spark.createDataFrame(rows, DOCS)) == brute.components(rows)


def test_the_bound_itself_links(spark):
    text = [f"w{i}" for i in range(22)]  # 18 shingles; the copy shares 16 of 20
    rows = [(1, " ".join(text)), (2, " ".join([*text[:-2], "x", "y"])), (3, " ".join([*text[:-3], "x", "y", "z"]))]
    assert _near(spark.createDataFrame(rows, DOCS)) == brute.components(rows)


def test_texts_of_shared_passages_make_few_pairs(spark, monkeypatch):
    """Ten passages each out of sixty: hardly any two texts link, and few pairs are looked at."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8)))
    passages = [" ".join(word() for _ in range(30)) for _ in range(60)]
    rows = [(i, " ".join(rng.sample(passages, 10))) for i in range(1000)] + [(1000 + i, " ".join(rng.sample(passages, 10)) + " tail") for i in range(3)]
    rows += [(2000 + i, rows[i][1] + " end") for i in range(5)]
    pairs, real = [], jaccard_join.materialize

    def counted(df, label):
        out = real(df, label)
        if label == "near-across":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "materialize", counted)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute.components(rows)
    assert len(pairs) == 1 and pairs[0] <= 30 * len(rows)


def _sets(texts):
    return list(jaccard_join.shingle_sets(pa.array(texts), 5))


def _triple(r):
    """Three texts of 36 shingles and the same eight least ones; the last two link, the first links with neither."""
    word = lambda: f"t{r.randrange(10**9)}"
    while True:
        base = [word() for _ in range(30)]
        core = set(_sets([" ".join(base)])[0].tolist())
        tails = [[word() for _ in range(10)] for _ in range(200)]
        fits = [t for t, u in zip(tails, _sets([" ".join(base + t) for t in tails]), strict=True) if set(u[:8].tolist()) <= core]
        for t in fits[1:]:
            near = [[*t[:-1], word()] for _ in range(20)]
            also = [x for x, u in zip(near, _sets([" ".join(base + x) for x in near]), strict=True) if set(u[:8].tolist()) <= core]
            if also:
                return [" ".join(base + x) for x in (fits[0], t, also[0])]


def _late(r, triple):
    """A text of 30 shingles whose least one stands sixth or seventh in the triple's prefix, and that has no other of it."""
    words = triple[0].split()
    prefix = _sets(triple[:1])[0][:8]
    for i in range(len(words) - 4):
        own = words[i : i + 5]
        h = _sets([" ".join(own)])[0][0]
        if h in prefix[5:7]:
            texts = [" ".join([*own, *(f"l{r.randrange(10**9)}" for _ in range(29))]) for _ in range(3000)]
            return next((t for t, u in zip(texts, _sets(texts), strict=True) if u[0] == h), None)


@pytest.mark.parametrize("late", [False, True])
def test_links_inside_a_group_that_its_least_set_lacks(spark, late):
    r, texts = random.Random(5), []
    for _ in range(12):
        texts += (own := _triple(r))
        if late and (more := _late(r, own)):
            texts.append(more)
    assert not late or len(texts) > 40
    rows = list(enumerate(texts))
    assert _near(spark.createDataFrame(rows, DOCS)) == brute.components(rows)


def test_rows_without_an_id_link_like_others(spark):
    text = [f"w{i}" for i in range(60)]
    rows = [(7, " ".join(text)), (None, " ".join([*text[:-1], "x"])), (None, " ".join(["y", *text[1:-1], "x"])), (None, "alone " * 9), (5, "y " + " ".join([*text[1:-1], "x"])), (9, "no link at all")]
    rows += [(None, "two rows without an id that only link each other and are long enough"), (None, "two rows without an id that only link each other and are long enough")]
    got = sorted(map(tuple, jaccard_join.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()), key=repr)
    assert got == sorted([(7, 56, 5), (None, 56, 5), (None, 56, 5), (None, 1, None), (5, 56, 5), (9, 1, 9), (None, 10, None), (None, 10, None)], key=repr)


def test_a_run_may_span_many_batches():
    t = np.repeat([1, 2, 3, 9], [3, 5000, 1, 40])
    batches = [pa.record_batch({"t": t[i : i + 100], "x": np.arange(len(t))[i : i + 100]}) for i in range(0, len(t), 100)]
    runs = list(jaccard_join._runs([batches[0].slice(0, 0), *batches]))
    assert np.concatenate([r[0] for r in runs]).tolist() == t.tolist() and np.concatenate([r[1] for r in runs]).tolist() == list(range(len(t)))
    assert all(not set(a[0]) & set(b[0]) for a, b in zip(runs, runs[1:]))
    assert list(jaccard_join._runs([])) == []


# ---- secrets


def _spans(spark, texts):
    got = secrets.digests(secrets.scan(spark.createDataFrame(list(enumerate(texts)), DOCS))).orderBy("doc_id").collect()
    return [r["spans"] for r in got]


def test_base_patterns(spark):
    key, hexa = "AKIA" + "B2" * 8, "0123456789abcdef" * 2
    texts = [f"é {key} x", f"AKIAB {hexa}", 'Password = "abcdefgh" token:short', "password: token: abcdefghij", f"api_key={hexa}", "secret=token=abcdefgh", None, "\U0001f600 passwd:12345678"]
    assert _spans(spark, texts) == ["access:2:22", "hex:6:38", "assign:0:20", "", "assign:0:40,hex:8:40", "assign:0:21", "", "assign:2:17"]


def test_entropy_windows(spark):
    r = random.Random(6)
    strong = "".join(r.sample("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 40))
    weak = "zyzyzyzy12" * 5
    mixed = "z1" * 30 + strong
    texts = [f"x {strong} y", weak, mixed, "123e4567-e89b-12d3-a456-426614174000", f"sha256-{strong}", f"EXAMPLE{strong}", "a/long-path/of-words/and/2024"]
    assert _spans(spark, texts) == [f"entropy:2:{2 + len(strong)}", "", f"entropy:0:{len(mixed)}", "", "", "", ""]
    for text in (strong, weak, mixed):
        best = max(brute.entropy(text[i : i + secrets.WINDOW]) for i in range(len(text) - secrets.WINDOW + 1))
        df = spark.createDataFrame([(text,)], "s string")
        least = df.selectExpr(f"{secrets._min_sum('s')} AS m").first()["m"]
        assert np.log2(secrets.WINDOW) - least / secrets.WINDOW == pytest.approx(best, abs=1e-9)


def _random_key(seed, size, chars):
    r = random.Random(seed)
    return "".join(r.sample(chars, 20) + r.choices(chars, k=size - 20))


def test_entropy_beside_base_spans(spark):
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    access, key, other = "AKIA" + "Q7" * 8, _random_key(1, 40, lower + upper + digits), _random_key(2, 30, lower + upper + digits)
    letters, hexa = _random_key(3, 24, lower + upper), "0f" * 16
    texts = [f"\U0001f600 {access}/{key}", f"{key}-{access}/{hexa}_{other}", f"{key[:15]}-{access}/{key[:15]}", letters, letters.lower(), f"see {access}/example{key}", f"{access}/{letters}", f"token={key}/{other}"]
    got = [set(x.split(",")) for x in _spans(spark, texts)]
    n = len(access)
    second = {f"entropy:0:41", f"access:41:{41 + n}", f"hex:{42 + n}:{74 + n}", f"entropy:{74 + n}:{105 + n}"}
    assert got == [
        {f"access:2:{2 + n}", f"entropy:{2 + n}:{43 + n}"}, second, {f"access:16:{16 + n}"}, {"entropy:0:24"}, {""}, {f"access:4:{4 + n}"},
        {f"access:0:{n}", f"entropy:{n}:{n + 25}"}, {"assign:0:77"},
    ]


def test_positions_beyond_one_block(spark):
    n = secrets.BLOCK * 2 + 5
    text = " ".join(["0123456789abcdef" * 2] * n)
    assert _spans(spark, [text])[0].split(",")[-1] == f"hex:{33 * (n - 1)}:{33 * n - 1}"


def test_many_matches_in_a_long_text(spark):
    """Sixteen thousand matches in over a megabyte, blanked out beside what stays a candidate."""
    key = _random_key(4, 30, "abcdefghijklmnopqrstuvwxyz0123456789")
    part = f"\u00e9 token=abcdefgh{'x' * 20}, AKIA{'B2' * 8}/{key} {'0123456789abcdef' * 2} "
    n, size = 5400, len(part)
    got = _spans(spark, [part * n])[0].split(",")
    own = [("assign", 2, 36), ("access", 38, 58), ("entropy", 58, 89), ("hex", 90, 122)]
    assert got == [f"{k}:{a + i * size}:{b + i * size}" for i in range(n) for k, a, b in own]


def test_blanking_is_exact_where_base_spans_overlap(spark):
    """An access key that runs into a password, and a hex run that runs into an api_key."""
    key, hexa = _random_key(9, 30, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), "0123456789abcdef" * 2
    texts = [f"AKIA{'B2' * 6}TOKEN={key}", f"{hexa[:-1]}api_key={key}"]
    assert _spans(spark, texts) == [f"access:0:21,assign:16:{22 + 30}", f"hex:0:32,assign:31:{39 + 30}"]


# ---- leaks


def test_leaks_match_the_plain_version(spark):
    r = random.Random(8)
    items = [(j, " ".join(f"i{r.randrange(40)}" for _ in range(n))) for j, n in enumerate([1, 2, 4, 5, 6, 9, 24, 60])] + [(90, None), (91, " \n")]
    docs = []
    for i in range(120):
        own = [f"d{r.randrange(60)}" for _ in range(r.randrange(0, 400))]
        if r.random() < 0.6:
            w = (r.choice(items)[1] or "").split()
            if w and r.random() < 0.5:
                w[r.randrange(len(w))] = "zz"
            at = r.randrange(len(own) + 1)
            own[at:at] = w
        docs.append((i, " ".join(own).upper() if i % 2 else " ".join(own)))
    docs += [(500, None), (501, "")]
    d, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(docs, items)
    assert {(x["doc_id"], x["item_id"]): (x["n_item"], x["n_found"]) for x in decontam.contained(d, b).collect()} == want
    assert {x["doc_id"] for x in decontam.clean(d, b).collect()} == {i for i, _ in docs} - {i for i, _ in want}
    assert decontam.contained(d, b.where("false")).collect() == []
    assert decontam.contained(d.where("false"), b).collect() == []


def test_leaks_without_broadcast(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{DIR}/benchmark.parquet")
    some = lambda: sorted(map(tuple, decontam.contained(docs, items).collect()))
    first = some()
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)
    assert some() == first


def test_each_size_partition_has_its_own_bounds(spark):
    r = random.Random(3)
    items = [(j, " ".join(f"i{r.randrange(10**6)}" for _ in range(n))) for j, n in enumerate([12] * 8 + [40] * 8 + [200] * 8 + [2, 3])]
    b = spark.createDataFrame(items, "item_id long, text string")
    minima = decontam.signatures(decontam.item_shingles(b, 5, "item_id", "text"), 80)
    n = {x["item_id"]: x["n"] for x in minima.groupBy("item_id").agg(F.count("*").alias("n")).collect()}
    assert (n[0], n[8], n[16], n[24]) == (8 - 7 + 1, 36 - 29 + 1, 196 - 157 + 1, 1)
    parts = decontam.partitions(minima, 80)
    assert [(p["part"], p["least"]) for p in parts[5]] == [(3, 7), (5, 29), (7, 157)] and list(parts) == [2, 3, 5]
    assert len({p["most"] for p in parts[5]}) == 3
    own = [p | {"most": m} for p, m in zip(parts[5], (300, 200, 100), strict=True)]
    hashes = [99, 199, 299]
    ask = lambda hs: [tuple(x) for x in spark.createDataFrame([(hs,)], "hs array<long>").selectExpr(f"{decontam._probes(own)} AS p").first()["p"]]
    assert ask(hashes) == []  # three shingles hold no item
    assert ask(hashes * 4) == [(3, h) for h in hashes * 4]
    assert [p for p, _ in ask(hashes * 60)] == [3] * 180 + [5] * 120 + [7] * 60


def test_leaks_in_repeated_rows_null_ids_long_texts_and_clashing_columns(spark):
    item = " ".join(f"t{k}" for k in range(30))
    noise = " ".join(f"n{k % 9973}" for k in range(150_000))
    rows = [(None, item.upper(), 1, "a"), (4, f"{noise} {item} {noise}", 2, None), (5, "x y z", 3, "b"), (5, item, 4, "b"), (5, item, 4, "b"), (6, " ".join(item.split()[:12]), 5, "c"), (7, None, 6, "d")]
    d = spark.createDataFrame(rows, "doc_id long, text string, hash int, leak_id string")
    b = spark.createDataFrame([(1, item, "w"), (1, item, "w"), (None, item, None)], "item_id long, text string, shingle string")
    got = {(x["doc_id"], x["item_id"]): (x["n_item"], x["n_found"]) for x in decontam.contained(d, b).collect()}
    assert got == {(i, j): (26, 26) for i in (None, 4, 5) for j in (1, None)}
    left = decontam.clean(d, b)
    assert left.columns == d.columns and sorted(x["doc_id"] for x in left.collect()) == [6, 7]
