"""The filter audit against a plain version."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from poolspark.llm import filter_audit

DOCS = "doc_id long, text string, source string, n long, mask string"
LABELS = "doc_id long, quality int, toxic int, source string"


def failed(text, doc_id, least):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
        "E": doc_id is not None and least.get(text) is not None and doc_id > least[text],
    }


def plain(docs, labels):
    docs = [(i, t or "", s or "") for i, t, s, *_ in docs]
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t] = min(i, least.get(t, i))
    good, toxic = ({x[0] for x in labels if x[0] is not None and x[k] == 1} for k in (1, 2))
    rows = [(s, i, failed(t, i, least)) for i, t, s in docs]
    out = []
    for part in {s for _, _, s in docs}:
        own = [(i, f) for s, i, f in rows if s == part]
        per = []
        for order in itertools.permutations("ABCDE"):
            left = own
            for k, x in enumerate(order, 1):
                gone = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                total, alone = sum(f[x] for _, f in own), sum(f[x] and sum(f.values()) == 1 for _, f in own)
                per.append([part, "".join(order), k, len(left), len(gone), total - len(gone), alone, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), x])
        out += [(*r[:-1], sum(q[4] for q in per if q[-1] == r[-1])) for r in per]
    return sorted(out)


def audit(spark, docs, labels):
    got = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got.columns == names
    return sorted(tuple(r) for r in got.collect())


def test_all_orders_match_the_plain_version(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "b", "ab", "Q", "#", "é", "word", "longer-word-than-eight"]) + str(rng.randrange(v)) for _ in range(rng.choice([0, 3, 49, 50, 80]))) for v in (1, 3, 40, 400) for _ in range(12)]
    texts += [None, "", " ", "\n\n", "A" * 30, "x\x1cy\x85z " * 60, "中文 " * 55, "%"]
    docs = [(i, t, rng.choice(["s", "t", None, ""]), 1, "x") for i, t in enumerate(texts)] + [(i + 100, rng.choice(texts), "s", None, None) for i in range(30)]
    docs += [(None, texts[0], "s", 1, "x"), (None, texts[0], "t", 1, "x"), (3, texts[3], "s", 1, "x"), (3, texts[3], "s", 1, "x")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for i in range(0, 130, 2)] + [(4, 1, 0, "x"), (4, 0, 1, "y"), (None, 1, 1, "z"), (9999, 1, 1, "z")]
    assert audit(spark, docs, labels) == plain(docs, labels)


def test_empty_tables(spark):
    assert audit(spark, [], []) == []
    assert len(audit(spark, [(1, None, None, None, None)], [])) == 600


@pytest.mark.parametrize("weak", [False, True])
def test_distinct_words_are_exact(monkeypatch, weak):
    if weak:  # a hash that takes many different words for one
        monkeypatch.setattr(filter_audit, "_hashes", lambda data, start, size: (size % 2).astype(np.uint64))
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 150])))
    texts = [" ".join(word() for _ in range(rng.randrange(120))) for _ in range(30)] + ["", "a", " a", "a ", "aaaaaaaa aaaaaaaab aaaaaaaa"]
    data = [t.encode() for t in texts]
    got = filter_audit.counts(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    assert got["words"].tolist() == [len(t.split()) for t in texts]
    assert got["distinct"].tolist() == [len(set(t.split())) for t in texts]
    assert got["points"].tolist() == [len(t) for t in texts]


def test_a_long_text_is_counted_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SLICE_BYTES", 100)
    rng = random.Random(3)
    for text in (" ".join(rng.choice(["Aé", "b#", "word" * 60, "c"]) + str(rng.randrange(9)) for _ in range(400)), "x" * 1000, " " * 1000, "é " * 300 + "y" * 250):
        data = np.frombuffer(text.encode(), np.uint8)
        whole, long = filter_audit.counts(data, np.array([0, len(data)])), filter_audit.counts_of_long(data)
        assert {k: v.tolist() for k, v in long.items()} == {k: v.tolist() for k, v in whole.items()}


def test_a_long_text_in_a_table(spark):
    text = " ".join(f"w{i % 500_000}" for i in range(700_000))
    df = spark.createDataFrame([(1, text, "s", 1, "x"), (2, "a b", "s", 1, "x")], DOCS)
    assert {r["doc_id"]: r["mask"] for r in filter_audit.masks(df).collect()} == {1: 0, 2: 1}


def test_a_part_has_few_counts(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("the same text of all").alias("text"), F.lit("s").alias("source"))
    got = filter_audit.mask_counts(filter_audit.masks(df), spark.createDataFrame([], LABELS)).collect()
    assert sorted((r["mask"], r["n"]) for r in got) == [(1, 1), (17, 4999)]
