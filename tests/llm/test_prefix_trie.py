"""The prefix trie against a plain version."""

import hashlib
import random
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from poolspark.llm import prefix_trie, scan

ROWS = "conv_id long, turn long, role string, text string, depth string, path long"


def plain(rows):
    """The nodes of (conv_id, turn, role, text) as tuples."""
    convs = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append((t is not None, t or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest(), (role, text)))
    convs = {c: [x[3] for x in sorted(v)] for c, v in convs.items()}
    trunc = lambda c: c - (abs(c) % 5) * (1 if c >= 0 else -1)
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
    built = {c: tuple(convs.get(trunc(c), [])[: h[c]] + own[h[c] :]) for c, own in convs.items()}
    members = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids, out = {}, []
    for s in members:
        if s:
            kids.setdefault(s[:-1], []).append(s)
    own = lambda s: (len(members[s]) - 1) * (len(s[-1][1].encode()) if s else 0)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in kids.get(s, ())) or 1
        saved[s] = own(s) + sum(saved[k] for k in kids.get(s, ()))
    for s, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if built[c] == s)))
        out.append((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(kids.get(s, ())), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows):
    got = prefix_trie.digests(spark.createDataFrame(rows, ROWS))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_the_trie_matches_the_plain_version(spark):
    rng, rows = random.Random(2), []
    for c in [*range(60), -7, -3, 10**15]:
        for t in range(rng.choice([0, 1, 2, 5, 9, 14])):
            rows.append((c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(["é", "yes", "no", None, "", "a long text " * 20]), "x", 1))
    rows += [(7, None, "user", "first", None, None), (7, None, None, None, None, None), (8, 1, "user", "again", "x", 1), (8, 1, "user", "again", "x", 1), (8, 1, "us", "eragain", "x", 1), (None, 1, "user", "lost", "x", 1)]
    assert trie(spark, rows) == plain(rows)


def test_copies_and_conversations_that_end_in_each_other(spark):
    same = [(c, t, "user", f"t{t}", "x", 1) for c in range(200) for t in range(4)]
    nested = [(1000 + 5 * c, t, "user", f"n{t}", "x", 1) for c in range(12) for t in range(c)]
    assert trie(spark, same + nested) == plain(same + nested)


def test_empty_tables(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "a", "b", "x", 1)]) == []
    assert trie(spark, [(5, None, None, None, None, None)]) == plain([(5, None, None, None)])


def test_a_long_conversation_needs_few_rounds(spark, monkeypatch):
    rows = [(5 * k, t, "user", f"{t}" if t < 90 else f"{k} {t}", "x", 1) for k in range(3) for t in range(150)]
    rounds, real = [], prefix_trie.materialize
    monkeypatch.setattr(prefix_trie, "materialize", lambda df, label: rounds.append(label) or real(df, label))
    assert trie(spark, rows) == plain(rows)
    assert rounds.count("waiting") <= 3


def test_running_values_span_ranges(spark):
    rows = spark.range(20_000).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), F.col("id").alias("o"), F.xxhash64("id").alias("x"), (F.col("id") % 7).alias("s"))
    got = scan.running(rows.repartition(8), "k", ["o"], "n", xors={"rx": "x"}, sums={"rs": "s"}).collect()
    state = {}
    for r in sorted(got, key=lambda r: r["o"]):
        n, x, s = state.get(r["k"], (0, 0, 0))
        state[r["k"]] = now = (n + 1, x ^ r["x"], s + r["s"])
        assert (r["n"], r["rx"], r["rs"]) == now


def test_ids_of_a_node_are_hashed_in_blocks(spark):
    ends = spark.range(50_000).select((F.col("id") * 7 % 50_000).alias("conv_id"), F.lit(0).cast("long").alias("depth"), (F.col("id") >= 49_990).cast("long").alias("p1"), F.lit(1).cast("long").alias("p2"))
    own = {}
    for r in ends.collect():
        own.setdefault(r["p1"], []).append(r["conv_id"])
    got = prefix_trie.end_digests(ends.repartition(5))
    assert {r["p1"]: r["ends_sha256"] for r in got.collect()} == {p: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for p, v in own.items()}
    batch = pa.record_batch({"depth": [1, 1, 2], "p1": [0, 0, 0], "p2": [0, 0, 0], "conv_id": [3, 10, 4]})
    assert [b.column("ids").to_pylist() for b in prefix_trie._blocks([batch])] == [["3,10", "4"]]
