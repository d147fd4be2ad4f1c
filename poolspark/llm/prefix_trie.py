"""Prefix trie of conversations by leaf-peeling message passing (operator 11).

A node is a distinct sequence of first turns, known by its depth and 128 bits of
exclusive-or of position-dependent turn hashes; the parent's bits follow from
the node's own turn.  Nodes with the same members form a *stretch* without
branches, kept as one vertex, so a long conversation is no long chain of rounds.
Each stretch holds a counter of children that are not done.  In each round those
whose counter is zero send their subtree's totals, added up by parent, and leave;
the others take them in and count down, until the root is done.  The rounds are
as many as the branching nodes on the longest path; each is a written table, and
only what waits is written again.

Turns are ordered by turn, nulls first, ties by the MD5 of role and text; null roles
and texts are empty.  Rows without a conv_id are left out, repeated rows are turns
like others, and an empty table gives no nodes, not even a root.  Texts are taken
whole and only as MD5 and length beyond the first step.  No conversation, node or
list of ids is gathered in one task: turns are numbered by ranges, the ids that end
at a node are joined in blocks and their digest is taken block by block.  Columns
other than those named are not read and may have any name.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolspark.llm.scan import running
from poolspark.plans.shared import materialize

NODE = ["depth", "p1", "p2"]
#: Turns that a conversation can take from another.
MOST_SHARED = 8
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, item, bytes): the turns of each conversation numbered from 1; ``item`` is the MD5 of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    item = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), item.alias("item"), F.octet_length(text).cast("long").alias("bytes"))
    return running(own.where("conv_id IS NOT NULL"), "conv_id", ["turn", "item"], "place").drop("turn")


def with_shared_starts(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, place, item, bytes) rebuilt from another conversation's first turns, and all conversations (conv_id).

    Conversation c takes the first h turns of c - c % 5, then its own after its first h;
    h is the CRC-32 of c as text, modulo 9.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)
    base = F.col("conv_id") - F.col("conv_id") % 5
    sizes = materialize(own.groupBy("conv_id").agg(F.max("place").alias("n")), "sizes")
    other = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("m"))
    plan = sizes.withColumns({"h": h, "base": base}).join(other, "base", "left").withColumn("m", F.least("h", F.coalesce("m", F.lit(0))))
    heads = own.where((base == F.col("conv_id")) & (F.col("place") <= MOST_SHARED)).withColumnRenamed("conv_id", "base")
    first = heads.join(plan.select("conv_id", "base", "h"), "base").where("place <= h").select("conv_id", "place", "item", "bytes")
    rest = own.where(F.col("place") > h).join(plan.select("conv_id", "h", "m"), "conv_id").select("conv_id", (F.col("place") - F.col("h") + F.col("m")).alias("place"), "item", "bytes")
    return first.unionByName(rest), sizes.select("conv_id")


def _blocks(seen):
    """Runs of ids of one node as comma-joined text."""
    for batch in seen:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(c).to_numpy() for c in (*NODE, "conv_id")]
        new = np.r_[True, np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)]
        first = np.flatnonzero(new)
        ids = pa.ListArray.from_arrays(pa.array(np.r_[first, n], pa.int32()), batch.column("conv_id").cast(pa.string()))
        yield pa.record_batch({c: pa.array(x[first]) for c, x in zip((*NODE, "first"), cols, strict=True)} | {"ids": pc.binary_join(ids, ",")})


def _hashed(seen):
    """One digest for each node from its sorted blocks, which are taken one at a time."""
    held, sha, done = None, None, []

    def flush():
        rows = list(zip(*done, strict=True)) if done else [[]] * 4
        done.clear()
        return pa.record_batch([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.string())], names=[*NODE, "ends_sha256"])

    for batch in seen:
        keys = list(zip(*(batch.column(c).to_pylist() for c in NODE), strict=True))
        for key, ids in zip(keys, batch.column("ids"), strict=True):
            if key != held:
                if sha:
                    done.append((*held, sha.hexdigest()))
                held, sha = key, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.as_py().encode())
        yield flush()
    if sha:
        done.append((*held, sha.hexdigest()))
        yield flush()


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) from (conv_id, depth, p1, p2): SHA-256 of the ids in ascending order, comma-joined."""
    key = ", ".join(f"{c} long" for c in NODE)
    blocks = ends.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(_blocks, f"{key}, first long, ids string")
    return blocks.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(_hashed, f"{key}, ends_sha256 string")


def nodes(rows: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes, and the node where each conversation ends (conv_id, depth, p1, p2).

    A node has its bits, its parent's (q1, q2), its smallest member, the number of members, the bytes of its own turn and of its whole path.
    """
    marked = rows.withColumns({"c1": F.xxhash64("place", "item"), "c2": F.xxhash64(F.lit(1), "item", "place")})
    path = running(marked, "conv_id", ["place"], "depth", xors={"p1": "c1", "p2": "c2"}, sums={"path": "bytes"})
    path = path.withColumns({"q1": F.col("p1").bitwiseXOR(F.col("c1")), "q2": F.col("p2").bitwiseXOR(F.col("c2"))})
    below = path.groupBy(*NODE).agg(F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"), F.min("path").alias("path"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in NODE], none.alias("q1"), none.alias("q2"), "conv_id", "n_convs", zero.alias("bytes"), zero.alias("path"))
    last = path.groupBy("conv_id").agg(F.max(F.struct(*NODE)).alias("x")).select("conv_id", "x.*")
    ends = convs.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in NODE])
    return materialize(root.unionByName(below), "nodes"), ends


def stretches(own: DataFrame) -> DataFrame:
    """One row for each run of nodes with the same members, known by smallest member and number of members, with its parent and children."""
    keys = ["conv_id", "n_convs"]
    per = own.groupBy(*keys).agg(F.min(F.struct("depth", "q1", "q2")).alias("top"), F.max(F.struct(*NODE, "path")).alias("end"), F.sum((F.col("n_convs") - 1) * F.col("bytes")).alias("own"))
    per = materialize(per.select(*keys, F.col("top.depth").alias("from"), "top.q1", "top.q2", F.col("end.depth").alias("to"), "end.p1", "end.p2", "end.path", "own"), "stretches")
    above = per.select(F.col("conv_id").alias("up_conv"), F.col("n_convs").alias("up_n"), (F.col("to") + 1).alias("from"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
    linked = materialize(per.join(above, ["from", "q1", "q2"], "left"), "linked")
    kids = linked.where("up_n IS NOT NULL").groupBy(F.col("up_conv").alias("conv_id"), F.col("up_n").alias("n_convs")).agg(F.count("*").alias("kids"))
    return linked.join(kids, keys, "left").select(*keys, "up_conv", "up_n", "from", "to", "path", "own", F.coalesce("kids", F.lit(0).cast("long")).alias("kids"))


def peeled(graph: DataFrame) -> DataFrame:
    """``graph`` with the totals of each subtree: ``leaves`` and ``saved``.

    Vertices are (conv_id, n_convs), their parents (up_conv, up_n), null for the root.
    """
    now = materialize(graph.withColumns({"waiting": F.col("kids"), "leaves": F.when(F.col("kids") == 0, 1).otherwise(0).cast("long"), "saved": F.col("own")}), "waiting")
    done = []
    while True:
        ready, rest = now.where("waiting = 0"), now.where("waiting > 0")
        done.append(ready)
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, done).drop("waiting")
        sent = ready.groupBy(F.col("up_conv").alias("conv_id"), F.col("up_n").alias("n_convs")).agg(F.count("*").alias("k"), F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        got = lambda c: F.coalesce(c, F.lit(0).cast("long"))
        heard = rest.join(sent, ["conv_id", "n_convs"], "left").withColumns({"waiting": F.col("waiting") - got("k"), "leaves": F.col("leaves") + got("l"), "saved": F.col("saved") + got("s")})
        now = materialize(heard.select(*now.columns), "waiting")


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of turns (conv_id, place, item, bytes) and of all conversations (conv_id), turnless ones included.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    own, ends = nodes(rows, convs)
    totals = peeled(stretches(own)).select("conv_id", "n_convs", "up_conv", "from", "to", F.col("path").alias("whole"), "own", "kids", "leaves", "saved")
    here = (F.col("n_convs") - 1) * (F.col("whole") - F.col("path") + F.col("bytes"))
    both = own.join(totals, ["conv_id", "n_convs"]).select(
        *NODE, "conv_id", F.when(F.col("depth") == F.col("from"), F.col("up_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(F.col("depth") == F.col("to"), F.col("kids")).otherwise(1).alias("n_children"), F.col("leaves").alias("n_leaves"), (F.col("saved") - F.col("own") + here).alias("saved_tokens"),
    )
    named = both.join(end_digests(ends), NODE, "left")
    return named.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def digests(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations rebuilt from shared starts."""
    return trie(*with_shared_starts(turns(conversations)))


def _crc_table() -> list[int]:
    """Remainders of all bytes for the polynomial of CRC-32, for SQL that has no such function."""
    out = list(range(256))
    for _ in range(8):
        out = [x >> 1 ^ 0xEDB88320 if x & 1 else x >> 1 for x in out]
    return out


ORACLE = r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    md5(CAST(octet_length(encode(coalesce(role, ''))) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS item, octet_length(encode(coalesce(text, ''))) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item) AS k FROM src),
ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, n,
    xor(list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: xor(c >> 8, {crc}[xor(c, b) % 256 + 1])), 4294967295) % 9 AS h
  FROM (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id)),
pos AS (SELECT a.conv_id, a.h, least(a.h, coalesce(b.n, 0)) AS m FROM ids a LEFT JOIN ids b ON a.base = b.conv_id),
r AS (
  SELECT i.conv_id, o.k AS d, o.item, o.bytes FROM ids i JOIN own o ON o.conv_id = i.base WHERE o.k <= i.h
  UNION ALL SELECT o.conv_id, o.k - p.h + p.m, o.item, o.bytes FROM own o JOIN pos p ON o.conv_id = p.conv_id WHERE o.k > p.h),
path AS (
  SELECT conv_id, d, bytes, md5(string_agg(item, '') OVER (PARTITION BY conv_id ORDER BY d)) AS node FROM r
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM ids),
last AS (SELECT conv_id, max(d) AS d FROM path GROUP BY conv_id),
nodes AS (
  SELECT p.node, p.d, min(p.conv_id) AS conv_id, count(*) AS n_convs, min(p.bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) FILTER (p.d = l.d), '')) AS ends
  FROM path p JOIN last l ON p.conv_id = l.conv_id GROUP BY p.node, p.d),
up AS (SELECT n.node, q.conv_id AS parent_conv_id, q.node AS parent FROM nodes n JOIN path a ON a.conv_id = n.conv_id AND a.d = n.d - 1 JOIN nodes q ON q.node = a.node),
kids AS (SELECT parent AS node, count(*) AS n FROM up GROUP BY parent),
flat AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.node = k.node),
sub AS (
  SELECT a.node, count(*) FILTER (y.n_children = 0) AS n_leaves, sum((y.n_convs - 1) * y.bytes) AS saved_tokens
  FROM flat y JOIN path a ON a.conv_id = y.conv_id AND a.d <= y.d GROUP BY a.node)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, u.parent_conv_id, f.n_convs, f.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM flat f JOIN sub s ON s.node = f.node LEFT JOIN up u ON u.node = f.node
""".replace("{crc}", f"CAST({_crc_table()} AS BIGINT[])")
