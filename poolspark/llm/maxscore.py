"""Exact top-k search by MaxScore (operator 12).

A vector of whole numbers is a document; each dimension is two terms, one for
the positive values and one for the negative ones, with postings of their sizes.
A query's weight times the largest posting bounds what a term can add.  With
the k-th best score so far as threshold, the terms of the smallest bounds whose
sum stays below it are *non-essential*: a vector in none of the essential
postings cannot compete.  Essential postings are traversed; of the vectors met,
those that could still reach the threshold with all other terms are competitive,
and the rest of their score is probed a few terms at a time while they are so,
terms that take away from it first.

Queries come in blocks of a bounded number, each broadcast to all vectors and
carried on from a threshold among its own queries; shards are merged by rank.
A block's answers are written before the next one starts.  Vectors of a shard are
read ``CHUNK`` rows at a time.

Scores are exact whole numbers; numbers beyond +-2**24 count as that, so that
sums of up to 2**14 products fit a long.  Shorter vectors end with zeros, and a
vector without components scores 0.  Vectors that are null or hold a null or a value
that is not finite take no part.  A query's candidates are the rows of another id:
rows that repeat an id are candidates one by one for others, and answer each for
itself as queries.  A null id never is a query, comes last among ties and stays null.
Without vectors there are no rows.  Columns other than those named are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poolspark.llm.common import tidied
from poolspark.plans.shared import materialize, new_path

#: Queries of a block, about; a block of 64 components takes 4 MB.
BLOCK = 8192
#: Queries of a block that give its first thresholds.
SEEDS = 512
#: Vectors that are searched at a time.
CHUNK = 4096
#: Terms that are probed between two looks at the bounds.
PROBED = 8
#: A posting list that holds this share of a chunk is kept as a column.
DENSE = 1 / 8
LARGEST = 1 << 24


def whole(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, without vectors that are null or hold a null or non-finite value."""
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    usable = F.col("x").isNotNull() & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    size = lambda x: F.floor(F.greatest(F.least(x * float(scale), F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
    return own.where(usable).select("vec_id", F.transform("x", size).cast("array<int>").alias("v"))


def matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of whole numbers; shorter ones end with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


class Best:
    """The k best (score, id) of each query so far: scores from best to worst, ties by id, missing places last."""

    #: below every score, and so that it has an opposite number
    LOW = np.iinfo(np.int64).min + 1

    def __init__(self, queries: int, k: int, floors: np.ndarray):
        self.k, self.floors = k, floors
        self.scores = np.full((queries, k), self.LOW)
        self.ids, self.known = np.zeros((queries, k), np.int64), np.zeros((queries, k), bool)
        self.held = np.zeros(queries, np.int64)

    def threshold(self, q: int) -> int:
        """What a further vector has to reach."""
        return max(self.floors[q], self.scores[q, -1])

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        n = self.held[q]
        s, i, g = np.r_[self.scores[q, :n], scores], np.r_[self.ids[q, :n], ids], np.r_[self.known[q, :n], known]
        order = np.lexsort((i, ~g, -s))[: self.k]
        self.held[q] = len(order)
        self.scores[q, : len(order)], self.ids[q, : len(order)], self.known[q, : len(order)] = s[order], i[order], g[order]


class Postings:
    """A chunk's terms: 2 * d holds the positive values of dimension d, 2 * d + 1 the negative ones, as positive sizes."""

    def __init__(self, v: np.ndarray):
        self.v, n = v, len(v)
        self.sizes = np.empty((2 * v.shape[1], n), np.int64)
        np.maximum(v.T, 0, out=self.sizes[0::2])
        np.maximum(-v.T, 0, out=self.sizes[1::2])
        self.most = self.sizes.max(1, initial=0)
        self.lists = {t: np.flatnonzero(x) for t, x in enumerate(self.sizes) if np.count_nonzero(x) < DENSE * n}

    def traverse(self, t: int, weight: int, total: np.ndarray) -> None:
        at = self.lists.get(t)
        if at is None:
            total += weight * self.sizes[t]
        else:
            total[at] += weight * self.sizes[t, at]


def search_chunk(p: Postings, ids: np.ndarray, known: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, best: Best) -> int:
    """Take a chunk's vectors into the best of all queries; the number of vectors that were scored in full."""
    n, scored = len(ids), 0
    for q, w in enumerate(queries):
        dims = np.flatnonzero(w)
        terms, weight = 2 * dims + (w[dims] < 0), np.abs(w[dims])
        bound = weight * p.most[terms]
        order = np.argsort(bound, kind="stable")
        least = best.threshold(q)
        below = np.cumsum(bound[order])
        free = int(np.searchsorted(below, least, "left"))  # sums below the threshold
        rest = int(below[free - 1]) if free else 0
        total = np.zeros(n, np.int64)
        for i in order[free:]:
            p.traverse(int(terms[i]), int(weight[i]), total)
        # a vector that no essential posting holds has nothing but the rest, which is below the threshold
        competes = total + rest >= least
        if free:
            competes &= total > 0
        own = np.flatnonzero(competes)
        own = own[~(known[own] & (ids[own] == query_ids[q]))]
        score = total[own]
        # what takes away from the score, of all terms, then what is left of the non-essential ones
        against = terms ^ 1
        heavy = np.argsort(-(weight * p.most[against]), kind="stable")
        todo = [(against[heavy], -weight[heavy], np.zeros(len(heavy), np.int64))]
        todo.append((terms[order[:free][::-1]], weight[order[:free][::-1]], bound[order[:free][::-1]]))
        for which, factor, most in todo:
            for a in range(0, len(which), PROBED):
                if not len(own):
                    break
                part = which[a : a + PROBED]
                score = score + factor[a : a + PROBED] @ p.sizes[part[:, None], own]
                rest -= int(most[a : a + PROBED].sum())
                alive = score + rest >= least
                own, score = own[alive], score[alive]
        scored += len(own)
        if len(own):
            best.add(q, score, ids[own], known[own])
    return scored


def _bounds(ids: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that k vectors of other ids reach for certain: those of the block's first queries."""
    seeds, out = min(SEEDS, len(ids)), np.full(len(ids), Best.LOW)
    for a in range(0, len(ids), CHUNK):
        score = np.where(ids[a : a + CHUNK, None] == ids[None, :seeds], Best.LOW, v[a : a + CHUNK] @ v[:seeds].T)
        if seeds >= k:
            out[a : a + CHUNK] = -np.partition(-score, k - 1, axis=1)[:, k - 1]
    return out


@tidied
def _search(query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int, seen):
    best = Best(len(queries), k, floors)
    for batch in seen:
        for a in range(0, batch.num_rows, CHUNK):
            part = batch.slice(a, CHUNK)
            ids = part.column("vec_id")
            v = matrix(part.column("v"), queries.shape[1])[:, : queries.shape[1]]
            search_chunk(Postings(v), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), queries, query_ids, best)
    own = np.arange(k) < best.held[:, None]
    row = np.repeat(np.arange(len(queries)), best.held)
    ids = pa.array(best.ids[own], mask=~best.known[own])
    yield pa.record_batch({"query": pa.array(row, pa.int64()), "query_id": pa.array(query_ids[row], pa.int64()), "vec_id": ids, "score": pa.array(best.scores[own])})


def search(queries: DataFrame, vectors: DataFrame, k: int = 5, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors of the largest inner product with each query.

    Both sides are (vec_id, v) as ``whole`` gives them.  ``block`` queries, about, are searched in a round.
    """
    spark = vectors.sparkSession
    own = materialize(queries.where("vec_id IS NOT NULL").select("vec_id", "v", F.monotonically_increasing_id().alias("row")), "queries")
    rounds = max(1, -(-own.count() // block))
    dealt = f"{new_path(spark, 'query-blocks')}/table"
    own.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(rounds))).repartition("block").write.partitionBy("block").parquet(dealt)
    found = f"{new_path(spark, 'found')}/table"
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    for b in range(rounds):
        held = spark.read.schema("vec_id long, v array<int>, row long, block int").parquet(dealt).where(F.col("block") == b).select("vec_id", "v").toArrow().combine_chunks()
        if held.num_rows:
            ids, q = held.column("vec_id").to_numpy(), matrix(held.column("v").combine_chunks())
            args = spark.sparkContext.broadcast((ids, q, _bounds(ids, q, k)))
            parts = vectors.mapInArrow(lambda seen, args=args: _search(*args.value, k, seen), "query long, query_id long, vec_id long, score long")
            top = parts.withColumn("rank", rank).where(F.col("rank") <= k)
            top.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(found)
            args.unpersist()
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(found) if _there(spark, found) else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def _there(spark, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def top(vectors: DataFrame, k: int = 5, every: int = 50, **cols: str) -> DataFrame:
    """The search of the rows whose id is divisible by ``every`` against all rows."""
    own = whole(vectors, **cols)
    return search(own.where(F.col("vec_id") % every == 0), own, k)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, 1 + least(len(q.x), len(c.x))), lambda i: q.x[i] * c.x[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5
"""
