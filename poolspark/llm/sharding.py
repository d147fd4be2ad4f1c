"""Byte-limited shards by extendible hashing (operator 4); DataFrame operations only.

A document's hash is the first 60 bits of its id's MD5.  The directory starts
with one bucket for the empty prefix.  A bucket of more than ``limit`` bytes is
split on its next bit; all others stay, so depths differ and the directory
holds one entry for each bucket.  A round looks at several bits: bytes are
summed by prefix at every depth of the round, and a bucket closes at the first
depth where it fits, that is where it fits and the bucket it was split from did
not.  The first round looks at as many bits as buckets of the limit would need
for all bytes, and one more; the next ones at ``STEP``, and only rows of buckets
that are still too large enter them.  A round's sums are pre-aggregated before
they move, so they are about as many as its buckets.

Rows that repeat an id share all 60 bits; if they exceed the limit they are
split further on bits of a row number that is pinned in a written table.  One
document of more than ``limit`` bytes is a shard of its own, however long; texts
are only measured.  Null and empty texts have no bytes; null ids hash as the
empty string; an empty table has no shards.  Columns other than the id and the
text are not read and may have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolspark.plans.shared import materialize

BITS, STEP = 60, 6


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _bits(value: Column, depth: Column) -> Column:
    """The ``depth`` low bits of a prefix as text."""
    return F.when(depth == 0, "").otherwise(F.lpad(F.bin(value), depth, F.lit("0")))


def _rounds(first: int):
    """(bits looked at before, bits of the round) up to BITS."""
    k, step = 0, first
    while k < BITS:
        yield k, min(step, BITS - k)
        k, step = k + step, STEP


def shard_map(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, shard, depth, shard_bytes, shard_docs): each document's shard."""
    ids = F.col(id_col).cast("long")
    rows = docs.select(ids.alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), _hash(F.coalesce(ids.cast("string"), F.lit(""))).alias("h0"), F.monotonically_increasing_id().alias("row"))
    todo = materialize(rows.withColumn("base", F.lit("")), "shard-rows")
    done: list[DataFrame] = []
    total = todo.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    first_bits = min(24, max(1, total // max(1, limit)).bit_length() + 1)
    for word in range(2):
        for k, step in _rounds(first_bits):
            h = F.col(f"h{word}")
            keyed = todo.withColumn("fine", F.shiftright(h, BITS - k - step))
            cells = keyed.groupBy("base", "fine").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
            depths = cells.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(step)))).withColumn("prefix", F.expr(f"shiftright(fine, {step} - j)"))
            sums = depths.groupBy("base", "j", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
            fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)
            split = sums.where(~fits).select("base", (F.col("j") + 1).alias("j"), F.explode(F.expr("array(2 * prefix, 2 * prefix + 1)")).alias("prefix"))
            sums = sums.where(fits)
            leaves = sums.where("j = 0").unionByName(sums.where("j > 0").join(split, ["base", "j", "prefix"], "left_semi"))
            first = depths.join(leaves, ["base", "j", "prefix"]).select("base", "fine", F.struct("j", "prefix", "shard_bytes", "shard_docs").alias("leaf"))
            first = materialize(first, "shard-directory")
            own = keyed.join(first, ["base", "fine"], "left")
            closed = own.where("leaf is not null").select(
                "doc_id", "n_bytes", F.concat("base", _bits(F.col("leaf.prefix"), F.lit(k) + F.col("leaf.j"))).alias("shard"), "leaf.shard_bytes", "leaf.shard_docs"
            )
            done.append(closed)
            todo = own.where("leaf is null").drop("fine", "leaf")
            if todo.isEmpty():
                return _all(done)
            todo = materialize(todo, "shard-rows")
        base = F.concat("base", _bits(F.col(f"h{word}"), F.lit(BITS)))
        todo = todo.withColumn("base", base).withColumn("h1", _hash(F.concat_ws(":", F.lit("row"), F.col("row").cast("string"))))
    return _all([*done, todo.select("doc_id", "n_bytes", "base", "n_bytes", F.lit(1)).toDF("doc_id", "n_bytes", "shard", "shard_bytes", "shard_docs")])


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = reduce(DataFrame.unionByName, parts)
    return whole.select("doc_id", "n_bytes", "shard", F.length("shard").alias("depth"), "shard_bytes", F.col("shard_docs").cast("long").alias("shard_docs"))


def write_shards(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs``, whose ids must be unique, as one Parquet folder for each shard."""
    shards = shard_map(docs, limit, id_col, text_col).select(F.col("doc_id").alias("shard_doc"), F.concat(F.lit("b"), "shard").alias("shard"))
    docs.join(shards, docs[id_col].cast("long").eqNullSafe(shards["shard_doc"])).drop("shard_doc").repartition("shard").write.partitionBy("shard").parquet(path)


def oracle(limit: int) -> str:
    return f"""
WITH d AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
             CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
j AS (SELECT doc_id, n_bytes, CAST(j AS INTEGER) AS depth, h >> (60 - j) AS prefix FROM d, (SELECT unnest(range(0, 61)) AS j)),
s AS (SELECT depth, prefix, sum(n_bytes) AS shard_bytes, count(*) AS shard_docs FROM j GROUP BY ALL),
f AS (SELECT j.*, s.shard_bytes, s.shard_docs, row_number() OVER (PARTITION BY doc_id ORDER BY depth) AS rn
      FROM j JOIN s USING (depth, prefix) WHERE s.shard_bytes <= {limit} OR s.shard_docs = 1)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes,
       CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard, depth,
       CAST(shard_bytes AS BIGINT) AS shard_bytes, CAST(shard_docs AS BIGINT) AS shard_docs
FROM f WHERE rn = 1
"""
