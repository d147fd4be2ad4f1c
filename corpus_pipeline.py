"""Corpus pipeline: quality, line dedup, near duplicates, leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on every document that the
one before it kept.  All but the last return the columns of ``documents``, and
keep further columns whatever their names.

Null and empty texts are documents like others: the classifier judges them, and
without words they are copies of nothing and hold no benchmark item.  Rows that
repeat an id, or have none, are judged one by one by the classifier; as lines
and benchmark items go they are one document; as near copies they go together,
and only if every one of them is a copy of a document with a smaller id, so no
text is lost for its neighbour's sake.  An empty table stays empty; without
labels nothing is rejected.  Texts are taken whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolspark.llm import bpe, decontam, jaccard_join, line_dedup, quality_mil
from poolspark.llm.common import documents, table, unused
from poolspark.llm.queries import word_vocabulary
from poolspark.plans.shared import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_mil.fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "score")
    return quality_mil.with_score(docs, model, name=score).where(F.col(score) >= 0.7).drop(score)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; their length follows."""
    drops = line_dedup.index(docs, min_chars=10).drops()
    return line_dedup.strip(docs, drops, counts=False).withColumn("n_chars", F.char_length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    name = unused(docs, "lost")
    groups = jaccard_join.near_duplicates(docs, percent=80, width=5)
    lost = groups.groupBy(F.col("doc_id").alias(name)).agg(F.every(~F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("all")).where("all").select(name)
    return docs.join(lost, F.col("doc_id").cast("long").eqNullSafe(F.col(name)), "left_anti")


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"), percent=80, width=5)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return bpe.digests(bpe.encode(docs, word_vocabulary(), decode=True))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("near duplicates", near_duplicates), ("benchmark decontamination", leaks), ("BPE", tokens)]

#: A learned classifier and a tokenizer have no SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
