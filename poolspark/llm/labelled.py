"""Bounded samples of labelled documents for learning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_crc(doc_id: Column) -> Column:
    """CRC-32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def sample(docs: DataFrame, labels: DataFrame, most: int, where: str = "true", label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label) of up to ``most`` labelled documents, the first by a hash of their ids; texts are whole.

    ``where`` is a condition on doc_id.  Rows without an id or a label are left out; an
    id with several labels has the largest, one with several texts the first by a
    hash, so there are ``most`` rows at most.  The ids, at most ``most``, are broadcast.
    """
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null").where(where)
    chosen = named.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = own.join(F.broadcast(chosen), "doc_id").withColumn("place", F.struct(F.xxhash64("text"), "text"))
    return found.groupBy("doc_id", "label").agg(F.min("place").alias("place")).select("doc_id", "place.text", "label")
