"""What several text operators share."""

from __future__ import annotations

import ctypes
import functools

from pyspark.sql import DataFrame, SparkSession

#: The white space of the word rule ``[^\x20\x09-\x0D]+``.
SPACE = "\\x20\\x09-\\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(sizes, limit: int):
    """(start, stop) of consecutive rows of about ``limit`` bytes; a larger row stands alone."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def plain(texts):
    """A slice of strings as an array of its own with large offsets and without nulls.

    Some kernels read past the start of a slice that was only cast.
    """
    import pyarrow as pa

    return pa.concat_arrays([texts, texts.slice(0, 0)]).cast(pa.large_string()).fill_null("")


def tidied(batches):
    """A generator of batches that gives its worker's free memory back at the end: workers outlive their tasks."""

    @functools.wraps(batches)
    def run(*args):
        try:
            yield from batches(*args)
        finally:
            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # not in this C library
                pass

    return run
