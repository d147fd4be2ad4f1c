"""Barcode frequency filter, chunks, unions and the alignment filter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolspark.functions import barcode
from poolspark.plans.ordered import running_sums
from poolspark.schema import QC


def with_defaults(rows: DataFrame) -> DataFrame:
    """MAPQ and XAcount 0 and frag_loc empty where missing; as_ and NM stay null; the types of a QC table."""
    filled = rows.withColumns({"MAPQ": F.coalesce("MAPQ", F.lit(0)), "XAcount": F.coalesce("XAcount", F.lit(0)), "frag_loc": F.coalesce("frag_loc", F.lit(""))})
    return filled.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in QC.fields})


def frequent_barcodes(rows: DataFrame, min_freq: int, sample: str | None = None) -> DataFrame:
    """Rows of barcodes with ``min_freq`` rows or more, counted after normalising if a sample is named.

    Counts come from a pre-aggregated group-by, so a frequent barcode's rows need not meet in one task.
    """
    if sample is not None:
        rows = rows.withColumn("BC", barcode.normalized(F.col("BC"), sample))
    often = rows.groupBy("BC").agg(F.count("*").alias("n")).where(F.col("n") >= min_freq).select("BC")
    return with_defaults(rows.join(often, "BC", "left_semi").select(rows.columns))


def alignment_filter(rows: DataFrame, mapq_min: int = 20, xa_max: int = 2) -> DataFrame:
    """Rows of ``mapq_min`` or more and ``xa_max`` or fewer; a bound of 0 or below 0 is off; null fails."""
    if mapq_min > 0:
        rows = rows.where(F.col("MAPQ") >= mapq_min)
    if xa_max >= 0:
        rows = rows.where(F.col("XAcount") <= xa_max)
    return rows


def filter_counters(mapq_min: int = 20, xa_max: int = 2) -> list[Column]:
    """Aggregates that say what ``alignment_filter`` keeps and why it drops rows, for ``DataFrame.observe``."""
    low = ~F.coalesce(F.col("MAPQ") >= mapq_min, F.lit(False)) if mapq_min > 0 else F.lit(False)
    many = ~F.coalesce(F.col("XAcount") <= xa_max, F.lit(False)) if xa_max >= 0 else F.lit(False)
    return [F.count(F.lit(1)).alias("n_rows"), F.count_if(low).alias("n_low_mapq"), F.count_if(~low & many).alias("n_many_hits"), F.count_if(~low & ~many).alias("n_kept")]


def union_genomes(by_genome: dict[str, DataFrame]) -> DataFrame:
    """All genomes' rows with a column Genome."""
    return reduce(DataFrame.unionByName, [df.withColumn("Genome", F.lit(g)) for g, df in by_genome.items()])


def distinct_barcodes(*tables: DataFrame) -> DataFrame:
    """Barcodes of several tables once each; empty ones are left out."""
    return reduce(DataFrame.union, [t.select("BC") for t in tables]).where("BC <> ''").distinct()


def barcode_chunks(barcodes: DataFrame, size: int) -> DataFrame:
    """(BC, chunk_id): sorted distinct barcodes cut every ``size``, numbered from 1."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    ranked = running_sums(barcodes.select("BC"), "BC", {"rank": F.lit(1)})
    return ranked.select("BC", (F.floor((F.col("rank") - 1) / size) + 1).cast("long").alias("chunk_id"))


def chunk_span(span: str) -> tuple[int, int]:
    """The ends of ``START:END``."""
    start, sep, end = span.partition(":")
    if not sep or not start.strip().isdigit() or not end.strip().isdigit() or int(end) <= int(start):
        raise ValueError(f"a range of chunks is START:END, not {span!r}")
    return int(start), int(end)


def chunk_slice(chunks: DataFrame, span: str) -> DataFrame:
    """The chunks of ``START:END``, counted from 0, without END."""
    start, end = chunk_span(span)
    return chunks.where((F.col("chunk_id") > start) & (F.col("chunk_id") <= end))


def cap_rows(rows: DataFrame, most: int | None) -> DataFrame:
    """The first ``most`` rows of each genome by a hash of all columns, for trial runs; None or 0 is no cap.

    The same rows on each run, but for rows that are wholly equal.
    """
    if not most:
        return rows
    genomes = sorted(r[0] for r in rows.where("Genome is not null").select("Genome").distinct().collect())  # as many as there are references
    first = lambda g: rows.where(F.col("Genome") == g).orderBy(F.xxhash64(*rows.columns), *sorted(rows.columns)).limit(most)
    return reduce(DataFrame.unionByName, [first(g) for g in genomes], rows.where("false"))


def semi_barcodes(rows: DataFrame, barcodes: DataFrame) -> DataFrame:
    return rows.join(barcodes.select("BC").distinct(), "BC", "left_semi")


def sample_barcodes(barcodes: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` barcodes, the first by a seeded hash; 0 means all."""
    own = barcodes.select("BC").distinct()
    return own.orderBy(F.xxhash64("BC", F.lit(seed)), "BC").limit(n) if n else own
