"""What stages leave in a sample's folder, and how the next ones find it.

A sample's folder is ``<workdir>/<sample>``.  Paths may lie in any store that
Spark reads; only lists of names and JSON of a few kilobytes pass the driver.
"""

from __future__ import annotations

import gzip
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolspark.sources import tables


def _fs(spark: SparkSession, path: str):
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own, own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def matches(spark: SparkSession, *patterns: str) -> list[str]:
    """Files with any bytes that fit one of the patterns, once each and sorted."""
    found = set()
    for p in patterns:
        own, fs = _fs(spark, p)
        found |= {s.getPath().toString() for s in fs.globStatus(own) or [] if s.isDirectory() or s.getLen() > 0}
    return sorted(found)


# Where assign outputs and chunk lists are looked for, in this order.
ASSIGN_PATTERNS = ("chunks/cell_map_ref_chunks/*_filtered.tsv.gz", "chunks/cell_map_ref_chunks/*_filtered.tsv", "chunks/cell_map_ref_chunks/*filtered.tsv.gz", "chunks/cell_map_ref_chunks/*filtered.tsv", "cell_map_ref_chunks/*_filtered.tsv.gz")
CHUNK_PATTERNS = ("chunks/cell_map_ref_chunks/*cell_map_ref_chunk_*.txt", "chunks/cell_map_ref_chunks/*chunk_*.txt", "cell_map_ref_chunks/*chunk_*.txt")
MERGED_WINNERS = "final/{sample}_per_read_winner.tsv.gz"
CHUNK_WINNERS = "cell_map_ref_chunks/{sample}_cell_genotype_reads_chunk_*.txt"


def first_matches(spark: SparkSession, root: str, patterns: tuple[str, ...]) -> list[str]:
    """The files of the first pattern below ``root`` that fits any; none at all is an error."""
    for p in patterns:
        if found := matches(spark, f"{root}/{p}"):
            return found
    raise FileNotFoundError(f"nothing below {root} fits {', '.join(patterns)}")


def assign_outputs(spark: SparkSession, root: str) -> list[str]:
    return first_matches(spark, root, ASSIGN_PATTERNS)


def chunk_lists(spark: SparkSession, root: str) -> list[str]:
    return first_matches(spark, root, CHUNK_PATTERNS)


def read_winners(spark: SparkSession, workdir: str, sample: str, chunks: bool = True) -> DataFrame | None:
    """The merged table of winner reads, else all non-empty chunk tables; None without any.

    ``chunks`` false leaves the chunk tables out.  Tables without the needed columns are an error.
    """
    root = f"{workdir}/{sample}"
    found = matches(spark, f"{root}/{MERGED_WINNERS.format(sample=sample)}") or (matches(spark, f"{root}/{CHUNK_WINNERS.format(sample=sample)}") if chunks else [])
    if not found:
        return None
    df = tables.renamed(spark.read.option("sep", "\t").option("header", True).csv(found), ("BC", "Read", "Genome", "as_"))
    kinds = {"as_": "double", "XAcount": "int"}
    df = df.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])
    return None if df.isEmpty() else df


# ---- model files


def read_eta(spark: SparkSession, path: str) -> DataFrame:
    """(genome, eta) whatever the first column is called."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    return df.select(F.col(f"`{df.columns[0]}`").alias("genome"), F.col("eta").cast("double").alias("eta")).where("genome is not null")


def read_chi(spark: SparkSession, path: str) -> DataFrame:
    """(genome, chi) whatever the columns are called."""
    return spark.read.option("sep", "\t").option("header", True).csv(path).toDF("genome", "chi").select("genome", F.col("chi").cast("double").alias("chi"))


def read_phi(spark: SparkSession, path: str) -> DataFrame:
    """(anchor, target, phi) from a matrix with one row for each anchor."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    first, *targets = df.columns
    own = df.select(F.col(f"`{first}`").alias("anchor"), F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"`{t}`").cast("double").alias("phi")) for t in targets])).alias("x"))
    return own.select("anchor", "x.target", "x.phi")


def write_phi(phi: DataFrame, path: str, genomes: list[str]) -> None:
    """The matrix form of (anchor, target, phi)."""
    wide = phi.groupBy("anchor").pivot("target", genomes).agg(F.first("phi")).orderBy("anchor")
    write_tsv_file(wide, path)


def read_topk(spark: SparkSession, path: str) -> DataFrame:
    """(barcode, rank, genome) of lines: a barcode and its genomes, best first; empty fields are left out."""
    parts = F.split("value", "\t")
    own = spark.read.text(path).where("value <> ''").select(parts[0].alias("barcode"), F.filter(F.slice(parts, 2, 1 << 20), lambda g: g != "").alias("gs"))
    return own.select("barcode", F.posexplode("gs").alias("p", "genome")).select("barcode", (F.col("p") + 1).cast("int").alias("rank"), "genome")


# ---- single files


def merge_parts(spark: SparkSession, parts: list[str], target: str, header: list[str], compressed: bool = True) -> None:
    """One file of header-less text parts under a single header; gzip members are put one behind the other as they are."""
    line = ("\t".join(header) + "\n").encode()
    own, fs = _fs(spark, target)
    jvm = spark.sparkContext._jvm
    out = fs.create(own, True)
    try:
        out.write(bytearray(gzip.compress(line) if compressed else line))
        for p in parts:
            src, from_fs = _fs(spark, p)
            into = from_fs.open(src)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(into, out, 1 << 16, False)
            finally:
                into.close()
    finally:
        out.close()


def write_tsv_file(df: DataFrame, path: str) -> str:
    """``df`` as one tab-separated file with a header, compressed if its name says so; its parts are written side by side first."""
    spark, compressed = df.sparkSession, path.endswith(".gz")
    parts = f"{path}.parts"
    tables.write_tsv(df, parts, compression="gzip" if compressed else "none")
    merge_parts(spark, matches(spark, f"{parts}/part-*"), path, df.columns, compressed)
    own, fs = _fs(spark, parts)
    fs.delete(own, True)
    return path


def write_json(spark: SparkSession, path: str, value: object) -> None:
    """Written beside and renamed, so a file that exists is whole."""
    beside, fs = _fs(spark, f"{path}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(json.dumps(value, indent=2, sort_keys=True, default=str).encode()))
    finally:
        out.close()
    own, _ = _fs(spark, path)
    fs.delete(own, False)
    fs.rename(beside, own)


def remove(spark: SparkSession, path: str) -> None:
    own, fs = _fs(spark, path)
    fs.delete(own, True)


def read_json(spark: SparkSession, path: str):
    """The value, or None without the file."""
    if not tables.exists(spark, path):
        return None
    return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
