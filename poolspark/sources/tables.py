"""Parquet and tab-separated tables of alignments, calls, designs and models."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from poolspark.functions import barcode
from poolspark.operators import qc
from poolspark.schema import ALIASES, QC

GENOME_FILE = r"filtered_(.+)_QCMapping"


def _files(spark: SparkSession, folder: str) -> list[str]:
    """Paths in a folder of any store that Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(path)) if fs.exists(path) else []


def exists(spark: SparkSession, path: str) -> bool:
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(own)


def changed(spark: SparkSession, path: str) -> int:
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(own).getModificationTime()


def discover(spark: SparkSession, folder: str) -> dict[str, str]:
    """Path by genome of ``filtered_<genome>_QCMapping`` files; Parquet wins only if it covers every genome that text does.

    A folder that is missing or has no such file is an error.
    """
    if not exists(spark, folder):
        raise FileNotFoundError(f"no folder {folder}")

    found: dict[str, dict[str, str]] = {"parquet": {}, "text": {}}
    for path in _files(spark, folder):
        if m := re.search(rf"{GENOME_FILE}\.(parquet|tsv|txt)(\.gz)?$", path):
            found["parquet" if m[2] == "parquet" else "text"][m[1]] = path
    if not found["parquet"] and not found["text"]:
        raise FileNotFoundError(f"no filtered_*_QCMapping files in {folder}")
    return found["parquet"] if found["parquet"] and set(found["parquet"]) >= set(found["text"]) else found["text"] or found["parquet"]


def read_qc(spark: SparkSession, path: str) -> DataFrame:
    """A QC table with the locked types; other columns are an error."""
    df = spark.read.parquet(path)
    if df.columns != QC.fieldNames():
        raise ValueError(f"columns {df.columns}, expected {QC.fieldNames()}")
    return spark.read.schema(QC).parquet(path)


def read_genomes(spark: SparkSession, folder: str) -> DataFrame:
    """All genomes' filtered tables of a folder with a column Genome, which comes from a file's name: one scan, however many genomes.

    Parquet tables have the locked columns, others are an error.  Texts are read in one scan for each header that occurs.
    """
    found = discover(spark, folder)
    parquet = [p for p in found.values() if p.endswith(".parquet")]
    by_header: dict[tuple[str, ...], list[str]] = {}
    for p in found.values():
        if p in parquet:
            read_qc(spark, p)  # looks at the columns, plans no scan that is kept
        else:
            by_header.setdefault(tuple(spark.read.option("sep", "\t").option("header", True).csv(p).columns), []).append(p)
    parts = [with_genome_from_path(spark.read.schema(QC).parquet(*parquet))] if parquet else []
    for header, paths in by_header.items():
        text = StructType([StructField(c, StringType()) for c in header])
        rows = with_genome_from_path(spark.read.option("sep", "\t").option("nullValue", "").option("header", True).schema(text).csv(paths), "__genome")
        parts.append(with_defaults_of(rows, "__genome").withColumnRenamed("__genome", "Genome"))
    return reduce(DataFrame.unionByName, parts)


def with_genome_from_path(df: DataFrame, name: str = "Genome") -> DataFrame:
    """The genome that the file of a row is named by, from the columns that every file has without being read."""
    path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    return df.select("*", F.regexp_extract(path, GENOME_FILE + r"\.(?:parquet|tsv|txt)", 1).alias(name))


def read_qc_tsv(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Header-less rows in QC order, or rows under a header; empty fields are null."""
    read = spark.read.option("sep", "\t").option("nullValue", "").option("header", header)
    if header:
        return with_defaults_of(read.csv(path))
    return read.schema(QC).csv(path)


def with_defaults_of(df: DataFrame, *more: str) -> DataFrame:
    """QC types for a table under any known header; frag_loc empty where the file has none.  Columns of ``more`` stay."""
    df = renamed(df)
    if "frag_loc" not in df.columns:
        df = df.withColumn("frag_loc", F.lit(""))
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in QC.fields], *more)


def renamed(df: DataFrame, needed: tuple[str, ...] = ()) -> DataFrame:
    """Columns under the names of this package, whatever their case; missing ``needed`` ones are an error."""
    out = df.withColumnsRenamed({c: ALIASES[c.lower()] for c in df.columns if c.lower() in ALIASES})
    if missing := [c for c in needed if c not in out.columns]:
        raise ValueError(f"no column for {', '.join(missing)}")
    return out


@dataclass(frozen=True)
class Checked:
    """What was read of text files, and what could not be: lines with a wrong number of fields, and files that break off."""

    rows: DataFrame
    bad_lines: DataFrame
    bad_files: list[str]

    def report(self) -> DataFrame:
        """(path, n_bad_lines, readable) of the files with anything wrong."""
        spark = self.rows.sparkSession
        lines = self.bad_lines.groupBy("path").agg(F.count("*").alias("n_bad_lines")).withColumn("readable", F.lit(True))
        files = spark.createDataFrame([(p,) for p in self.bad_files], "path string").select("path", F.lit(None).cast("long").alias("n_bad_lines"), F.lit(False).alias("readable"))
        return lines.unionByName(files)


def readable(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[str]]:
    """Files that can be read to their end, and the others.

    All are read at once; only if that fails are they halved, so a bad file costs as many
    further jobs as halving takes to find it.
    """
    if not paths:
        return [], []
    try:
        spark.read.text(paths).write.format("noop").mode("overwrite").save()
    except (Py4JJavaError, PySparkException):
        pass
    else:
        return paths, []
    if len(paths) == 1:
        return [], paths
    half = len(paths) // 2
    (good, bad), (more, worse) = readable(spark, paths[:half]), readable(spark, paths[half:])
    return good + more, bad + worse


def read_checked(spark: SparkSession, path: str | list[str], needed: tuple[str, ...] = ()) -> Checked:
    """Tab-separated text under one header, as strings; lines with too few or too many fields and files that break off are set aside.

    Empty fields are null; empty lines and the header, which every file may begin with, are no rows.
    """
    paths = [path] if isinstance(path, str) else list(path)
    good, bad = readable(spark, paths)
    if not good:
        raise ValueError(f"none of {len(paths)} files can be read, the first is {paths[0]}")
    first = spark.read.text(good[0]).first()
    if first is None:
        raise ValueError(f"{good[0]} has no header")
    header = first["value"].rstrip("\r")
    names = header.split("\t")
    renamed(spark.createDataFrame([], StructType([StructField(c, StringType()) for c in names])), needed)  # an error if columns are missing
    seen = spark.read.text(good).select(F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_path").alias("path")).where((F.col("line") != "") & (F.col("line") != header))
    fields = F.split("line", "\t", -1)
    whole = F.size(fields) == len(names)
    filled = lambda i: F.when(F.get(fields, F.lit(i)) != "", F.get(fields, F.lit(i)))
    rows = seen.where(whole).select(*[filled(i).alias(c) for i, c in enumerate(names)])
    return Checked(renamed(rows, needed), seen.where(~whole).select("path", "line"), bad)


def read_assign(spark: SparkSession, path: str | list[str], quarantine: str | None = None) -> DataFrame:
    """Rows of the assign stage from tab-separated text; malformed lines and files that break off are left out.

    With ``quarantine``, a folder, they are listed there: ``lines`` has each line and its file, ``files`` counts by file.
    """
    own = read_checked(spark, path, ("BC", "Read", "Genome"))
    if quarantine:
        own.bad_lines.write.mode("overwrite").parquet(f"{quarantine}/lines")
        own.report().write.mode("overwrite").parquet(f"{quarantine}/files")
    kinds = {"as_": "int", "MAPQ": "int", "NM": "int", "XAcount": "int", "p_as": "double", "p_mq": "double"}
    return own.rows.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else c for c in own.rows.columns])


def read_calls(spark: SparkSession, path: str) -> DataFrame:
    """Calls with all text columns; missing ones are empty."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    df = df.withColumnsRenamed({c: "barcode" for c in df.columns if c.lower() in ("bc", "barcode")})
    for c in ("call", "model", "genome_1", "genome_2", "indist_set"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(""))
    return df


def read_drop_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).csv(path).select("read_id").na.drop().distinct()


def read_bam_map(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(bam_id, bam_path) of a table with these columns, in its order."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    if missing := {"bam_id", "bam_path"} - set(df.columns):
        raise ValueError(f"no column for {', '.join(sorted(missing))}")
    return [(r["bam_id"], r["bam_path"]) for r in df.select("bam_id", "bam_path").collect()]  # one row for each BAM


def read_plate_map(spark: SparkSession, path: str) -> DataFrame:
    """(sample, wells) of lines ``sample TAB A1-12,B3``; text behind # is a comment."""
    line = F.trim(F.regexp_replace("value", "#.*$", ""))
    own = spark.read.text(path).select(line.alias("line")).where("line <> ''")
    return own.select(F.trim(F.split_part("line", F.lit("\t"), F.lit(1))).alias("sample"), F.trim(F.split_part("line", F.lit("\t"), F.lit(2))).alias("wells"))


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).csv(path)


def read_design(spark: SparkSession, path: str, mode: str = "before-dash", n: int = 10) -> DataFrame:
    """(bc_key, expected_genome) of a table with columns barcode and expected_genome."""
    own = spark.read.option("sep", "\t").option("header", True).csv(path)
    return own.select(barcode.design_key(F.col("barcode"), mode, n).alias("bc_key"), "expected_genome")


def write_sorted(df: DataFrame, path: str) -> None:
    """Parquet sorted by barcode, so readers skip row groups; an empty table keeps its columns."""
    df.repartitionByRange("BC").sortWithinPartitions("BC").write.mode("overwrite").option("parquet.block.row.count.limit", 100_000).parquet(path)


def write_tsv(df: DataFrame, path: str, header: bool = False, compression: str = "none") -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", header).option("nullValue", "").option("emptyValue", "").option("compression", compression).csv(path)


def formatted_calls(calls: DataFrame) -> DataFrame:
    """Calls as text: numbers with six significant digits, missing values empty; a barcode twice is an error."""
    twice = calls.groupBy("barcode").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"barcode {twice[0]['barcode']} has more than one call")
    real = {f.name for f in calls.schema if isinstance(f.dataType, DoubleType | FloatType)}
    return calls.select(*[F.when(F.col(c).isNotNull(), F.format_string("%.6g", c)).otherwise("").alias(c) if c in real else F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in calls.columns])


def migrate(spark: SparkSession, source: str, target: str, mapq_min: int = 0, xa_max: int = -1) -> None:
    """Text under a header to sorted Parquet, optionally filtered; kept as it is if the target is whole and newer than its source."""
    done = f"{target}/_SUCCESS"
    if not exists(spark, done) or changed(spark, done) < changed(spark, source):
        write_sorted(qc.alignment_filter(read_qc_tsv(spark, source, header=True), mapq_min, xa_max), target)


def migrate_all(spark: SparkSession, folder: str, mapq_min: int = 0, xa_max: int = -1) -> list[str]:
    """Every ``filtered_*_QCMapping`` text of a folder as Parquet beside it; without any an error."""
    found = [p for p in _files(spark, folder) if re.search(rf"{GENOME_FILE}\.(tsv|txt)(\.gz)?$", p)]
    if not found:
        raise FileNotFoundError(f"no filtered_*_QCMapping texts in {folder}")
    out = []
    for p in found:
        out.append(re.sub(r"\.(tsv|txt)(\.gz)?$", ".parquet", p))
        migrate(spark, p, out[-1], mapq_min, xa_max)
    return out


def save_model(edges: DataFrame, tails: DataFrame, path: str) -> None:
    edges.write.mode("overwrite").parquet(f"{path}/edges")
    tails.write.mode("overwrite").parquet(f"{path}/tails")


def load_model(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/edges"), spark.read.parquet(f"{path}/tails")
