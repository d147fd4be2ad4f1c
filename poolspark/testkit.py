"""Alignment-shaped views over the driver's tables; the same SQL text serves Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QC_SQL = """
SELECT 'r' || lpad(CAST(l.l_orderkey AS STRING), 8, '0') AS Read,
  'BC' || lpad(CAST(o.o_custkey AS STRING), 6, '0') || '-S1' AS BC,
  'BC' || lpad(CAST(o.o_custkey AS STRING), 6, '0') || CASE WHEN l.l_linenumber % 2 = 0 THEN '-lib A' ELSE '' END AS BC_raw,
  'G' || CAST(l.l_suppkey % 5 AS STRING) AS Genome,
  CAST(20 + l.l_partkey % 41 AS SMALLINT) AS MAPQ,
  CASE WHEN l.l_partkey % 97 = 0 THEN NULL
       ELSE CAST(50 + floor(l.l_quantity) + l.l_partkey % 50
            + CASE WHEN l.l_suppkey % 5 = o.o_custkey % 5 THEN 30
                   WHEN o.o_custkey % 7 = 0 AND l.l_suppkey % 5 = (o.o_custkey + 1) % 5 THEN 30 ELSE 0 END AS INTEGER) END AS as_,
  CASE WHEN l.l_partkey % 89 = 0 THEN NULL
       WHEN l.l_suppkey % 5 = o.o_custkey % 5 THEN 0
       WHEN o.o_custkey % 7 = 0 AND l.l_suppkey % 5 = (o.o_custkey + 1) % 5 THEN 0
       ELSE CAST((l.l_linenumber - 1) % 4 AS INTEGER) END AS NM,
  CAST(l.l_suppkey % 4 AS SMALLINT) AS XAcount,
  'chr' || CAST(l.l_suppkey % 3 AS STRING) || ':' || CAST((l.l_partkey * 37) % 20000 AS STRING) || ':'
        || CASE WHEN l.l_linenumber = 7 THEN '-1' ELSE CAST((l.l_partkey * 37) % 20000 + 180 AS STRING) END AS frag_loc
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

DESIGN_SQL = """
SELECT DISTINCT 'BC' || lpad(CAST(o_custkey AS STRING), 6, '0') AS bc_key, 'G' || CAST(o_custkey % 5 AS STRING) AS expected_genome
FROM {orders} WHERE o_custkey % 11 <> 0
"""

SAMPLES_SQL = """
SELECT 'BC' || lpad(CAST(c.c_custkey AS STRING), 6, '0') || '-S1' AS BC, 'S' || CAST(n.n_regionkey AS STRING) AS sample
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

#: Bytes of lineitem's files, about a million rows, whose join is one task.
TASK_BYTES = 16 << 20

#: sample -> well ranges of a plate
PLATE_MAP = (("S0", "A1-12,B3"), ("S1", "B4-8"), ("S2", "C1-3,D1-3"), ("S3", "E12"), ("S4", "F1-2,H9-12"))

#: barcode, call, model, genome_1, genome_2, indist_set: rows for each line of the allowed-set table
CALLS_FIX = (
    ("BC000001-S1", "empty", "empty", None, None, None), ("BC000002-S1", "ambiguous", "single", "G2", "G1", None), ("BC000003-S1", "doublet", "doublet", "G3", "G4", None),
    ("BC000004-S1", "weak_doublet", None, "G3", "G4", None), ("BC000005-S1", "single_clean", "single", "G0", None, None), ("BC000006-S1", "dirty_singlet", "single", "G2", None, None),
    ("BC000007-S1", "indistinguishable", None, "G2", "G3", "G1, G2"), ("BC000008-S1", "weak_doublet", "doublet", "G3", "G1", None), ("BC000009-S1", "low_reads", None, None, None, None),
    ("BC000010-S1", "uncalled", "None", "nan", None, None), ("BC000011-S1", "single_clean", "single", "G1", None, None), ("BC000022-S1", "doublet", "doublet", "G1", "G2", None),
    ("BC000013-S1", "ambiguous", "doublet", None, None, None), ("BC000014-S1", "indistinguishable", None, None, None, None), ("BC000033-S1", "ambiguous", "single", "G3", "G0", None),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    return spark.sql(sql, **{t: _table(spark, sf_dir, t) for t in tables})


def _bytes(spark: SparkSession, path: str) -> int:
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(own).getLength()


def qc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large tables are joined in as many tasks as hold ``TASK_BYTES`` of files each, so a task's memory does not grow with them."""
    own = {t: _table(spark, sf_dir, t) for t in ("lineitem", "orders")}
    parts = -(-_bytes(spark, f"{sf_dir}/lineitem.parquet") // TASK_BYTES)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        own = {t: df.repartition(parts, f"{t[0]}_orderkey") for t, df in own.items()}
    return spark.sql(QC_SQL, **own)


def design(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, DESIGN_SQL, "orders")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SAMPLES_SQL, "customer", "nation")


def plate_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PLATE_MAP), "sample string, wells string")


def calls_fix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CALLS_FIX), "barcode string, call string, model string, genome_1 string, genome_2 string, indist_set string")
