"""Every registered query against its SQL on the smallest data."""

import pytest
from pyspark.sql import functions as F

from poolspark import catalogue, testkit
from poolspark.config import AssignConfig
from poolspark.operators import assign
from tests import oracle

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(DIR)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_sql(spark, duck, name):
    oracle.check(spark, duck, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name], DIR)


def test_bam_takes_every_row(spark):
    v = catalogue.Views(spark, DIR)
    count = lambda df: {r["Genome"]: r["count"] for r in df.groupBy("Genome").count().collect()}
    assert count(catalogue.QUERIES["bam_roundtrip"](spark, DIR)) == count(v.qc)


def test_models_count_all_barcodes(spark):
    n = 51_000
    rows = spark.range(n).selectExpr("concat('r', id) AS Read", "concat('B', id) AS BC", "'' AS BC_raw", "'G0' AS Genome", "30S AS MAPQ", "90 AS as_", "0 AS NM", "0S AS XAcount", "'chr1:1:-1' AS frag_loc")
    assert {r["metric"]: r["n"] for r in assign.Assignment(rows, AssignConfig()).hist().groupBy("metric").agg(F.sum("n").alias("n")).collect()} == {"as": n, "mapq": n}


def test_barcodes_of_all_genomes(spark):
    got = catalogue.QUERIES["distinct_barcodes"](spark, DIR)
    assert got.count() == catalogue.Views(spark, DIR).qc.where("BC <> ''").select("BC").distinct().count() == 150


def test_entry_names_every_query():
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["union_genomes", "distinct_barcodes"])
def test_genomes_are_dealt_out_in_one_pass(spark, name):
    plan = catalogue.QUERIES[name](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Relation") == 5


def test_large_tables_are_joined_in_more_tasks(spark, monkeypatch):
    want = sorted(map(tuple, testkit.qc(spark, DIR).collect()), key=repr)
    monkeypatch.setattr(testkit, "TASK_BYTES", 10_000)
    many = testkit.qc(spark, DIR)
    assert many._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 2
    assert sorted(map(tuple, many.collect()), key=repr) == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_simple_calls_read_profiles_and_shuffle_nothing(spark):
    v = catalogue.Views(spark, DIR)
    plan = _plan(v.simple_calls)
    assert "poolspark_profiles" in plan and "Exchange hashpartitioning" not in plan


def test_cross_mapping_is_counted_once(spark):
    assert "Aggregate" not in _plan(catalogue.Views(spark, DIR).genotyping.phi())


def test_mean_scores_are_written_once(spark):
    assert "Aggregate" not in _plan(catalogue.Views(spark, DIR).as_mean)


def test_rows_are_taken_straight_from_the_scored_reads(spark):
    """No rescue and no table of all rows behind what asks for winners or profiles."""
    v = catalogue.Views(spark, DIR)
    assert v.groups and v.genotyping and "assigned" not in vars(v)
    for df in (v.winners, v.post):
        assert "rlike" not in _plan(df).lower() and _plan(df).count("LeftOuter") in (2, 4)  # tail probabilities alone
    assert "genomes" not in _plan(catalogue.R.contamination_rate(v.winner_counts, v.as_mean))
