"""Summaries by barcode, pool, plate and sample."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from poolspark.functions import twosample
from poolspark.plans.ordered import group_quantiles, quantiles, running_sums
from poolspark.plans.shared import materialize


def winner_reads(rows: DataFrame, xa_max: int = 2) -> DataFrame:
    """(BC, Read, Genome, as_) of winner rows with at most ``xa_max`` other hits, genomes in upper case.

    A missing count of other hits is none; a bound below 0, or a table without that column, is no bound.
    """
    own = rows.where("assigned_class = 'winner'") if "assigned_class" in rows.columns else rows
    if xa_max >= 0 and "XAcount" in own.columns:
        own = own.where(F.coalesce("XAcount", F.lit(0)) <= xa_max)
    return own.select("BC", "Read", F.upper("Genome").alias("Genome"), "as_")


def genome_counts(winners: DataFrame) -> DataFrame:
    """(BC, Genome, score, n_read, n): what means and rates need of the rows BC, Read, Genome, as_; a few rows for each barcode."""
    return winners.groupBy("BC", "Genome").agg(F.sum("as_").alias("score"), F.count("Read").alias("n_read"), F.count("*").alias("n"))


def _counted(winners: DataFrame) -> DataFrame:
    return winners if "n_read" in winners.columns else genome_counts(winners)


def as_mean_assign(winners: DataFrame) -> DataFrame:
    """The genome of the highest mean score for each barcode and the gap to the next; rows BC, Read, Genome, as_, or their counts.

    Ties go to the genome of more reads, then by name.  A missing score adds nothing to the sum, its read counts.
    """
    per = _counted(winners).select("BC", "Genome", (F.coalesce("score", F.lit(0)) / F.col("n_read")).alias("as_mean"), "n_read")
    w = Window.partitionBy("BC").orderBy(F.desc_nulls_last("as_mean"), F.desc("n_read"), "Genome")
    ranked = per.withColumn("rk", F.row_number().over(w))
    at = lambda k, c: F.max(F.when(F.col("rk") == k, F.col(c)))
    out = ranked.groupBy("BC").agg(F.sum("n_read").alias("total_n"), at(1, "Genome").alias("assigned_genome"), at(1, "as_mean").alias("top1_as_mean"), at(1, "n_read").alias("top1_n"), at(2, "Genome").alias("second_genome"), at(2, "as_mean").alias("top2_as_mean"))
    return out.withColumn("as_gap", F.col("top1_as_mean") - F.col("top2_as_mean"))


def contamination_rate(winners: DataFrame, assigned: DataFrame) -> DataFrame:
    """(BC, assigned_genome, n_reads, n_mismatch, contam_rate); of winner rows or their counts."""
    own = _counted(winners).join(assigned.select("BC", "assigned_genome"), "BC").withColumn("other", F.when(F.col("Genome") != F.col("assigned_genome"), F.col("n")).otherwise(0))
    return own.groupBy("BC", "assigned_genome").agg(F.sum("n").alias("n_reads"), F.sum("other").alias("n_mismatch")).withColumn("contam_rate", F.col("n_mismatch") / F.col("n_reads"))


def pass_barcodes(assigned: DataFrame, pool: list[str]) -> DataFrame:
    """Barcodes whose genome belongs to the pool, whatever its case."""
    return assigned.where(F.upper("assigned_genome").isin([g.upper() for g in pool])).select("BC", "assigned_genome")


def reads_to_discard(winners: DataFrame, assigned: DataFrame) -> DataFrame:
    """Reads whose genome is not their barcode's, of all barcodes, sorted by barcode and read."""
    own = winners.join(assigned.select("BC", "assigned_genome"), "BC").where("Genome <> assigned_genome")
    return own.select("BC", "Read", "Genome", "assigned_genome").orderBy("BC", "Read", "Genome")


def sample_stats(rates: DataFrame, samples: DataFrame | None) -> DataFrame:
    """Barcodes, reads and contamination of each sample; percentiles are exact and interpolated.

    ``samples`` (BC, sample) may be None if ``rates`` has the sample already.
    """
    own = materialize(rates if samples is None else rates.join(samples, "BC"), "sample-rates")
    sums = own.groupBy(F.col("sample").alias("of")).agg(F.count_distinct("BC").alias("n_bc"), F.sum("n_reads").alias("n_reads"), F.avg("contam_rate").alias("mean_contam"))
    ends = group_quantiles(own, "sample", "contam_rate", {"median_contam": 0.5, "p95_contam": 0.95})
    return ends.join(sums, F.col("sample").eqNullSafe(F.col("of"))).select("sample", "n_bc", "n_reads", "mean_contam", "median_contam", "p95_contam")


def wells(plate_map: DataFrame) -> DataFrame:
    """(sample, well) of ranges like ``A1-12,B3``; rows A to H, columns 1 to 12; other texts are errors."""
    part = plate_map.select("sample", F.explode(F.transform(F.split("wells", ","), lambda x: F.trim(x))).alias("r")).where("r <> ''")
    ends = part.select("sample", F.upper(F.regexp_extract("r", "^([A-Ha-h])", 1)).alias("row"), "r", F.regexp_extract("r", "^[A-Ha-h]([0-9]+)", 1).alias("a"), F.regexp_extract("r", "-[A-Ha-h]?([0-9]+)$", 1).alias("b"))
    good = F.col("r").rlike("^[A-Ha-h][0-9]+(-[A-Ha-h]?[0-9]+)?$")
    first, last = F.try_to_number("a", F.lit("99")).cast("int"), F.coalesce(F.try_to_number(F.when(F.col("b") != "", F.col("b")), F.lit("99")).cast("int"), F.try_to_number("a", F.lit("99")).cast("int"))
    fits = good & (first >= 1) & (last <= 12) & (first <= last)
    checked = ends.withColumn("cols", F.when(fits, F.sequence(first, last)).otherwise(F.raise_error(F.concat(F.lit("bad well range "), "r"))))
    return checked.select("sample", "row", F.explode("cols").alias("col")).select("sample", F.concat("row", F.col("col").cast("string")).alias("well"), "row", "col")


def layout_barcodes(layout: DataFrame) -> DataFrame:
    """(well, barcode) of an 8 x 12 matrix whose first column names the row."""
    first, *cols = layout.columns
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return layout.selectExpr(f"`{first}` AS row", f"stack({len(cols)}, {pairs}) AS (col, barcode)").select(F.concat("row", "col").alias("well"), F.col("barcode").cast("string").alias("barcode"))


def design_by_wells(plate_map: DataFrame, layout: DataFrame) -> DataFrame:
    """(bc_key, expected_genome) where the map's samples are genomes."""
    return wells(plate_map).join(layout_barcodes(layout), "well").select(F.translate("barcode", "_:.", "").alias("bc_key"), F.col("sample").alias("expected_genome"))


def plate_grid(stats: DataFrame, plate_map: DataFrame, value: str = "median_contam") -> DataFrame:
    """(row, col, sample, value) of every well of the plate; wells without a sample are null."""
    spark = stats.sparkSession
    grid = spark.createDataFrame([(r, c) for r in "ABCDEFGH" for c in range(1, 13)], "row string, col int")
    own = wells(plate_map).select("row", "col", "sample").join(stats.select("sample", F.col(value).alias("value")), "sample", "left")
    return grid.join(F.broadcast(own), ["row", "col"], "left").select("row", "col", "sample", "value")


def interpool_counts(assigned: DataFrame, samples: DataFrame) -> DataFrame:
    n = assigned.join(samples, "BC").groupBy("sample", "assigned_genome").agg(F.count("*").alias("n_bc"))
    return n.withColumn("frac", F.col("n_bc") / F.sum("n_bc").over(Window.partitionBy("sample")))


def read_composition(winners: DataFrame, samples: DataFrame) -> DataFrame:
    n = winners.join(samples, "BC").groupBy("sample", "Genome").agg(F.count("*").alias("n_reads"))
    return n.withColumn("frac", F.col("n_reads") / F.sum("n_reads").over(Window.partitionBy("sample")))


#: What the barcodes of low and high contamination are compared by.
MEASURES = ("top1_as_mean", "total_n", "as_gap")


def low_high(rates: DataFrame, assigned: DataFrame, q: float = 0.2, threshold: float | None = None) -> DataFrame:
    """(variable, grp, value): the measures of the barcodes of low and of high contamination.

    By shares, low is up to the quantile ``q`` and high from the quantile 1 - q on, so ties may be in both, and barcodes
    without a rate, which count as 0 for the quantiles, in neither; by ``threshold``, low is up to it and high above it.
    A barcode with one genome only has an infinite gap, null here; one without a mean or total has no value at all.
    """
    rate = F.coalesce("contam_rate", F.lit(0.0))
    own = assigned.join(rates.select("BC", "contam_rate"), "BC", "left").withColumn("rate", rate)
    if threshold is None:
        q = min(max(q, 0.0), 0.49)
        own = materialize(own, "rated")
        ends = [F.round(F.lit(v).cast("double"), 9) for v in quantiles(own, "rate", [q, 1 - q])]
        x = F.round("contam_rate", 9)
        low, high = x <= ends[0], x >= ends[1]
    else:
        low, high = F.col("rate") <= threshold, F.col("rate") > threshold
    sides = F.array_compact(F.array(F.when(low, "low"), F.when(high, "high")))
    long = F.array(*[F.struct(F.lit(m).alias("variable"), F.col(m).cast("double").alias("value")) for m in MEASURES])
    out = own.select(F.explode(sides).alias("grp"), long.alias("xs")).select("grp", F.inline("xs"))
    return out.where("value IS NOT NULL OR variable = 'as_gap'").select("variable", "grp", "value")


def _cumulative(values: DataFrame) -> DataFrame:
    """(variable, value, a, b, ca, cb, n1, n2): for each distinct value, how many low and high ones it has and how many are up to it.

    Counts are summed by distinct value; running sums are made by ranges of variable and value, infinite values last.
    """
    n = values.groupBy("variable", "value").agg(F.count_if(F.col("grp") == "low").alias("a"), F.count_if(F.col("grp") == "high").alias("b"))
    placed = n.withColumn("place", F.struct("variable", F.col("value").isNull().alias("end"), "value"))
    ranked = materialize(running_sums(placed, "place", {"sa": F.col("a"), "sb": F.col("b")}).drop("place"), "ranked-values")
    ends = ranked.groupBy("variable").agg(F.min(F.col("sa") - F.col("a")).alias("a0"), F.min(F.col("sb") - F.col("b")).alias("b0"), F.sum("a").alias("n1"), F.sum("b").alias("n2"))
    both = ranked.join(F.broadcast(ends), "variable")  # one row for each measure
    return both.select("variable", "value", "a", "b", (F.col("sa") - F.col("a0")).alias("ca"), (F.col("sb") - F.col("b0")).alias("cb"), "n1", "n2")


def ecdf(values: DataFrame) -> DataFrame:
    """(variable, grp, value, cdf) at the distinct values of each group; a null value is beyond every number."""
    own = _cumulative(values)
    side = lambda grp, n, c, of: own.where(F.col(n) > 0).select("variable", F.lit(grp).alias("grp"), "value", (F.col(c) / F.col(of)).alias("cdf"))
    return side("low", "a", "ca", "n1").unionByName(side("high", "b", "cb", "n2"))


@F.pandas_udf(DoubleType())
def _p_value(n1: pd.Series, n2: pd.Series, gap: pd.Series) -> pd.Series:
    return pd.Series([twosample.p_value(int(a), int(b), int(g)) for a, b, g in zip(n1, n2, gap, strict=True)], dtype="float64")


def ks_statistic(values: DataFrame) -> DataFrame:
    """(variable, n1, n2, d, p): the two-sample Kolmogorov-Smirnov test of the low and the high group for each measure.

    The gap is a whole number, n1 * n2 times the statistic, so that equality with the bound of the exact test is exact.
    d and p are null where a group is empty.
    """
    gap = F.max(F.abs(F.col("ca") * F.col("n2") - F.col("cb") * F.col("n1")))
    own = _cumulative(values).groupBy("variable", "n1", "n2").agg(gap.alias("gap"))  # three rows
    some = (F.col("n1") > 0) & (F.col("n2") > 0)
    tested = own.where(some).withColumn("p", _p_value("n1", "n2", "gap")).withColumn("d", F.col("gap") / F.col("n1") / F.col("n2"))
    none = own.where(~some).withColumns({"p": F.lit(None).cast("double"), "d": F.lit(None).cast("double")})
    return tested.unionByName(none).select("variable", "n1", "n2", "d", "p")


def _spread(x: Column, lo: float, hi: float, n: int) -> Column:
    """Places on a scale of ``n`` steps from lo to hi."""
    return (x - F.lit(lo)) / F.lit((hi - lo) / n)


def _widened(lo: float, hi: float) -> tuple[float, float]:
    """A range of more than one value."""
    if hi - lo > 1e-15 * max(abs(lo), abs(hi)):
        return lo, hi
    return (-0.1, 0.1) if lo == hi == 0 else (lo - 0.1 * abs(lo), hi + 0.1 * abs(hi))


def hexagons(values: DataFrame, x: str, y: str, across: int = 20) -> DataFrame:
    """(x, y, n): the centres of the hexagonal cells that hold any point, and how many; ``across`` cells over the range of ``x``.

    Centres lie on two lattices, one moved by half a cell; a point belongs to the nearer one.
    Points that lack a coordinate or are not finite are left out; a range of one value is widened by a tenth.
    """
    down = int(across / math.sqrt(3))
    at = {"u": F.col(x).cast("double"), "v": F.col(y).cast("double")}
    own = values.select(*[c.alias(n) for n, c in at.items()]).where("abs(u) < double('inf') AND abs(v) < double('inf')")
    ends = own.agg(F.min("u"), F.max("u"), F.min("v"), F.max("v")).first()
    if ends[0] is None:
        return own.select(F.col("u").alias("x"), F.col("v").alias("y"), F.lit(0).cast("long").alias("n"))
    (x0, x1), (y0, y1) = _widened(*ends[:2]), _widened(*ends[2:])
    pad = 1e-9 * (x1 - x0)  # so that no point lies beyond the last cell by rounding
    x0, x1 = x0 - pad, x1 + pad
    placed = own.select(_spread(F.col("u"), x0, x1, across).alias("p"), _spread(F.col("v"), y0, y1, down).alias("q"))
    near = lambda i, j: (F.col("p") - i) * (F.col("p") - i) + 3 * (F.col("q") - j) * (F.col("q") - j)
    even, odd = (F.rint("p"), F.rint("q")), (F.floor("p") + 0.5, F.floor("q") + 0.5)
    first = near(*even) < near(*odd)
    cells = placed.select(F.when(first, even[0]).otherwise(odd[0]).alias("i"), F.when(first, even[1]).otherwise(odd[1]).alias("j"))
    n = cells.groupBy("i", "j").agg(F.count("*").alias("n"))
    return n.select((F.col("i") * F.lit((x1 - x0) / across) + x0).alias("x"), (F.col("j") * F.lit((y1 - y0) / down) + y0).alias("y"), "n")


def densities(values: DataFrame, sample: str, value: str, cells: int = 50) -> DataFrame:
    """(sample, cell, lo, hi, n, density): a histogram of each sample over its own range, of area 1; cells from 0, the last one closed.

    A sample of one value has a range of one around it.  Missing values and such that are not finite are
    left out, and samples without any other.
    """
    own = values.select(F.col(sample).alias("sample"), F.col(value).cast("double").alias("v")).where("abs(v) < double('inf')")
    ends = own.groupBy("sample").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("total"))
    wide = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(0.0)
    ends = materialize(ends.select(F.col("sample").alias("of"), "total", (F.col("lo") - wide).alias("first"), (F.col("hi") + wide).alias("last")), "ranges")
    same = F.col("sample").eqNullSafe(F.col("of"))
    edge = lambda k: F.when(k == cells, F.col("last")).otherwise(F.col("first") + k * ((F.col("last") - F.col("first")) / cells))
    near = F.least(F.floor((F.col("v") - F.col("first")) / (F.col("last") - F.col("first")) * cells), F.lit(cells - 1)).cast("int")
    k = F.col("k")
    exact = F.when(F.col("v") < edge(k), k - 1).when((F.col("v") >= edge(k + 1)) & (k != cells - 1), k + 1).otherwise(k)
    counted = own.join(ends, same).withColumn("k", near).select("sample", exact.alias("cell")).groupBy("sample", "cell").agg(F.count("*").alias("n"))
    every = ends.select("of", "total", "first", "last", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("k"))
    full = every.join(counted, same & (k == F.col("cell")), "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    return full.select(F.col("of").alias("sample"), k.alias("cell"), edge(k).alias("lo"), edge(k + 1).alias("hi"), "n", (F.col("n") / F.col("total") / (edge(k + 1) - edge(k))).alias("density"))


def heat_counts(values: DataFrame, x: str, y: str, nx: int, ny: int, x_range: tuple[float, float] | None = None, y_range: tuple[float, float] | None = None) -> DataFrame:
    """(ix, iy, n): counts on a grid, for density plots; nulls are left out.

    A range that is not given is the data's own; values beyond a given one count in its end cells.
    """
    own = values.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if x_range is None or y_range is None:
        ends = [float(v or 0) for v in own.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()]
        x_range, y_range = x_range or _widened(*ends[:2]), y_range or _widened(*ends[2:])
    cell = lambda c, n, r: F.greatest(F.least(F.floor((F.col(c) - r[0]) * n / (r[1] - r[0])), F.lit(n - 1)), F.lit(0)).cast("int")
    return own.groupBy(cell(x, nx, x_range).alias("ix"), cell(y, ny, y_range).alias("iy")).agg(F.count("*").alias("n"))
