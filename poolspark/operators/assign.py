"""From alignments to the genome of each read."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poolspark.config import AssignConfig
from poolspark.functions import barcode
from poolspark.operators import qc
from poolspark.plans.shared import materialize

READ = ("Read", "BC")
_BEST = lambda: [F.asc_nulls_last("NM"), F.desc_nulls_last("as_"), F.desc_nulls_last("MAPQ")]


def dedup_read_genome(rows: DataFrame) -> DataFrame:
    """The best alignment of each read on each genome: fewest mismatches, then highest score and quality."""
    order = [*_BEST(), F.asc_nulls_last("XAcount"), F.asc_nulls_last("frag_loc")]
    # dealt by read and barcode alone, so that ranking the genomes needs no further shuffle
    return rows.repartition(*READ).withColumn("rn", F.row_number().over(Window.partitionBy(*READ, "Genome").orderBy(*order))).where("rn = 1").drop("rn")


def rank_genomes(best: DataFrame) -> DataFrame:
    """Adds rk (1 is best), rk_worst (1 is worst) and n_genomes to one row for each read and genome."""
    by = Window.partitionBy(*READ)
    worst = by.orderBy(F.desc_nulls_last("NM"), F.asc_nulls_last("as_"), F.asc_nulls_last("MAPQ"), "Genome")
    return best.withColumns({"rk": F.row_number().over(by.orderBy(*_BEST(), "Genome")), "rk_worst": F.row_number().over(worst), "n_genomes": F.count("*").over(by)})


def _place(x, worst: bool = False) -> list[Column]:
    """Sort keys from best to worst, or the reverse, with missing values last."""
    up = lambda n: [x(n).isNull(), x(n)]
    down = lambda n: [x(n).isNull(), -x(n).cast("int")]
    return [*(down if worst else up)("NM"), *(up if worst else down)("as_"), *(up if worst else down)("MAPQ"), x("Genome")]


def by_read(rows: DataFrame) -> DataFrame:
    """One row for each read and barcode: ``genomes``, its best alignment on each genome from best to worst, and best, second and worst in columns.

    One shuffle: a group-by of read, barcode and genome picks the best alignment, and
    one of read and barcode gathers them, which are as many as there are genomes.
    """
    keyed = [k.alias(f"k{i}") for i, k in enumerate([*_place(F.col), F.col("XAcount").isNull(), F.col("XAcount"), F.col("frag_loc").isNull(), F.col("frag_loc")])]
    per = rows.repartition(*READ).groupBy(*READ, "Genome").agg(F.min(F.struct(*keyed, "as_", "MAPQ")).alias("x"))
    own = per.groupBy(*READ).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    item = lambda x: F.struct(x["k6"].alias("Genome"), x["as_"].alias("as_"), x["MAPQ"].alias("MAPQ"), x["k1"].alias("NM"), x["k8"].alias("XAcount"), x["k10"].alias("frag_loc"))
    own = own.select(*READ, F.transform("xs", item).alias("genomes"))
    last = F.array_min(F.transform("genomes", lambda x: F.struct(*[k.alias(f"k{i}") for i, k in enumerate(_place(lambda n: x[n], worst=True))], x["as_"].alias("as_"), x["MAPQ"].alias("MAPQ"), x["NM"].alias("NM"))))
    own = own.withColumn("last", last)
    parts = {"1": F.get("genomes", F.lit(0)), "2": F.get("genomes", F.lit(1))}
    named = (("Genome", "g"), ("as_", "as"), ("MAPQ", "mq"), ("NM", "nm"))
    columns = [x[c].alias(f"{a}{n}") for n, x in parts.items() for c, a in named] + [F.col("last")["k6" if c == "Genome" else c].alias(f"{a}l") for c, a in named]
    return own.select(*READ, *columns, F.size("genomes").cast("long").alias("n_genomes"), "genomes")


def with_deltas(two: DataFrame) -> DataFrame:
    return two.withColumns({"d_as": F.col("as1") - F.col("as2"), "d_mq": F.col("mq1") - F.col("mq2"), "d_nm": F.col("nm2") - F.col("nm1")})


def best_two_delta(two: DataFrame) -> DataFrame:
    """Deltas of the reads that two genomes or more hold."""
    return with_deltas(two.where("g2 is not null"))


def bin_of(x: Column, lo: int, hi: int, bins: int) -> Column:
    return F.floor((x - lo) * bins / (hi - lo)).cast("int")


def winner_hist(winners: DataFrame, config: AssignConfig = AssignConfig()) -> DataFrame:
    """(metric, bin, n) of best alignments; the last bin holds the highest value, values outside are left out."""
    parts = []
    for metric, c, (lo, hi, bins) in (("as", "as1", config.as_bins), ("mapq", "mq1", config.mapq_bins)):
        x = F.col(c)
        parts.append(winners.where((x >= lo) & (x <= hi)).select(F.lit(metric).alias("metric"), F.least(bin_of(x, lo, hi, bins), F.lit(bins - 1)).alias("bin")))
    return parts[0].unionByName(parts[1]).groupBy("metric", "bin").agg(F.count("*").alias("n"))


def decile_edges(hist: DataFrame, config: AssignConfig = AssignConfig()) -> DataFrame:
    """(metric, edge): left edges of the bins where cumulative counts reach i/k of the total."""
    w = Window.partitionBy("metric")
    cum = hist.withColumns({"c": F.sum("n").over(w.orderBy("bin")), "tot": F.sum("n").over(w)})
    spec = {"as": config.as_bins, "mapq": config.mapq_bins}
    marks = cum.withColumn("target", F.explode(F.expr(f"transform(sequence(1, {config.k - 1}), i -> cast(floor(i / {float(config.k)}D * tot) as bigint))")))
    reached = marks.where("c >= target").groupBy("metric", "target").agg(F.min("bin").alias("bin")).withColumn("bin", F.when(F.col("target") == 0, 0).otherwise(F.col("bin")))
    edge = F.lit(None).cast("double")
    for metric, (lo, hi, bins) in spec.items():
        edge = F.when(F.col("metric") == metric, lo + F.col("bin") * F.lit(float(hi - lo)) / bins).otherwise(edge)
    return reached.select("metric", edge.alias("edge")).distinct()


def collect_edges(edges: DataFrame) -> dict[str, list[float]]:
    """At most k - 1 numbers for each metric."""
    out: dict[str, list[float]] = {"as": [], "mapq": []}
    for r in edges.collect():
        out[r["metric"]].append(r["edge"])
    return {m: sorted(v) for m, v in out.items()}


def edges_table(spark: SparkSession, edges: dict[str, list[float]]) -> DataFrame:
    return spark.createDataFrame([(m, e) for m, es in sorted(edges.items()) for e in es], "metric string, edge double")


def decile(x: Column, edges: list[float], k: int) -> Column:
    """1 + the number of edges below x, at most k; k where x is null."""
    below = sum((F.when(x > e, 1).otherwise(0) for e in edges), F.lit(1))
    return F.when(x.isNull(), k).otherwise(F.least(below, F.lit(k))).cast("int")


def delta_specs(config: AssignConfig):
    return (("as", "as1", "d_as", config.delta_as_bins), ("mapq", "mq1", "d_mq", config.delta_mapq_bins))


def delta_hist(deltas: DataFrame, edges: dict[str, list[float]], config: AssignConfig = AssignConfig()) -> DataFrame:
    """(metric, decile, bin, n); the bin after the last holds what reaches the upper bound, negative deltas are left out."""
    parts = []
    for metric, c, d, (lo, hi, bins) in delta_specs(config):
        x = F.col(d)
        parts.append(deltas.where(x >= lo).select(F.lit(metric).alias("metric"), decile(F.col(c), edges[metric], config.k).alias("decile"), F.least(bin_of(x, lo, hi, bins), F.lit(bins)).alias("bin")))
    return parts[0].unionByName(parts[1]).groupBy("metric", "decile", "bin").agg(F.count("*").alias("n"))


def tail_prob(hist: DataFrame, config: AssignConfig = AssignConfig()) -> DataFrame:
    """(metric, decile, bin, p): share of deltas in this bin or above, for every bin of each decile that has any.

    The table has k * (bins + 1) rows for each metric at most.
    """
    size = {m: bins for m, _, _, (_, _, bins) in delta_specs(config)}
    most = F.when(F.col("metric") == "as", size["as"]).otherwise(size["mapq"])
    dense = hist.groupBy("metric", "decile").agg(F.sum("n").alias("tot")).withColumn("bin", F.explode(F.sequence(F.lit(0), most)))
    down = Window.partitionBy("metric", "decile").orderBy(F.desc("bin"))
    full = dense.join(hist, ["metric", "decile", "bin"], "left").withColumn("above", F.sum(F.coalesce("n", F.lit(0))).over(down))
    return full.select("metric", "decile", "bin", (F.col("above") / F.col("tot")).alias("p"))


def assign_raw(two: DataFrame, edges: dict[str, list[float]], tails: DataFrame, config: AssignConfig = AssignConfig()) -> DataFrame:
    """One row for each read: deltas, deciles, tail probabilities and the class winner or ambiguous."""
    out = with_deltas(two)
    for metric, c, d, (lo, hi, bins) in delta_specs(config):
        out = out.withColumn(f"decile_{metric}", decile(F.col(c), edges[metric], config.k))
        out = out.withColumn("bin", F.least(bin_of(F.greatest(F.col(d), F.lit(lo)), lo, hi, bins), F.lit(bins))).withColumn("bin", F.when(F.col(d).isNotNull(), F.col("bin")))
        own = tails.where(F.col("metric") == metric).select(F.col("decile").alias(f"decile_{metric}"), "bin", F.col("p").alias({"as": "p_as", "mapq": "p_mq"}[metric]))
        out = out.join(F.broadcast(own), [f"decile_{metric}", "bin"], "left").drop("bin")
    sure = (F.coalesce(F.col("p_as") <= config.alpha, F.lit(False))) | F.coalesce(F.col("p_mq") <= config.alpha, F.lit(False)) | F.coalesce(F.col("d_nm") > 0, F.lit(False)) | F.col("as2").isNull()
    return out.withColumn("assigned_class", F.when(sure, "winner").otherwise("ambiguous"))


def assign_filtered(raw: DataFrame, *more: str) -> DataFrame:
    """Winners' best row and all genome rows of ambiguous reads, with the read's probabilities; ``raw`` with its ``genomes``.

    Columns of ``more`` are kept as they are.
    """
    rows = F.when(F.col("assigned_class") == "ambiguous", F.col("genomes")).otherwise(F.slice("genomes", 1, 1))
    own = raw.select(*READ, "assigned_class", "p_as", "p_mq", F.explode(rows).alias("x"), *more)
    return own.select(*READ, "x.Genome", "x.as_", "x.MAPQ", "x.NM", "x.XAcount", "assigned_class", "p_as", "p_mq", "x.frag_loc", *more)


def friend_rescue(rows: DataFrame, window: int = 500) -> DataFrame:
    """Ambiguous rows become ``rescued`` if a winner of the same barcode, genome and sequence ends within ``window``.

    A band semi-join by cells of ``window`` positions.  A winner in the cell of an
    endpoint is near enough; of the cell before only the highest can be, of the
    one behind only the lowest.  So winners are reduced to these three values for
    each cell, and each endpoint of an ambiguous row meets at most one row.
    """
    keys = ["BC", "Genome", "chr"]
    f = barcode.fragment(F.col("frag_loc"))
    cell = lambda pos: F.floor(pos / window)
    ends = rows.where("assigned_class = 'winner'").select("BC", "Genome", f.alias("f")).select("BC", "Genome", "f.chr", F.explode(F.array("f.pos1", "f.pos2")).alias("pos")).where("chr is not null and pos is not null")
    spans = ends.groupBy(*keys, cell(F.col("pos")).alias("cell")).agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    near = spans.select(*keys, F.explode(F.array(*[F.struct((F.col("cell") + d).alias("cell"), F.lit(d).alias("d")) for d in (-1, 0, 1)])).alias("to"), "lo", "hi")
    at = lambda d, f, c: f(F.when(F.col("to.d") == d, F.col(c)))
    # seen from a cell, the winners of the cell before it are moved by one, those of the cell behind it by minus one
    cells = near.groupBy(*keys, "to.cell").agg(at(0, F.count, "lo").alias("own"), at(1, F.max, "hi").alias("before"), at(-1, F.min, "lo").alias("behind"))
    asked = rows.where("assigned_class = 'ambiguous'").withColumn("__f", f)
    for k in ("pos1", "pos2"):
        side = cells.select(*[F.col(c).alias(f"__{c}") for c in (*keys, "cell", "own", "before", "behind")])
        pos = F.col(f"__f.{k}")
        on = (F.col("BC") == F.col("__BC")) & (F.col("Genome") == F.col("__Genome")) & (F.col("__f.chr") == F.col("__chr")) & (cell(pos) == F.col("__cell"))
        hit = (F.col("__own") > 0) | (pos - F.col("__before") <= window) | (F.col("__behind") - pos <= window)
        asked = asked.join(side, on, "left").withColumn(f"__{k}", F.coalesce(hit, F.lit(False))).drop(*side.columns)
    marked = asked.withColumn("assigned_class", F.when(F.col("__pos1") | F.col("__pos2"), "rescued").otherwise("ambiguous"))
    return rows.where("assigned_class is null or assigned_class <> 'ambiguous'").select(rows.columns).unionByName(marked.select(rows.columns))


def assign_stats(raw: DataFrame, chunks: DataFrame) -> DataFrame:
    """Counts for each chunk of barcodes."""
    amb = F.col("assigned_class") == "ambiguous"
    return raw.join(chunks, "BC").groupBy("chunk_id").agg(
        F.count("*").alias("n_reads"), F.count_if(~amb).alias("n_winner"), F.count_if(amb).alias("n_ambiguous"), F.count_distinct(F.when(amb, F.col("BC"))).alias("n_ambiguous_bcs")
    )


class Assignment:
    """The assign stage over a table of alignments: models first, then every read."""

    def __init__(self, rows: DataFrame, config: AssignConfig = AssignConfig(), model: tuple[DataFrame, DataFrame] | None = None):
        """``model``: edges and tails that are given instead of learned."""
        self.config, self._model = config, model
        self.filtered = qc.cap_rows(qc.alignment_filter(rows, config.mapq_min, config.xa_max), config.max_rows_per_genome)

    @cached_property
    def reads(self) -> DataFrame:
        """Written once: the models and the scoring all read it, and none of them shuffles it again."""
        return materialize(by_read(self.filtered), "reads")

    @cached_property
    def two(self) -> DataFrame:
        """Best, second and worst genome of each read."""
        return self.reads.drop("genomes")

    def _sampled(self) -> DataFrame:
        """Reads of the barcodes that models are learned from."""
        n = self.config.sample_barcodes
        barcodes = self.filtered.select("BC").distinct()
        if not n or barcodes.count() <= n:
            return self.two
        return qc.semi_barcodes(self.two, qc.sample_barcodes(barcodes, n, self.config.seed))

    def hist(self) -> DataFrame:
        return winner_hist(self._sampled(), self.config)

    @cached_property
    def _edges(self) -> dict[str, list[float]]:
        return collect_edges(self._model[0] if self._model else decile_edges(self.hist(), self.config))

    def edges(self) -> dict[str, list[float]]:
        return self._edges

    def deltas(self, edges: dict[str, list[float]]) -> DataFrame:
        return delta_hist(best_two_delta(self._sampled()), edges, self.config)

    @cached_property
    def tails(self) -> DataFrame:
        """Written once: a few thousand rows."""
        if self._model:
            return self._model[1]
        return materialize(tail_prob(self.deltas(self.edges()), self.config), "tails")

    def raw(self) -> DataFrame:
        """One row for each read with its class, and its ``genomes``."""
        return assign_raw(self.reads, self.edges(), self.tails, self.config)

    def result(self, chunks: DataFrame | None = None) -> DataFrame:
        """Winner, ambiguous and rescued rows; with ``chunks`` (BC) only of their barcodes, by models of all."""
        raw = self.raw() if chunks is None else qc.semi_barcodes(self.raw(), chunks)
        return friend_rescue(assign_filtered(raw), self.config.rescue_window)
