"""Running sums over a whole ordered table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poolspark.plans.shared import materialize

#: Rows of some tens of bytes that a single task may sort.
ONE_TASK = 500_000


def running_sums(rows: DataFrame, order: str, sums: dict[str, Column]) -> DataFrame:
    """``rows`` with each of ``sums`` added up over all rows up to this one in ``order``; equal rows share a sum.

    Up to ``ONE_TASK`` rows are summed in one task.  More are dealt out by ranges of ``order`` and written, so the ranges stay what
    they are; each range is summed by itself, and only one row for each range
    meets the others to give what lies before it.
    """
    rows = materialize(rows, "unordered")
    if rows.count() <= ONE_TASK:
        return rows.withColumns({n: F.sum(c).over(Window.orderBy(order)) for n, c in sums.items()})
    own = materialize(rows.repartitionByRange(order).withColumn("__part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("__part").orderBy(order)
    local = own.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()})
    totals = own.groupBy("__part").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("__part", *[F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__{n}") for n in sums])
    both = local.join(F.broadcast(before), "__part")
    return both.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop("__part", *[f"__{n}" for n in sums])


def quantiles(rows: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """Exact quantiles with linear interpolation, as numbers; None of an empty column.

    Values are counted by distinct value; up to ``ONE_TASK`` of them are aggregated
    at once, more are ranked by ranges.
    """
    n = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    n = materialize(n, "values")
    if n.count() <= ONE_TASK:
        own = n.agg(F.percentile("value", F.array(*[F.lit(float(q)) for q in shares]), F.col("n")).alias("q")).first()["q"]
        return list(own) if own is not None else [None] * len(shares)
    ranked = materialize(running_sums(n, "value", {"cum": F.col("n")}), "ranks")
    total = ranked.agg(F.max("cum")).first()[0]
    if not total:
        return [None] * len(shares)
    places = [q * (total - 1) for q in shares]
    at = lambda k: F.min(F.when(F.col("cum") > int(k), F.col("value")))
    got = ranked.agg(*[at(p).alias(f"lo{i}") for i, p in enumerate(places)], *[at(-(-p // 1)).alias(f"hi{i}") for i, p in enumerate(places)]).first()
    return [got[f"lo{i}"] + (p - int(p)) * (got[f"hi{i}"] - got[f"lo{i}"]) for i, p in enumerate(places)]


def group_quantiles(rows: DataFrame, group: str, column: str, shares: dict[str, float]) -> DataFrame:
    """(group, one column for each of ``shares``): exact quantiles of each group with linear interpolation; null of a group without values.

    Values are counted by group and distinct value first.  Up to ``ONE_TASK`` of these
    counts are aggregated group by group; more are ranked by ranges of group and
    value, so that no task holds all values of a large group.
    """
    n = rows.groupBy(F.col(group), F.col(column).alias("value")).agg(F.count("*").alias("n"))
    n = materialize(n, "group-values")
    groups = n.select(group).distinct()
    n = n.where("value IS NOT NULL")
    if n.count() <= ONE_TASK:
        got = n.groupBy(group).agg(F.percentile("value", F.array(*[F.lit(float(q)) for q in shares.values()]), F.col("n")).alias("q"))
        own = got.select(F.col(group).alias("of"), *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(shares)])
        return groups.join(own, F.col(group).eqNullSafe(F.col("of")), "left").drop("of")
    placed = n.withColumn("place", F.struct(group, "value"))
    ranked = materialize(running_sums(placed, "place", {"cum": F.col("n")}).drop("place"), "group-ranks")
    ends = ranked.groupBy(F.col(group).alias("of")).agg(F.min(F.col("cum") - F.col("n")).alias("base"), F.sum("n").alias("total"))
    both = ranked.join(ends, F.col(group).eqNullSafe(F.col("of"))).withColumn("at", F.col("cum") - F.col("base"))
    place = lambda q: F.lit(float(q)) * (F.col("total") - 1)
    first = lambda k: F.min(F.when(F.col("at") > k, F.col("value")))
    got = both.groupBy("of", "total").agg(*[first(end(place(q))).alias(f"{side}_{name}") for name, q in shares.items() for side, end in (("lo", F.floor), ("hi", F.ceil))])
    part = lambda q: place(q) - F.floor(place(q))
    own = got.select("of", *[(F.col(f"lo_{name}") + part(q) * (F.col(f"hi_{name}") - F.col(f"lo_{name}"))).alias(name) for name, q in shares.items()])
    return groups.join(own, F.col(group).eqNullSafe(F.col("of")), "left").drop("of")
