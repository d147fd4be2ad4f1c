"""Group comparison, hexagonal cells and densities against plain versions."""

import itertools
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from poolspark.functions import twosample
from poolspark.operators import reports


def paths(n1, n2, gap):
    """The share of all orders of n1 and n2 steps that leave the band."""
    out = total = 0
    for left in itertools.combinations(range(n1 + n2), n1):
        i = j = 0
        hit = gap <= 0
        for k in range(n1 + n2):
            i, j = (i + 1, j) if k in left else (i, j + 1)
            hit |= abs(i * n2 - j * n1) >= gap
        out, total = out + hit, total + 1
    return Fraction(out, total)


@pytest.mark.parametrize(("n1", "n2"), [(1, 1), (1, 5), (4, 4), (3, 5), (6, 4), (5, 7)])
def test_exact_probability(n1, n2):
    for gap in range(n1 * n2 + 1):
        assert twosample.exact(n1, n2, gap) == pytest.approx(float(paths(n1, n2, gap)), abs=1e-14)


def test_known_probabilities():
    # published: two samples of 5, 10 and 20 that do not overlap
    for n, p in ((5, 0.007936507936507936), (10, 1.0825088224469026e-05), (20, 1.4508889103849681e-11)):
        assert twosample.p_value(n, n, n * n) == pytest.approx(2 / math.comb(2 * n, n)) == pytest.approx(p, rel=1e-9)


def test_the_series_continues_the_exact_test():
    n, d = 10_000, 0.02
    assert twosample.series(d, n / 2) == pytest.approx(twosample.exact(n, n, round(d * n) * n), rel=0.02)
    assert twosample.p_value(20_000, 20_000, 0) == 1.0
    assert twosample.p_value(20_000, 15_000, 20_000 * 15_000) == pytest.approx(0, abs=1e-300)


ASSIGNED = "BC string, top1_as_mean double, total_n long, as_gap double"
RATES = "BC string, contam_rate double"


def compared(spark, rows, **options):
    assigned = spark.createDataFrame([(f"b{i}", m, n, g) for i, (m, n, g, _) in enumerate(rows)], ASSIGNED)
    rates = spark.createDataFrame([(f"b{i}", r) for i, (*_, r) in enumerate(rows) if r != "none"], RATES)
    return reports.low_high(rates, assigned, **options)


def sides(rows, q=0.2, threshold=None):
    """{variable: (low values, high values)} as the groups are defined."""
    rate = np.array([0.0 if r in (None, "none") else r for *_, r in rows])
    known = np.array([r not in (None, "none") for *_, r in rows])
    if threshold is None:
        low, high = known & (rate <= np.quantile(rate, q)), known & (rate >= np.quantile(rate, 1 - q))
    else:
        low, high = rate <= threshold, rate > threshold
    own = {"top1_as_mean": [m for m, *_ in rows], "total_n": [n for _, n, *_ in rows], "as_gap": [math.inf if g is None else g for _, _, g, _ in rows]}
    return {v: tuple([x for x, k in zip(xs, side, strict=True) if k and x is not None] for side in (low, high)) for v, xs in own.items()}


@pytest.mark.parametrize("threshold", [None, 0.25])
def test_groups_are_compared_by_their_measures(spark, threshold):
    rng = random.Random(3)
    rows = [(rng.choice([40.0, 55.5, 60.25, 80.0]), rng.randrange(1, 9), rng.choice([None, 0.5, 3.0, 7.25]), rng.choice([0.0, 0.1, 0.25, 0.25, 0.5, None, "none"])) for _ in range(60)]
    groups = compared(spark, rows, threshold=threshold)
    got = {r["variable"]: r for r in reports.ks_statistic(groups).collect()}
    steps = {(r["variable"], r["grp"], math.inf if r["value"] is None else r["value"]): r["cdf"] for r in reports.ecdf(groups).collect()}
    n = 0
    for variable, (low, high) in sides(rows, threshold=threshold).items():
        at = sorted({*low, *high})
        share = lambda xs, v: sum(x <= v for x in xs) / len(xs)
        d = max(abs(share(low, v) - share(high, v)) for v in at)
        own = got[variable]
        assert (own["n1"], own["n2"]) == (len(low), len(high)) and own["d"] == pytest.approx(d)
        assert own["p"] == pytest.approx(twosample.exact(len(low), len(high), round(d * len(low) * len(high))))
        for grp, xs in (("low", low), ("high", high)):
            for v in set(xs):
                assert steps[variable, grp, v] == pytest.approx(share(xs, v))
                n += 1
    assert n == len(steps)


def test_an_empty_group_has_no_test(spark):
    groups = compared(spark, [(50.0, 3, 1.0, 0.1), (60.0, 4, None, 0.2)], threshold=0.5)
    assert [(r["n1"], r["n2"], r["d"], r["p"]) for r in reports.ks_statistic(groups).collect()] == [(2, 0, None, None)] * 3
    assert reports.ks_statistic(compared(spark, [])).collect() == []
    assert {r["grp"] for r in reports.ecdf(groups).collect()} == {"low"}


def test_ties_are_in_both_shares_but_not_beyond_a_threshold(spark):
    rows = [(50.0, 3, 1.0, 0.25)] * 5
    assert {r["grp"] for r in compared(spark, rows).collect()} == {"low", "high"}
    assert {r["grp"] for r in compared(spark, rows, threshold=0.25).collect()} == {"low"}


def hexagons(points, across=20):
    """Every point given to the nearest centre of the two lattices, by trying all of them."""
    down = int(across / math.sqrt(3))
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    x0, x1, y0, y1 = min(xs), max(xs), min(ys), max(ys)
    x0, x1 = x0 - 1e-9 * (x1 - x0), x1 + 1e-9 * (x1 - x0)
    sx, sy = (x1 - x0) / across, (y1 - y0) / down
    centres = [(i, j) for i in range(across + 1) for j in range(down + 1)] + [(i + 0.5, j + 0.5) for i in range(across) for j in range(down)]
    out = {}
    for x, y in points:
        p, q = (x - x0) / sx, (y - y0) / sy
        i, j = min(centres, key=lambda c: (p - c[0]) ** 2 + 3 * (q - c[1]) ** 2)
        key = (round(i * sx + x0, 6), round(j * sy + y0, 6))
        out[key] = out.get(key, 0) + 1
    return out


def test_hexagons_take_the_nearest_centre(spark):
    rng = random.Random(1)
    points = [(rng.gauss(10, 4), rng.random()) for _ in range(700)]
    df = spark.createDataFrame([*points, (None, 0.5), (1.0, None), (float("nan"), 0.1), (float("inf"), 0.1)], "a double, b double")
    got = {(round(r["x"], 6), round(r["y"], 6)): r["n"] for r in reports.hexagons(df, "a", "b").collect()}
    assert got == hexagons(points)


def test_hexagons_of_one_value_or_none(spark):
    one = spark.createDataFrame([(3.0, 0.0)] * 4, "a double, b double")
    (cell,) = reports.hexagons(one, "a", "b").collect()
    assert cell["n"] == 4 and cell["x"] == pytest.approx(3.0, abs=0.02) and cell["y"] == pytest.approx(0.0, abs=0.02)
    assert reports.hexagons(one.where("false"), "a", "b").collect() == []


def test_densities_have_area_one(spark):
    rng = random.Random(2)
    values = {"a": [rng.random() for _ in range(300)], "b": [0.25] * 7, "c": [0.0, 1.0], None: [0.1, 0.2, 0.3], "d": [k / 50 for k in range(51)]}
    df = spark.createDataFrame([(s, v) for s, vs in values.items() for v in vs] + [("a", None), ("none", None), ("c", float("nan"))], "s string, v double")
    got = {}
    for r in reports.densities(df, "s", "v").collect():
        got.setdefault(r["sample"], []).append((r["cell"], r["n"], r["density"], r["lo"], r["hi"]))
    assert set(got) == set(values)
    for s, vs in values.items():
        own = sorted(got[s])
        n, edges = np.histogram(vs, 50)
        assert [r[1] for r in own] == n.tolist()
        assert [r[3] for r in own] == pytest.approx(edges[:-1].tolist()) and sum(r[2] * (r[4] - r[3]) for r in own) == pytest.approx(1)


def test_means_and_rates_come_from_counts(spark):
    rows = [("b", "r1", "A", 9), ("b", None, "A", 5), ("b", "r2", "B", None), ("b", "r3", None, 4), ("c", "r4", "B", 7), ("c", "r5", "A", 8), ("c", "r6", "A", 6), (None, "r7", "A", 6)]
    winners = spark.createDataFrame(rows, "BC string, Read string, Genome string, as_ int")
    counts = reports.genome_counts(winners)
    want, got = reports.as_mean_assign(winners), reports.as_mean_assign(counts)
    plain = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert plain(got) == plain(want)
    rates = reports.contamination_rate(counts, got)
    assert plain(rates) == plain(reports.contamination_rate(winners, want)) == [("b", "A", 4, 1, 0.25), ("c", "A", 3, 1, 1 / 3)]
