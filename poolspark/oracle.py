"""SQL of the registered queries: named steps, put together as common table expressions."""

from __future__ import annotations

import re

from poolspark import testkit
from poolspark.operators.decontam import BINS

_NAMES = {"lineitem": "lineitem", "orders": "orders", "customer": "customer", "nation": "nation"}
_NULLS = "NM {0} NULLS LAST, as_ {1} NULLS LAST, MAPQ {1} NULLS LAST"
BEST, WORST = _NULLS.format("ASC", "DESC"), _NULLS.format("DESC", "ASC")


def _values(rows, names: str) -> str:
    lit = lambda x: "NULL" if x is None else str(x) if isinstance(x, int | float) else f"'{x}'"
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + f") t({names})"


def _decile(x: str, metric: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 10 ELSE CAST(least(10, 1 + (SELECT count(*) FROM edges e WHERE e.metric = '{metric}' AND e.edge < {x})) AS INTEGER) END"


def _tail(d: str, hi: int, bins: int) -> str:
    return f"CASE WHEN {d} IS NULL THEN NULL ELSE CAST(least(floor(greatest({d}, 0) * {bins} / {hi}.0), {bins}) AS INTEGER) END"


def _jsd(mass: str, eta: str) -> str:
    return f"""SELECT barcode, (sum(p * ln(p / m)) / 2 + sum(q * ln(q / m)) / 2) / 0.6931471805599453::DOUBLE AS jsd FROM (
        SELECT *, (p + q) / 2 AS m FROM (SELECT b.barcode, e.genome,
            greatest(coalesce(x.c, 0) / (b.t + 1e-12::DOUBLE), 1e-12::DOUBLE) AS p,
            greatest(e.eta / ((SELECT sum(eta) FROM {eta}) + 1e-12::DOUBLE), 1e-12::DOUBLE) AS q
          FROM (SELECT barcode, sum(c) AS t FROM {mass} GROUP BY barcode) b CROSS JOIN {eta} e LEFT JOIN {mass} x ON x.barcode = b.barcode AND x.genome = e.genome)) GROUP BY barcode"""


def _eta(seed: str) -> str:
    return f"""SELECT genome, r / sum(r) OVER () AS eta FROM (SELECT g.genome, coalesce(s.c, 0) + 1e-12::DOUBLE AS r FROM genomes g
        LEFT JOIN (SELECT genome, sum(c) AS c FROM mass WHERE barcode IN (SELECT barcode FROM {seed}) GROUP BY genome) s ON s.genome = g.genome)"""


def _seed(eta_jsd: str) -> str:
    return f"""SELECT barcode, j FROM (SELECT *, round(quantile_cont(j, 0.95) OVER (), 9) AS tau FROM (SELECT barcode, round(jsd, 9) AS j FROM {eta_jsd} WHERE barcode IN (SELECT barcode FROM cand))) WHERE j <= tau"""


def _allowed(variant: str, calls: str, design: bool, strict: bool, ambiguous: str, weak: str) -> str:
    """The decision table with doublet and indistinguishable on top12."""
    t = lambda c: f"CASE WHEN lower(trim(coalesce({c}, ''))) IN ('nan', 'none') THEN '' ELSE trim(coalesce({c}, '')) END"
    s = lambda *xs: f"list_sort(list_distinct(list_filter([{', '.join(xs)}], lambda x: x <> '')))"
    none, pair, one, own = "[]::VARCHAR[]", s("g1", "g2"), s("g1"), s("e")
    listed = "list_sort(list_distinct(list_filter(list_transform(string_split(i, ','), lambda x: trim(x)), lambda x: x <> '')))"
    either = lambda a, b: f"CASE WHEN len({a}) > 0 THEN {a} ELSE {b} END"
    empty, amb, dbl = "(c = 'empty' OR m = 'empty')", "starts_with(c, 'ambiguous')", "(m = 'doublet' OR c IN ('doublet_confident', 'ambiguous_weak_doublet'))"
    sgl, wk, ind = "(m = 'single' OR c IN ('single_clean', 'ambiguous_dirty_singlet'))", "c = 'weak_doublet'", "c = 'indistinguishable'"
    cases = [(empty, none, "call_empty")]
    if design:
        if strict:
            cases.insert(0, ("e = ''", none, "unknown_in_design_strict"))
        cases.append(("e = ''", *({"top12_rescue": (pair, "unknown_expected_top12_rescue")}.get(ambiguous, (none, "unknown_expected_drop")))))
        cases += [(dbl, either(pair, own), "doublet_top12"), (ind, either(listed, either(pair, own)), "indist_top12")]
        cases += [(wk, *((own, "weak_doublet_expected_only") if weak == "top1" else (either(pair, own), "weak_doublet_top12"))), ("true", own, "design_expected_only")]
        flags = f"""concat_ws(';', CASE WHEN {empty} AND {"e <> ''" if strict else "true"} THEN 'empty' END, CASE WHEN e = '' AND ({str(strict).lower()} OR NOT {empty}) THEN 'unknown_in_design' END,
            CASE WHEN e <> '' AND NOT {empty} AND e = g2 AND e <> g1 THEN 'expected_is_top2' END, CASE WHEN e <> '' AND NOT {empty} AND e <> g1 AND e <> g2 AND NOT list_contains({listed}, e) THEN 'design_mismatch' END)"""
    else:
        cases.append((amb, *{"top12_rescue": (pair, "ambiguous_top12_rescue")}.get(ambiguous, (none, "ambiguous_no_design_drop"))))
        cases += [(dbl, pair, "doublet_top12"), (ind, either(listed, pair), "indist_top12"), (sgl, one, "single_top1")]
        cases += [(wk, *((one, "weak_doublet_top1") if weak == "top1" else (pair, "weak_doublet_top12"))), ("true", none, "unknown_call_drop")]
        flags = f"CASE WHEN {empty} THEN 'empty' ELSE '' END"
    allowed = "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v, _ in cases) + " END"
    reason = "CASE " + " ".join(f"WHEN {c} THEN '{w}'" for c, _, w in cases) + " END"
    expected = "d.expected_genome" if design else "NULL"
    join = "LEFT JOIN design d ON d.bc_key = split_part(k.barcode, '-', 1)" if design else ""
    return f"""SELECT '{variant}' AS variant, *, CASE WHEN len(allowed) > 0 THEN 'keep_cleaned' ELSE 'drop_barcode' END AS action FROM (
        SELECT barcode, bc_key, call, model, genome_1, genome_2, nullif(e, '') AS expected_genome, {allowed} AS allowed, {reason} AS reason, {flags} AS flags FROM (
        SELECT k.barcode, split_part(k.barcode, '-', 1) AS bc_key, k.call, k.model, k.genome_1, k.genome_2, {t('k.call')} AS c, {t('k.model')} AS m, {t('k.genome_1')} AS g1, {t('k.genome_2')} AS g2,
            {t('k.indist_set')} AS i, {t(expected)} AS e FROM {calls} k {join}))"""


def _by_mean(reads: str) -> str:
    """The genome of the highest mean score of each barcode, then of more reads, then by name."""
    return f"""SELECT BC, CAST(sum(n_read) AS BIGINT) AS total_n, max(Genome) FILTER (WHERE rk = 1) AS assigned_genome, max(as_mean) FILTER (WHERE rk = 1) AS top1_as_mean, max(n_read) FILTER (WHERE rk = 1) AS top1_n,
        max(Genome) FILTER (WHERE rk = 2) AS second_genome, max(as_mean) FILTER (WHERE rk = 2) AS top2_as_mean FROM (SELECT *, row_number() OVER (PARTITION BY BC ORDER BY as_mean DESC, n_read DESC, Genome) AS rk FROM (
        SELECT BC, Genome, coalesce(sum(as_), 0) / CAST(count(Read) AS DOUBLE) AS as_mean, count(Read) AS n_read FROM {reads} GROUP BY ALL)) GROUP BY BC"""


def _bic(ll: str, params: int, n: str = "n_reads") -> str:
    return f"round(-2 * {ll} + {params} * ln(greatest({n}, 1)), 9)"


_S1 = "(1 - i * 0.02::DOUBLE) * CASE WHEN s.genome = t.genome THEN s.l ELSE 0 END + i * 0.02::DOUBLE * s.e"
_RHO = "(0.1::DOUBLE + j * 0.05::DOUBLE)"
_S2 = f"(1 - i * 0.02::DOUBLE) * ({_RHO} * CASE WHEN s.genome = a.genome THEN s.l ELSE 0 END + (1 - {_RHO}) * CASE WHEN s.genome = b.genome THEN s.l ELSE 0 END) + i * 0.02::DOUBLE * s.e"

STEPS: dict[str, str] = {
    "qc": testkit.QC_SQL.format(**_NAMES),
    "design": testkit.DESIGN_SQL.format(**_NAMES),
    "samples": testkit.SAMPLES_SQL.format(**_NAMES),
    "filt": "SELECT * FROM qc WHERE MAPQ >= 20 AND XAcount <= 2",
    "best": f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY Read, BC, Genome ORDER BY {BEST}, XAcount, frag_loc) AS rn FROM filt) WHERE rn = 1",
    "ranked": f"""SELECT *, CAST(row_number() OVER (PARTITION BY Read, BC ORDER BY {BEST}, Genome) AS INTEGER) AS rk,
        CAST(row_number() OVER (PARTITION BY Read, BC ORDER BY {WORST}, Genome) AS INTEGER) AS rk_worst, count(*) OVER (PARTITION BY Read, BC) AS n_genomes FROM best""",
    "two": "SELECT Read, BC, " + ", ".join(f"max({c}) FILTER (WHERE {w}) AS {a}{n}" for n, w in (("1", "rk = 1"), ("2", "rk = 2"), ("l", "rk_worst = 1")) for c, a in (("Genome", "g"), ("as_", "as"), ("MAPQ", "mq"), ("NM", "nm"))) + ", max(n_genomes) AS n_genomes FROM ranked GROUP BY Read, BC",
    "hist": """SELECT 'as' AS metric, CAST(least(floor(as1 * 2000 / 200.0), 1999) AS INTEGER) AS bin, count(*) AS n FROM two WHERE as1 BETWEEN 0 AND 200 GROUP BY ALL
        UNION ALL SELECT 'mapq', CAST(least(floor(mq1 * 120 / 60.0), 119) AS INTEGER), count(*) FROM two WHERE mq1 BETWEEN 0 AND 60 GROUP BY ALL""",
    "edges": """SELECT DISTINCT metric, CASE metric WHEN 'as' THEN bin * 200::DOUBLE / 2000 ELSE bin * 60::DOUBLE / 120 END AS edge FROM (
        SELECT metric, target, CASE WHEN target = 0 THEN 0 ELSE min(bin) END AS bin FROM (
          SELECT c.*, CAST(floor(CAST(i AS DOUBLE) / 10 * tot) AS BIGINT) AS target FROM (
            SELECT metric, bin, CAST(sum(n) OVER (PARTITION BY metric ORDER BY bin) AS BIGINT) AS c, CAST(sum(n) OVER (PARTITION BY metric) AS BIGINT) AS tot FROM hist) c, (SELECT unnest(range(1, 10)) AS i))
        WHERE c >= target GROUP BY metric, target)""",
    "deltas": "SELECT *, as1 - as2 AS d_as, mq1 - mq2 AS d_mq, nm2 - nm1 AS d_nm FROM two WHERE g2 IS NOT NULL",
    "dhist": f"""SELECT metric, decile, bin, count(*) AS n FROM (
        SELECT 'as' AS metric, {_decile('as1', 'as')} AS decile, CAST(least(floor(d_as * 200 / 100.0), 200) AS INTEGER) AS bin FROM deltas WHERE d_as >= 0
        UNION ALL SELECT 'mapq', {_decile('mq1', 'mapq')}, CAST(least(floor(d_mq * 120 / 60.0), 120) AS INTEGER) FROM deltas WHERE d_mq >= 0) GROUP BY ALL""",
    "tails": """SELECT metric, decile, bin, sum(coalesce(n, 0)) OVER (PARTITION BY metric, decile ORDER BY bin DESC) / CAST(tot AS DOUBLE) AS p FROM (
        SELECT t.metric, t.decile, t.bin, t.tot, h.n FROM (SELECT metric, decile, sum(n) AS tot, CAST(unnest(range(0, CASE metric WHEN 'as' THEN 201 ELSE 121 END)) AS INTEGER) AS bin FROM dhist GROUP BY metric, decile) t
        LEFT JOIN dhist h ON h.metric = t.metric AND h.decile = t.decile AND h.bin = t.bin)""",
    "raw0": f"SELECT *, as1 - as2 AS d_as, mq1 - mq2 AS d_mq, nm2 - nm1 AS d_nm, {_decile('as1', 'as')} AS decile_as, {_decile('mq1', 'mapq')} AS decile_mapq FROM two",
    "raw": f"""SELECT r.*, a.p AS p_as, m.p AS p_mq, CASE WHEN coalesce(a.p <= 0.05::DOUBLE, false) OR coalesce(m.p <= 0.05::DOUBLE, false) OR coalesce(d_nm > 0, false) OR as2 IS NULL THEN 'winner' ELSE 'ambiguous' END AS assigned_class FROM raw0 r
        LEFT JOIN tails a ON a.metric = 'as' AND a.decile = r.decile_as AND a.bin = {_tail('r.d_as', 100, 200)}
        LEFT JOIN tails m ON m.metric = 'mapq' AND m.decile = r.decile_mapq AND m.bin = {_tail('r.d_mq', 60, 120)}""",
    "assign0": "SELECT k.Read, k.BC, k.Genome, k.as_, k.MAPQ, k.NM, k.XAcount, r.assigned_class, r.p_as, r.p_mq, k.frag_loc FROM ranked k JOIN raw r ON k.Read = r.Read AND k.BC = r.BC WHERE k.rk = 1 OR r.assigned_class = 'ambiguous'",
    "ends": """SELECT Read, BC, Genome, assigned_class, chr, pos FROM (SELECT *, split_part(frag_loc, ':', 1) AS chr, unnest([try_cast(split_part(frag_loc, ':', 2) AS INTEGER), try_cast(split_part(frag_loc, ':', 3) AS INTEGER)]) AS pos FROM assign0)
        WHERE pos >= 0 AND chr NOT IN ('*', '')""",
    "assign": """SELECT a.* REPLACE (CASE WHEN a.assigned_class = 'ambiguous' AND EXISTS (SELECT 1 FROM ends x JOIN ends w ON w.BC = x.BC AND w.Genome = x.Genome AND w.chr = x.chr AND abs(w.pos - x.pos) <= 500
          WHERE w.assigned_class = 'winner' AND x.Read = a.Read AND x.BC = a.BC AND x.Genome = a.Genome AND x.assigned_class = 'ambiguous') THEN 'rescued' ELSE a.assigned_class END AS assigned_class) FROM assign0 a""",
    "chunks": "SELECT BC, CAST(floor((row_number() OVER (ORDER BY BC) - 1) / 100) + 1 AS BIGINT) AS chunk_id FROM (SELECT DISTINCT BC FROM qc WHERE BC <> '')",
    "gt": "SELECT BC AS barcode, Read AS read_id, Genome AS genome, as_, MAPQ AS mapq, NM AS nm, XAcount AS xa, assigned_class AS cls, p_as FROM assign",
    "red": """SELECT barcode, read_id, genome, max(as_) AS as_, max(mapq) AS mapq, min(nm) AS nm, max(xa) AS xa, CASE WHEN bool_or(cls = 'ambiguous') THEN 'ambiguous' ELSE max(cls) END AS cls
        FROM gt WHERE barcode IS NOT NULL AND read_id IS NOT NULL AND genome IS NOT NULL GROUP BY ALL""",
    "scored": "SELECT *, CAST(as_ AS DOUBLE) + mapq - nm AS score FROM red",
    "post": "SELECT barcode, read_id, genome, 1.0::DOUBLE AS l, 0.001::DOUBLE AS l_amb, 1.0::DOUBLE AS w_read FROM (SELECT *, row_number() OVER (PARTITION BY barcode, read_id ORDER BY score DESC NULLS LAST, genome) AS rn FROM scored) WHERE rn = 1",
    "soft": """SELECT barcode, read_id, genome, e / (sum(e) OVER w + 0.001::DOUBLE) AS l, 0.001::DOUBLE / (sum(e) OVER w + 0.001::DOUBLE) AS l_amb, 1.0::DOUBLE AS w_read FROM (
        SELECT *, CASE WHEN score IS NULL THEN 0 ELSE exp(greatest(least(score - max(score) OVER (PARTITION BY barcode, read_id), 50), -50)) END AS e FROM scored) WINDOW w AS (PARTITION BY barcode, read_id)""",
    "mass": "SELECT barcode, genome, sum(l) AS c FROM post GROUP BY ALL",
    "genomes": "SELECT DISTINCT genome FROM post",
    "reads": "SELECT barcode, count(DISTINCT read_id) AS n_reads FROM post GROUP BY barcode",
    "top": "SELECT barcode, CAST(rank AS INTEGER) AS rank, genome, c FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY c DESC, genome) AS rank FROM mass) WHERE rank <= 3",
    "stats": """SELECT barcode, n_effective, top_genome, p_top1, p_top2, CASE WHEN p_top2 > 0 THEN p_top1 / greatest(p_top2, 1e-12::DOUBLE) END AS ratio12, CASE WHEN p_top2 > 0 THEN least(p_top1, p_top2) ELSE 0 END AS doublet_minor_frac FROM (
        SELECT barcode, sum(c) AS n_effective, max(genome) FILTER (WHERE r = 1) AS top_genome, max(c) FILTER (WHERE r = 1) / greatest(sum(c), 1e-12::DOUBLE) AS p_top1, coalesce(max(c) FILTER (WHERE r = 2), 0) / greatest(sum(c), 1e-12::DOUBLE) AS p_top2
        FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY c DESC, genome) AS r FROM mass) GROUP BY barcode)""",
    "seed0": "SELECT barcode FROM (SELECT barcode, sum(c) AS n FROM mass GROUP BY barcode) QUALIFY row_number() OVER (ORDER BY n, barcode) <= greatest(1, ceil(0.02::DOUBLE * count(*) OVER ()))",
    "eta0": _eta("seed0"),
    "cand0": "SELECT barcode FROM stats WHERE p_top1 * greatest(n_effective, 1e-12::DOUBLE) / (n_effective + 1e-12::DOUBLE) <= 0.6::DOUBLE AND p_top1 / (p_top2 + 1e-12::DOUBLE) <= 1.5::DOUBLE",
    "cand": "SELECT barcode FROM cand0 UNION ALL SELECT barcode FROM stats WHERE NOT EXISTS (SELECT 1 FROM cand0)",
    "jsd0": _jsd("mass", "eta0"), "seed1": _seed("jsd0"), "eta1": _eta("seed1"), "jsd1": _jsd("mass", "eta1"), "seed2": _seed("jsd1"), "eta2": _eta("seed2"), "jsd2": _jsd("mass", "eta2"),
    "sig": "SELECT p.barcode, p.genome, p.l, p.l * coalesce(e.eta, 0) AS e, count(*) AS cnt FROM post p LEFT JOIN eta2 e ON e.genome = p.genome GROUP BY ALL",
    "bic0": f"SELECT s.barcode, any_value(r.n_reads) AS n_reads, {_bic('sum(cnt * ln(greatest(round(e, 12), 1e-12::DOUBLE)))', 0, 'any_value(r.n_reads)')} AS bic_empty FROM sig s JOIN reads r ON r.barcode = s.barcode GROUP BY s.barcode",
    "single": f"""SELECT barcode, min(x) AS x FROM (SELECT s.barcode, struct_pack(bic := {_bic(f'sum(cnt * ln(greatest({_S1}, 1e-12::DOUBLE)))', 1, 'any_value(r.n_reads)')}, c := t.rank - 1, i := i) AS x
        FROM sig s JOIN top t ON t.barcode = s.barcode JOIN reads r ON r.barcode = s.barcode, (SELECT unnest(range(0, 26)) AS i) GROUP BY s.barcode, t.rank, i) GROUP BY barcode""",
    "doublet": f"""SELECT barcode, min(x) AS x FROM (SELECT s.barcode, struct_pack(bic := {_bic(f'sum(cnt * ln(greatest({_S2}, 1e-12::DOUBLE)))', 2, 'any_value(r.n_reads)')}, pair := (a.rank - 1) * 1000 + b.rank - 1, i := i, j := j, c := a.rank - 1, d := b.rank - 1) AS x
        FROM sig s JOIN top a ON a.barcode = s.barcode JOIN top b ON b.barcode = s.barcode AND a.rank < b.rank JOIN reads r ON r.barcode = s.barcode, (SELECT unnest(range(0, 26)) AS i), (SELECT unnest(range(0, 17)) AS j) GROUP BY s.barcode, a.rank, b.rank, i, j) GROUP BY barcode""",
    "softe": "SELECT p.barcode, p.read_id, sum(p.l * coalesce(e.eta, 0)) AS e, max(p.w_read) AS w FROM soft p LEFT JOIN eta2 e ON e.genome = p.genome GROUP BY ALL",
    "softs": f"""SELECT barcode, min(x) AS x, any_value(n) AS n_reads, any_value(w) AS n_reads_eff FROM (SELECT barcode, struct_pack(bic := {_bic('sum(ln(greatest((1 - i * 0.02::DOUBLE) * l + i * 0.02::DOUBLE * e, 1e-12::DOUBLE)))', 1, 'count(*)')}, c := rank - 1, i := i) AS x, count(*) AS n, sum(w) AS w
        FROM (SELECT r.barcode, r.e, r.w, t.rank, coalesce(p.l, 0) AS l FROM softe r JOIN top t ON t.barcode = r.barcode LEFT JOIN soft p ON p.barcode = r.barcode AND p.read_id = r.read_id AND p.genome = t.genome), (SELECT unnest(range(0, 26)) AS i) GROUP BY barcode, rank, i) GROUP BY barcode""",
    "model0": """SELECT b.barcode, b.n_reads, b.bic_empty, s.x.bic AS bs, s.x.c AS sc, s.x.i AS si, d.x.bic AS bd, d.x.c AS dc, d.x.d AS dd, d.x.i AS di, d.x.j AS dj, t.p_top1, t.p_top2, t.ratio12, t.doublet_minor_frac, t.n_effective, j.jsd,
        coalesce(s.x.bic, 1e308) AS zs, coalesce(d.x.bic, 1e308) AS zd FROM bic0 b LEFT JOIN single s ON s.barcode = b.barcode LEFT JOIN doublet d ON d.barcode = b.barcode JOIN stats t ON t.barcode = b.barcode JOIN jsd2 j ON j.barcode = b.barcode""",
    "model1": """SELECT *, n_reads < 5 AS low, NOT n_reads < 5 AND bic_empty + 10 < least(zs, zd) AND p_top1 <= 0.6::DOUBLE AND coalesce(ratio12, 1e308) <= 1.5::DOUBLE AS is_empty,
        CASE WHEN bd IS NULL THEN 'single' WHEN bs + 6 < bd THEN 'single' WHEN bd + 6 < bs THEN 'doublet' ELSE 'ambiguous' END AS core FROM model0""",
    "calls": """SELECT m.barcode, CASE WHEN low THEN 'low_reads' WHEN is_empty THEN 'empty'
            WHEN core = 'single' THEN CASE WHEN p_top1 >= 0.6::DOUBLE AND coalesce(ratio12, 1e308) >= 2 AND NOT near THEN 'single_clean' ELSE 'dirty_singlet' END
            WHEN core = 'doublet' THEN CASE WHEN doublet_minor_frac >= 0.2::DOUBLE AND NOT near THEN 'doublet' ELSE 'weak_doublet' END ELSE core END AS call,
        CASE WHEN low THEN NULL WHEN is_empty THEN 'empty' ELSE mo END AS model, g1.genome AS genome_1, g2.genome AS genome_2,
        CASE mo WHEN 'single' THEN si * 0.02::DOUBLE WHEN 'doublet' THEN di * 0.02::DOUBLE END AS alpha, CASE mo WHEN 'doublet' THEN 0.1::DOUBLE + dj * 0.05::DOUBLE END AS rho,
        n_reads, CAST(n_reads AS DOUBLE) AS n_reads_eff, n_effective, p_top1, p_top2, ratio12, jsd AS jsd_to_eta, bic_empty, CASE WHEN is_empty THEN bic_empty WHEN mo = 'single' THEN bs WHEN mo = 'doublet' THEN bd END AS bic_best,
        CASE WHEN NOT low THEN bs END AS bic_single, CASE WHEN NOT low THEN bd END AS bic_doublet, CASE WHEN mo IS NOT NULL THEN abs(bs - bd) END AS bic_gap_sd, CASE WHEN mo IS NOT NULL THEN near END AS near_tie_sd, doublet_minor_frac,
        1 - CASE mo WHEN 'single' THEN si * 0.02::DOUBLE WHEN 'doublet' THEN di * 0.02::DOUBLE END AS purity_best, false AS xmap_activated, CASE WHEN mo IS NOT NULL THEN 0.0::DOUBLE END AS chi_g1
        FROM (SELECT *, CASE WHEN low OR is_empty THEN NULL WHEN zs <= zd THEN 'single' ELSE 'doublet' END AS mo, coalesce(abs(bs - bd) <= 2, false) AS near FROM model1) m
        LEFT JOIN top g1 ON g1.barcode = m.barcode AND g1.rank = CASE mo WHEN 'single' THEN sc WHEN 'doublet' THEN dc END + 1 LEFT JOIN top g2 ON g2.barcode = m.barcode AND mo = 'doublet' AND g2.rank = dd + 1""",
    "scalls": """SELECT s.barcode, CASE WHEN r.n_reads < 5 THEN 'low_reads' WHEN s.p_top1 >= 0.6::DOUBLE THEN 'single_clean' WHEN s.p_top2 >= 0.2::DOUBLE THEN 'doublet' ELSE 'ambiguous' END AS call,
        CASE WHEN r.n_reads < 5 THEN NULL WHEN s.p_top1 >= 0.6::DOUBLE THEN 'single' WHEN s.p_top2 >= 0.2::DOUBLE THEN 'doublet' ELSE 'single' END AS model, t1.genome AS genome_1, t2.genome AS genome_2, NULL::VARCHAR AS indist_set
        FROM stats s JOIN reads r ON r.barcode = s.barcode JOIN top t1 ON t1.barcode = s.barcode AND t1.rank = 1 LEFT JOIN top t2 ON t2.barcode = s.barcode AND t2.rank = 2""",
    "calls_fix": _values(testkit.CALLS_FIX, "barcode, call, model, genome_1, genome_2, indist_set"),
    "callsall": "SELECT barcode, call, model, genome_1, genome_2, CAST(NULL AS VARCHAR) AS indist_set FROM scalls UNION ALL SELECT barcode, call, model, genome_1, genome_2, indist_set FROM calls_fix",
    "rules": _allowed("free", "scalls", False, False, "design_rescue", "top1"),
    "drules": _allowed("design", "scalls", True, True, "design_rescue", "top1"),
    "wins": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY barcode, read_id ORDER BY coalesce(as_, -999999) DESC, coalesce(mapq, -1) DESC, coalesce(nm, 999999), genome) AS rn
        FROM gt WHERE cls = 'winner' OR NOT EXISTS (SELECT 1 FROM gt WHERE cls = 'winner')) WHERE rn = 1""",
    "judged": """SELECT *, CASE WHEN dropped THEN CASE WHEN drop_barcode THEN 'drop_barcode' ELSE 'mismatch_winner' END END AS reason FROM (SELECT *, confident AND NOT keep AS dropped FROM (
        SELECT w.*, r.bc_key, r.allowed, coalesce(w.p_as <= 0.5::DOUBLE, true) AS confident, r.action <> 'keep_cleaned' AS drop_barcode,
          r.action = 'keep_cleaned' AND coalesce(w.p_as <= 0.5::DOUBLE, true) AND list_contains(r.allowed, w.genome) AS keep FROM wins w JOIN drules r ON r.barcode = w.barcode))""",
    "pre": "SELECT barcode, genome, count(*) AS n_winner_reads FROM judged WHERE confident GROUP BY ALL",
    "postc": "SELECT barcode, genome, count(*) AS n_winner_reads FROM judged WHERE keep GROUP BY ALL",
    "comp": """SELECT p.barcode, r.expected_genome, CAST(sum(n_winner_reads) AS BIGINT) AS total_reads, arg_min(genome, struct_pack(a := -n_winner_reads, b := genome)) AS top_genome, max(n_winner_reads) AS top_reads,
        CAST(coalesce(sum(n_winner_reads) FILTER (WHERE genome = r.expected_genome), 0) AS BIGINT) AS expected_reads FROM pre p LEFT JOIN drules r ON r.barcode = p.barcode GROUP BY ALL""",
    "comp2": "SELECT *, top_reads / CAST(total_reads AS DOUBLE) AS top_frac, CASE WHEN expected_genome IS NOT NULL THEN expected_reads / CAST(total_reads AS DOUBLE) END AS expected_frac, 1 - CASE WHEN expected_genome IS NOT NULL THEN expected_reads / CAST(total_reads AS DOUBLE) END AS contamination_rate FROM comp",
    "gate": """SELECT *, ar >= 5 AND frac >= 0.9::DOUBLE AS keep_postclean, CASE WHEN ar < 5 THEN 'allowed_reads_post<5' WHEN frac < 0.9::DOUBLE THEN 'allowed_frac_post<0.9' ELSE 'keep' END AS drop_reason FROM (
        SELECT *, CASE WHEN tr > 0 THEN ar / CAST(tr AS DOUBLE) ELSE 0 END AS frac FROM (SELECT r.barcode, CAST(coalesce(sum(p.n_winner_reads), 0) AS BIGINT) AS tr, CAST(coalesce(sum(p.n_winner_reads) FILTER (WHERE list_contains(r.allowed, p.genome)), 0) AS BIGINT) AS ar
        FROM drules r LEFT JOIN postc p ON p.barcode = r.barcode GROUP BY r.barcode))""",
    "wread": "SELECT BC, Read, upper(Genome) AS Genome, as_ FROM assign WHERE assigned_class = 'winner' AND coalesce(XAcount, 0) <= 2",
    "wall": "SELECT BC, Read, upper(Genome) AS Genome, as_ FROM assign WHERE assigned_class = 'winner'",
    "asm": _by_mean("wread"),
    "asmall": _by_mean("wall"),
    "rates": "SELECT w.BC, a.assigned_genome, count(*) AS n_reads, count(*) FILTER (WHERE w.Genome <> a.assigned_genome) AS n_mismatch, count(*) FILTER (WHERE w.Genome <> a.assigned_genome) / CAST(count(*) AS DOUBLE) AS contam_rate FROM wread w JOIN asm a ON a.BC = w.BC GROUP BY ALL",
    "sstats": "SELECT s.sample, count(DISTINCT r.BC) AS n_bc, CAST(sum(n_reads) AS BIGINT) AS n_reads, avg(contam_rate) AS mean_contam, quantile_cont(contam_rate, 0.5) AS median_contam, quantile_cont(contam_rate, 0.95) AS p95_contam FROM rates r JOIN samples s ON s.BC = r.BC GROUP BY s.sample",
    "wells": "SELECT sample, row, unnest(range(a, b + 1)) AS col FROM (" + _values([(s, r[0], int(r[1:].split("-")[0]), int(r[1:].split("-")[-1])) for s, ws in testkit.PLATE_MAP for r in ws.split(",")], "sample, row, a, b") + ")",
    "rated": """SELECT a.top1_as_mean, CAST(a.total_n AS DOUBLE) AS total_n, a.top1_as_mean - a.top2_as_mean AS as_gap, round(r.contam_rate, 9) AS x,
        round((SELECT quantile_cont(coalesce(contam_rate, 0), 0.2) FROM rates), 9) AS lo, round((SELECT quantile_cont(coalesce(contam_rate, 0), 0.8) FROM rates), 9) AS hi FROM asm a LEFT JOIN rates r ON r.BC = a.BC""",
    "grp": " UNION ALL ".join(f"SELECT '{v}' AS variable, '{g}' AS grp, {e} AS v FROM rated WHERE {c}" for v, e in (("top1_as_mean", "top1_as_mean"), ("total_n", "total_n"), ("as_gap", "coalesce(as_gap, 'inf'::DOUBLE)")) for g, c in (("low", "x <= lo"), ("high", "x >= hi"))),
    "gaps": """SELECT variable, n1, n2, max(abs(ca * n2 - cb * n1)) AS gap FROM (SELECT variable, CAST(sum(a) OVER w AS BIGINT) AS ca, CAST(sum(b) OVER w AS BIGINT) AS cb, CAST(sum(a) OVER t AS BIGINT) AS n1, CAST(sum(b) OVER t AS BIGINT) AS n2
        FROM (SELECT variable, v, count(*) FILTER (WHERE grp = 'low') AS a, count(*) FILTER (WHERE grp = 'high') AS b FROM grp GROUP BY ALL) WINDOW w AS (PARTITION BY variable ORDER BY v), t AS (PARTITION BY variable)) GROUP BY ALL""",
    "hexend": """SELECT min(n_reads) - 1e-9::DOUBLE * (max(n_reads) - min(n_reads)) AS x0, max(n_reads) + 1e-9::DOUBLE * (max(n_reads) - min(n_reads)) AS x1, min(contam_rate) AS y0, max(contam_rate) AS y1 FROM rates""",
    "hexat": """SELECT p, q, (x1 - x0) / 20 AS sx, (y1 - y0) / 11 AS sy, x0, y0, (p - round_even(p, 0)) ** 2 + 3 * (q - round_even(q, 0)) ** 2 < (p - floor(p) - 0.5) ** 2 + 3 * (q - floor(q) - 0.5) ** 2 AS even
        FROM (SELECT (n_reads - x0) / ((x1 - x0) / 20) AS p, (contam_rate - y0) / ((y1 - y0) / 11) AS q, x0, x1, y0, y1 FROM rates CROSS JOIN hexend)""",
    "dens": """SELECT sample, v, lo - w AS lo, hi + w AS hi, total FROM (SELECT s.sample, r.contam_rate AS v, min(r.contam_rate) OVER p AS lo, max(r.contam_rate) OVER p AS hi, count(*) OVER p AS total,
        CASE WHEN min(r.contam_rate) OVER p = max(r.contam_rate) OVER p THEN 0.5::DOUBLE ELSE 0 END AS w FROM rates r JOIN samples s ON s.BC = r.BC WINDOW p AS (PARTITION BY s.sample))""",
    "edges50": "SELECT sample, total, k, lo + k * ((hi - lo) / 50) AS a, CASE WHEN k = 49 THEN hi ELSE lo + (k + 1) * ((hi - lo) / 50) END AS b FROM (SELECT DISTINCT sample, lo, hi, total FROM dens), (SELECT CAST(unnest(range(50)) AS INTEGER) AS k)",
}


def sql(final: str) -> str:
    """``final`` with every step that it or its steps name."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in STEPS:
            if name not in order and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                need(STEPS[name])
                if name not in order:
                    order.append(name)

    need(final)
    order.sort(key=list(STEPS).index)
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n].strip()})" for n in order) + "\n" + final


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


_TWO = "Read, BC, g1, as1, mq1, nm1, g2, as2, mq2, nm2, gl, asl, mql, nml, n_genomes"
_CALLS = "barcode, call, model, genome_1, genome_2, n_reads, near_tie_sd, xmap_activated, " + _r("alpha", "rho", "n_reads_eff", "n_effective", "p_top1", "p_top2", "ratio12", "jsd_to_eta", "bic_empty", "bic_best", "bic_single", "bic_doublet", "bic_gap_sd", "doublet_minor_frac", "purity_best", "chi_g1")
_POST = "barcode, read_id, genome, " + _r("l", "l_amb", "w_read")
#: Share of lattice paths that leave the band, by diagonals: a list of shares by place, each diagonal from the one before.
_PATHS = """list_reduce([list_transform(range(n1 + 1), lambda i: 0::DOUBLE)] || list_transform(range(1, n1 + n2 + 1), lambda k: [k::DOUBLE]), lambda f, e: list_transform(range(n1 + 1), lambda i: CASE
            WHEN i > e[1] OR e[1] - i > n2 THEN 0 WHEN abs(i * n2 - (e[1] - i) * n1) >= gap THEN 1 ELSE (coalesce(f[i], 0) * i + f[i + 1] * (e[1] - i)) / e[1] END))[n1 + 1]"""
_RULE = "barcode, bc_key, call, model, genome_1, genome_2, expected_genome, array_to_string(allowed, ',') AS allowed_set, action, reason, flags"

ORACLE_SQL: dict[str, str] = {
    name: sql(text)
    for name, text in {
        "bc_normalize": "SELECT BC_raw, CASE WHEN coalesce(BC_raw, '') = '' THEN '' ELSE split_part(BC_raw, '-', 1) || '-pool_1' END AS bc_norm, count(*) AS n FROM qc GROUP BY ALL",
        "bc_freq_filter": "SELECT Read, b AS BC, MAPQ, as_, NM, XAcount, frag_loc FROM (SELECT *, count(*) OVER (PARTITION BY b) AS n FROM (SELECT *, split_part(BC_raw, '-', 1) || '-pool_1' AS b FROM qc)) WHERE n >= 30",
        "distinct_barcodes": "SELECT DISTINCT BC FROM qc WHERE BC <> ''",
        "barcode_chunks": "SELECT BC, chunk_id FROM chunks",
        "union_genomes": "SELECT Genome, count(*) AS n_rows, count(DISTINCT Read) AS n_reads FROM qc GROUP BY Genome",
        "genomes_one_scan": "SELECT Genome, Read, BC, MAPQ, as_, NM, XAcount, frag_loc FROM qc",
        "quarantined_lines": "SELECT CASE WHEN Read LIKE '%0' THEN 'bad' ELSE 'good' END AS kind, Read, count(*) AS n FROM assign GROUP BY ALL",
        "alignment_filter": "SELECT Read, BC, Genome, MAPQ, as_, NM, XAcount FROM filt",
        "semi_ambiguous_bcs": "SELECT Read, BC, Genome, as_ FROM filt WHERE BC IN (SELECT BC FROM raw WHERE assigned_class = 'ambiguous')",
        "dedup_read_genome": "SELECT Read, BC, Genome, MAPQ, as_, NM, XAcount, frag_loc FROM best",
        "rank_genomes": "SELECT Read, BC, Genome, rk, rk_worst, n_genomes FROM ranked",
        "best_two_worst": f"SELECT {_TWO} FROM two",
        "best_two_delta": "SELECT Read, BC, as1, mq1, d_as, d_mq, d_nm FROM deltas",
        "winner_hist": "SELECT metric, bin, n FROM hist",
        "decile_edges": "SELECT metric, edge FROM edges",
        "delta_hist": "SELECT metric, decile, bin, n FROM dhist",
        "tail_prob": f"SELECT metric, decile, bin, {_r('p')} FROM tails",
        "assign_raw": f"SELECT {_TWO}, d_as, d_mq, d_nm, decile_as, decile_mapq, {_r('p_as', 'p_mq')}, assigned_class FROM raw",
        "assign_filtered": f"SELECT Read, BC, Genome, as_, MAPQ, NM, XAcount, assigned_class, {_r('p_as', 'p_mq')}, frag_loc FROM assign0",
        "friend_rescue": f"SELECT Read, BC, Genome, as_, MAPQ, NM, XAcount, assigned_class, {_r('p_as', 'p_mq')}, frag_loc FROM assign",
        "tail_prob_merged": f"SELECT metric, decile, bin, {_r('p')} FROM tails",
        "assign_by_chunks": f"SELECT Read, BC, Genome, as_, MAPQ, NM, XAcount, assigned_class, {_r('p_as', 'p_mq')}, frag_loc FROM assign WHERE BC <> ''",
        "filter_counts": """SELECT unnest(['n_rows', 'n_low_mapq', 'n_many_hits', 'n_kept']) AS counter, unnest([count(*), count(*) FILTER (NOT hi), count(*) FILTER (hi AND NOT few), count(*) FILTER (hi AND few)]) AS n
            FROM (SELECT coalesce(MAPQ >= 20, false) AS hi, coalesce(XAcount <= 2, false) AS few FROM qc)""",
        "assign_stats": "SELECT chunk_id, count(*) AS n_reads, count(*) FILTER (WHERE assigned_class = 'winner') AS n_winner, count(*) FILTER (WHERE assigned_class = 'ambiguous') AS n_ambiguous, count(DISTINCT raw.BC) FILTER (WHERE assigned_class = 'ambiguous') AS n_ambiguous_bcs FROM raw JOIN chunks ON chunks.BC = raw.BC GROUP BY chunk_id",
        "reduce_per_genome": "SELECT * FROM red",
        "gt_read_quality": "SELECT * FROM red WHERE mapq >= 30 AND xa <= 1",
        "promiscuous_filter": """SELECT barcode, read_id, genome, as_, mapq, nm, xa, cls FROM (SELECT *, count(*) FILTER (WHERE seen >= best - 6) OVER w AS near, count(seen) OVER w AS rows FROM (
            SELECT *, max(seen) OVER (PARTITION BY barcode, read_id) AS best FROM (SELECT *, CASE WHEN cls = 'ambiguous' THEN mapq END AS seen FROM red)) WINDOW w AS (PARTITION BY barcode, read_id)) WHERE NOT (seen IS NOT NULL AND near > 1 AND rows <= 500)""",
        "winner_only_posterior": f"SELECT {_POST} FROM post",
        "softmax_posterior": f"SELECT {_POST} FROM soft",
        "mass_by_genome": f"SELECT barcode, genome, {_r('c')} FROM mass",
        "mass_pivot": "SELECT barcode, " + ", ".join(f"coalesce(sum(c) FILTER (WHERE genome = 'G{i}'), 0) AS G{i}" for i in range(5)) + " FROM mass GROUP BY barcode",
        "n_reads": "SELECT barcode, n_reads FROM reads",
        "topk_genomes": f"SELECT barcode, rank, genome, {_r('c')} FROM top",
        "topk_restrict": "SELECT * FROM red WHERE EXISTS (SELECT 1 FROM top t WHERE t.barcode = red.barcode AND t.genome = red.genome AND t.rank <= 2)",
        "reclass_topk": """SELECT barcode, read_id, genome, as_, mapq, nm, xa, CASE WHEN win THEN 'winner' ELSE 'ambiguous' END AS cls FROM (SELECT *, CASE WHEN nw = 1 THEN cls = 'winner' WHEN nr = 1 THEN cls = 'rescued' ELSE coalesce(score = b AND nb = 1, false) END AS win FROM (
            SELECT *, count(*) FILTER (WHERE score = b) OVER (PARTITION BY barcode, read_id) AS nb FROM (SELECT *, count(*) FILTER (WHERE cls = 'winner') OVER w AS nw, count(*) FILTER (WHERE cls = 'rescued') OVER w AS nr, max(score) OVER w AS b
            FROM scored WHERE EXISTS (SELECT 1 FROM top t WHERE t.barcode = scored.barcode AND t.genome = scored.genome AND t.rank <= 2) WINDOW w AS (PARTITION BY barcode, read_id))))""",
        "eta_initial_seed": "SELECT barcode FROM seed0",
        "eta_seeded": f"SELECT genome, {_r('eta')} FROM eta0",
        "eta_learned": f"SELECT genome, {_r('eta')} FROM eta2",
        "jsd_to_eta": f"SELECT barcode, {_r('jsd')} FROM jsd0",
        "jsd_seed": "SELECT barcode, round(j, 6) AS jsd FROM seed1",
        "phi_chi": f"""SELECT * FROM (WITH a AS (SELECT s.barcode, s.top_genome AS anchor FROM stats s JOIN reads r ON r.barcode = s.barcode WHERE r.n_reads >= 10 AND coalesce(s.ratio12, 1e308) >= 2),
            n AS (SELECT anchor, count(*) AS n FROM a GROUP BY anchor), x AS (SELECT a.anchor, m.genome AS target, sum(m.c) AS c FROM a JOIN mass m ON m.barcode = a.barcode GROUP BY ALL),
            f AS (SELECT g.genome AS anchor, h.genome AS target, coalesce(n.n, 0) AS n, coalesce(x.c, 0) AS c FROM genomes g CROSS JOIN genomes h LEFT JOIN n ON n.anchor = g.genome LEFT JOIN x ON x.anchor = g.genome AND x.target = h.genome),
            p AS (SELECT anchor, target, CASE WHEN n >= 10 AND sum(c) OVER (PARTITION BY anchor) > 0 THEN c / sum(c) OVER (PARTITION BY anchor) WHEN anchor = target THEN 1 ELSE 0 END AS phi FROM f)
            SELECT anchor, target, {_r('phi')}, round(max(CASE WHEN anchor <> target THEN phi ELSE 0 END) OVER (PARTITION BY anchor), 6) AS chi FROM p)""",
        "barcode_stats": f"SELECT barcode, top_genome, {_r('n_effective', 'p_top1', 'p_top2', 'ratio12', 'doublet_minor_frac')} FROM stats",
        "winner_discount": """SELECT barcode, genome, round(CASE WHEN genome = top THEN 1 ELSE least(wm / most, 1) END, 6) AS discount FROM (SELECT *, first_value(genome) OVER (PARTITION BY barcode ORDER BY wm DESC, genome) AS top, max(wm) OVER (PARTITION BY barcode) AS most
            FROM (SELECT barcode, genome, sum(l) AS wm FROM post GROUP BY ALL))""",
        "bic_empty": f"SELECT barcode, n_reads, {_r('bic_empty')} FROM bic0",
        "bic_single_grid": "SELECT barcode, round(x.bic, 6) AS bic, CAST(x.c AS INTEGER) AS c, CAST(x.i AS INTEGER) AS i FROM single",
        "bic_doublet_grid": "SELECT barcode, round(x.bic, 6) AS bic, CAST(x.c AS INTEGER) AS c, CAST(x.d AS INTEGER) AS d, CAST(x.i AS INTEGER) AS i, CAST(x.j AS INTEGER) AS j FROM doublet",
        "call_decision": f"SELECT {_CALLS} FROM calls",
        "design_expected": "SELECT s.barcode, split_part(s.barcode, '-', 1) AS bc_key, s.call, d.expected_genome FROM scalls s LEFT JOIN design d ON d.bc_key = split_part(s.barcode, '-', 1)",
        "policy_allowed_set": " UNION ALL ".join(f"SELECT variant, {_RULE} FROM ({_allowed(*v)})" for v in (("strict", "callsall", True, True, "design_rescue", "top1"), ("rescue", "callsall", True, False, "top12_rescue", "top12"), ("free", "callsall", False, False, "top12_rescue", "top12"), ("free_default", "callsall", False, False, "design_rescue", "top1"))),
        "decontam_winner": f"SELECT barcode, read_id, genome, as_, mapq, nm, cls, {_r('p_as')} FROM wins",
        "safe_keep": """SELECT barcode, read_id, best_allowed_as, best_disallowed_as, coalesce(best_allowed_as >= best_disallowed_as - 5 AND bm >= 25 AND bn <= 3, false) AS safe_keep FROM (SELECT g.barcode, g.read_id, max(as_) FILTER (WHERE ok) AS best_allowed_as, max(as_) FILTER (WHERE NOT ok) AS best_disallowed_as,
            max(mapq) FILTER (WHERE ok) AS bm, min(nm) FILTER (WHERE ok) AS bn FROM (SELECT gt.*, coalesce(list_contains(r.allowed, gt.genome), false) AS ok FROM gt LEFT JOIN drules r ON r.barcode = gt.barcode) g GROUP BY g.barcode, g.read_id)""",
        "reads_to_drop": f"SELECT read_id, barcode, bc_key, array_to_string(allowed, ',') AS allowed_set, genome AS winner_genome, {_r('p_as')}, reason FROM judged WHERE dropped",
        "pre_counts": "SELECT barcode, genome, n_winner_reads FROM pre",
        "post_counts": "SELECT barcode, genome, n_winner_reads FROM postc",
        "barnyard_composition": f"SELECT barcode, expected_genome, total_reads, top_genome, top_reads, expected_reads, {_r('top_frac', 'expected_frac', 'contamination_rate')} FROM comp2",
        "contamination_bins": f"""SELECT e.expected_genome, b.label AS bin_label, count(c.barcode) AS n_barcodes FROM (SELECT DISTINCT expected_genome FROM comp2 WHERE expected_genome IS NOT NULL) e CROSS JOIN ({_values([(n, lo, hi) for (n, hi), lo in zip(BINS, [0] + [h for _, h in BINS], strict=False)], 'label, lo, hi')}) b
            LEFT JOIN comp2 c ON c.expected_genome = e.expected_genome AND c.contamination_rate >= CAST(b.lo AS DOUBLE) AND c.contamination_rate < CAST(b.hi AS DOUBLE) GROUP BY ALL""",
        "postclean_gate": "SELECT barcode, tr AS post_total_reads, ar AS post_allowed_reads, round(frac, 6) AS post_allowed_frac, keep_postclean, drop_reason FROM gate",
        "calls_decontam": "SELECT c.barcode, c.call, c.model, c.genome_1, c.genome_2, r.expected_genome, array_to_string(r.allowed, ',') AS allowed_set, r.action, r.reason, r.flags, g.tr AS post_total_reads, g.ar AS post_allowed_reads, round(g.frac, 6) AS post_allowed_frac, g.keep_postclean, g.drop_reason FROM scalls c LEFT JOIN drules r ON r.barcode = c.barcode LEFT JOIN gate g ON g.barcode = c.barcode",
        "clean_anti": "SELECT Read, BC, Genome, as_ FROM qc WHERE Read NOT IN (SELECT read_id FROM judged WHERE dropped)",
        "as_mean_assign": f"SELECT BC, total_n, assigned_genome, top1_n, second_genome, {_r('top1_as_mean', 'top2_as_mean')}, round(top1_as_mean - top2_as_mean, 6) AS as_gap FROM asm",
        "contamination_rate": f"SELECT BC, assigned_genome, n_reads, n_mismatch, {_r('contam_rate')} FROM rates",
        "pass_barcodes": "SELECT BC, assigned_genome FROM asm WHERE upper(assigned_genome) IN ('G0', 'G2', 'G4')",
        "reads_to_discard": "SELECT w.BC, w.Read, w.Genome, a.assigned_genome FROM wread w JOIN asm a ON a.BC = w.BC WHERE w.Genome <> a.assigned_genome",
        "plate_sample_stats": f"SELECT sample, n_bc, n_reads, {_r('mean_contam', 'median_contam', 'p95_contam')} FROM sstats",
        "plate_grid": "SELECT g.row, g.col, w.sample, round(s.median_contam, 6) AS value FROM (SELECT row, CAST(col AS INTEGER) AS col FROM (SELECT unnest(string_split('ABCDEFGH', '')) AS row), (SELECT unnest(range(1, 13)) AS col)) g LEFT JOIN wells w ON w.row = g.row AND w.col = g.col LEFT JOIN sstats s ON s.sample = w.sample",
        "interpool_counts": "SELECT sample, assigned_genome, n_bc, round(n_bc / CAST(sum(n_bc) OVER (PARTITION BY sample) AS DOUBLE), 6) AS frac FROM (SELECT s.sample, a.assigned_genome, count(*) AS n_bc FROM asmall a JOIN samples s ON s.BC = a.BC GROUP BY ALL)",
        "read_composition": "SELECT sample, Genome, n_reads, round(n_reads / CAST(sum(n_reads) OVER (PARTITION BY sample) AS DOUBLE), 6) AS frac FROM (SELECT s.sample, w.Genome, count(*) AS n_reads FROM wall w JOIN samples s ON s.BC = w.BC GROUP BY ALL)",
        "ecdf_points": "SELECT variable, grp, CASE WHEN isfinite(v) THEN round(v, 6) END AS value, round(sum(n) OVER (PARTITION BY variable, grp ORDER BY v) / CAST(sum(n) OVER (PARTITION BY variable, grp) AS DOUBLE), 6) AS cdf FROM (SELECT variable, grp, v, count(*) AS n FROM grp GROUP BY ALL)",
        "heat_counts": """SELECT CAST(least(floor((contam_rate - x0) * 10 / (x1 - x0)), 9) AS INTEGER) AS ix, CAST(least(floor((n_reads - y0) * 8 / (y1 - y0)), 7) AS INTEGER) AS iy, count(*) AS n
            FROM rates, (SELECT min(contam_rate) AS x0, max(contam_rate) AS x1, CAST(min(n_reads) AS DOUBLE) AS y0, CAST(max(n_reads) AS DOUBLE) AS y1 FROM rates) GROUP BY ALL""",
        "hexagon_counts": "SELECT round(CASE WHEN even THEN round_even(p, 0) ELSE floor(p) + 0.5 END * sx + x0, 6) AS x, round(CASE WHEN even THEN round_even(q, 0) ELSE floor(q) + 0.5 END * sy + y0, 6) AS y, count(*) AS n FROM hexat GROUP BY ALL",
        "sample_density": """SELECT e.sample, e.k AS cell, round(a, 6) AS lo, round(b, 6) AS hi, count(v) AS n, round(count(v) / CAST(e.total AS DOUBLE) / (b - a), 6) AS density
            FROM edges50 e LEFT JOIN dens d ON d.sample = e.sample AND d.v >= a AND (d.v < b OR (k = 49 AND d.v <= b)) GROUP BY e.sample, e.k, a, b, e.total""",
        "bic_single_soft": "SELECT barcode, n_reads, round(n_reads_eff, 6) AS n_reads_eff, round(x.bic, 6) AS bic, CAST(x.c AS INTEGER) AS c, CAST(x.i AS INTEGER) AS i FROM softs",
        "ks_statistic": f"SELECT variable, n1, n2, round(gap / CAST(n1 AS DOUBLE) / n2, 6) AS d, round({_PATHS}, 6) AS p FROM gaps",
        "tsv_roundtrip": "SELECT Read, BC, MAPQ, as_, NM, XAcount, frag_loc FROM filt",
        "bam_roundtrip": "SELECT Genome, Read, BC, MAPQ, as_, NM, XAcount, frag_loc FROM qc",
        "streaming_reads": f"SELECT {_TWO} FROM two WHERE BC <> '' AND Read <> ''",
        "streaming_counts": "SELECT BC, count(*) AS n_rows FROM qc GROUP BY BC",
    }.items()
}
