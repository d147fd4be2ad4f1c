"""Secret scan (operator 9); DataFrame operations only.

Three patterns find known forms; these are the base spans.  They are then
blanked out: each of their characters is replaced by a twin outside Unicode's
assigned planes, which the patterns still know but candidates do not.  In what is left, runs
of 20 or more characters of ``[A-Za-z0-9+/=_-]`` are candidates, if they have a
letter and a digit, or letters of both cases and nothing else but at their
ends, unless the allow list knows their form.  A window of ``WINDOW`` characters
slides over a candidate.  The counts of its characters are kept, five bits
each, and from one window to the next only the count of the character that
leaves and of the one that enters change, and with them the sum of c*log2(c),
hence the window's Shannon entropy.  A candidate counts as a secret if its
highest window entropy reaches the bound of its character class.

Positions are code points, ends exclusive: prefix sums over the lengths of
matches and of the pieces between them, in blocks of ``BLOCK``.  No step looks at
all matches for each match, so a very long text costs in proportion to its
length and to its number of matches.

Null and empty texts have no spans.  Each row gives one row, repeated rows and
null ids included, without any shuffle; an empty table gives no rows; columns
other than the id and the text are not read and may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns, and the group whose length counts with its least number of characters.
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),  # the runs of 32 or more among those of [0-9a-f]+
}
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
WINDOW, BLOCK = 20, 256
#: Character classes in the order they are tried: pattern of the whole candidate, least entropy in bits.
CLASSES = (("hex", "^[0-9a-fA-F]+$", 3.0), ("alnum", "^[0-9A-Za-z]+$", 3.7), ("base64", "^[0-9A-Za-z+/=_-]+$", 3.7))
#: Forms that are no secrets: UUIDs, integrity digests, placeholders, lower-case slugs and paths.
ALLOWED = "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$|^sha(1|256|384|512)-|(?i:example|placeholder)|^/?[a-z]+([-_/][a-z]+)*([-_/][0-9]+)*/?$"
KINDS = ("assign", "access", "hex", "entropy")

#: Candidates' characters and their twins, whose code points are higher by TWIN.
_PLAIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
TWIN = 0x10F000
_TWINS = "".join(chr(TWIN + ord(c)) for c in _PLAIN)


def _both(ranges: str) -> str:
    """A regex class of single characters and ranges a-b, and of their twins."""
    pairs = [ranges[i : i + 3] if ranges[i + 1 : i + 2] == "-" else ranges[i] for i in _starts(ranges)]
    return "[" + "".join(p + "-".join(rf"\x{{{TWIN + ord(c):X}}}" for c in p.split("-")) for p in pairs) + "]"


def _starts(ranges: str) -> list[int]:
    out, i = [], 0
    while i < len(ranges):
        out.append(i)
        i += 3 if ranges[i + 1 : i + 2] == "-" else 1
    return out


#: The later patterns over a text in which the matches of earlier ones are blanked out.
TWINNED = {"assign": PATTERNS["assign"][0], "access": "".join(map(_both, "AKIA")) + _both("A-Z0-9") + "+", "hex": _both("0-9a-f") + "{32,}"}
SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"


def _let(name: str, value: str, body: str) -> str:
    """SQL: ``body`` with ``name`` for a value that is computed once; a column would be put into lambdas and computed for each element."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _quoted(pattern: str) -> str:
    return "r\"" + pattern + "\"" if '"' not in pattern else "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _prefix_sums(a: str) -> str:
    """SQL: inclusive prefix sums of an integer array that is not empty."""
    inside = "aggregate(slice(st, b * {0} + 1, {0}), cast(array() as array<int>), (t, v) -> concat(t, array(coalesce(try_element_at(t, -1), 0) + v)))".format(BLOCK)
    blocks = f"transform(sequence(0, cast((size(st) - 1) div {BLOCK} as int)), b -> {inside})"
    before = "aggregate(bl, array(0), (t, x) -> concat(t, array(element_at(t, -1) + element_at(x, -1))))"
    return _let("st", a, _let("bl", blocks, _let("off", before, "flatten(transform(bl, (x, b) -> transform(x, v -> v + off[b])))")))


def _ends(text: str, pattern: str) -> str:
    """SQL: the end of each of the matches ``ms`` of a pattern, and the length of the text."""
    return _prefix_sums(f"zip_with(split({text}, {_quoted(pattern)}, -1), ms, (g, m) -> length(g) + coalesce(length(m), 0))")


def _spans(kind: str) -> str:
    """SQL: a base kind's spans of ``text``."""
    pattern, group, least = PATTERNS[kind]
    p = _quoted(pattern)
    groups = f"regexp_extract_all(text, {p}, {group})" if group else "ms"
    sized = f"zip_with(ms, {groups}, (m, g) -> IF(length(g) >= {least}, length(m), NULL))"
    span = f"named_struct('start', e - n, 'ord', {list(PATTERNS).index(kind)}, 'end', e, 'kind', '{kind}')"
    found = f"filter(zip_with({_ends('text', pattern)}, {sized}, (e, n) -> IF(n IS NULL, NULL, {span})), x -> x IS NOT NULL)"
    return f"IF(text rlike {p}, {_let('ms', f'regexp_extract_all(text, {p}, 0)', found)}, cast(array() as {SPAN}))"


def _blanked() -> str:
    """SQL: ``text`` with twins in all base spans; from the fields of ``r``."""
    out = "text"
    for kind, (_, group, least) in PATTERNS.items():
        p = _quoted(TWINNED[kind])
        groups = f"regexp_extract_all(t, {p}, {group})" if group else "ms"
        twins = f"zip_with(ms, {groups}, (m, g) -> IF(length(g) >= {least}, translate(m, '{_PLAIN}', '{_TWINS}'), m))"
        joined = f"array_join(zip_with(split(t, {p}, -1), {twins}, (g, m) -> concat(g, coalesce(m, ''))), '')"
        out = _let("t", out, f"IF(size(r.{kind}) = 0, t, {_let('ms', f'regexp_extract_all(t, {p}, 0)', joined)})")
    return f"IF(size(r.base) = 0, text, {out})"


def _min_sum(s: str) -> str:
    """SQL: the least sum of c*log2(c) over the windows of the characters of ``s``.

    Counts stand in seven 60-bit words, twelve of five bits in each, by the character's code from '+' on.
    """
    f = "array(" + ", ".join(f"{c * math.log2(c) if c > 1 else 0.0!r}D" for c in range(WINDOW + 2)) + ")"
    code = lambda x: f"(ascii({x}) - 43)"
    codes = f"transform(split({s}, ''), x -> named_struct('w', cast({code('x')} div 12 as int), 'b', cast({code('x')} % 12 * 5 as int)))"
    first = f"transform(sequence(0, 6), k -> aggregate(slice(cs, 1, {WINDOW}), 0L, (t, x) -> t + IF(x.w = k, shiftleft(1L, x.b), 0L)))"
    total = "aggregate(c0, 0D, (t, word) -> t + aggregate(sequence(0, 55, 5), 0D, (u, b) -> u + f[cast(shiftright(word, b) & 31L as int)]))"
    count = lambda x: f"cast(shiftright(acc.c[{x}.w], {x}.b) & 31L as int)"
    now = "named_struct('now', acc.now - f[q.a] + f[q.a - 1] - f[q.b] + f[q.b + 1])"
    words = "transform(acc.c, (word, k) -> word - IF(k = mv.x.w, shiftleft(1L, mv.x.b), 0L) + IF(k = mv.y.w, shiftleft(1L, mv.y.b), 0L))"
    state = f"named_struct('c', {words}, 'now', z.now, 'least', least(acc.least, z.now))"
    step = _let("q", f"named_struct('a', {count('mv.x')}, 'b', {count('mv.y')})", _let("z", now, state))
    moves = f"zip_with(slice(cs, 1, size(cs) - {WINDOW}), slice(cs, {WINDOW + 1}, size(cs) - {WINDOW}), (x, y) -> named_struct('x', x, 'y', y))"
    slid = f"aggregate({moves}, named_struct('c', c0, 'now', s0, 'least', s0), (acc, mv) -> IF(mv.x = mv.y, acc, {step}), acc -> acc.least)"
    return _let("f", f, _let("cs", codes, _let("c0", first, _let("s0", total, slid))))


def _extra() -> str:
    """SQL: the spans of candidates of ``t`` whose entropy is high enough."""
    p = _quoted(CANDIDATE)
    may = f"(w rlike '[0-9]' AND w rlike '[A-Za-z]' OR w rlike '^[+/=_-]*[A-Za-z]+[+/=_-]*$' AND w rlike '[a-z]' AND w rlike '[A-Z]') AND NOT w rlike '{ALLOWED}'"
    bound = "CASE " + " ".join(f"WHEN w rlike '{c}' THEN {h}D" for _, c, h in CLASSES) + " END"
    # log2(W) - sum / W is highest where the sum is least
    strong = f"IF({may}, round({math.log2(WINDOW)!r}D - {_min_sum('w')} / {WINDOW}, 6) >= {bound}, false)"
    span = "named_struct('start', e - length(w), 'ord', 3, 'end', e, 'kind', 'entropy')"
    found = f"filter(zip_with({_ends('t', CANDIDATE)}, ms, (e, w) -> IF(coalesce({strong}, false), {span}, NULL)), x -> x IS NOT NULL)"
    return f"IF(t rlike {p}, {_let('ms', f'regexp_extract_all(t, {p}, 0)', found)}, cast(array() as {SPAN}))"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, assign, access, hex, base, spans): arrays of structs with start, ord, end and kind, in order."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kinds = "named_struct(" + ", ".join(f"'{k}', {_spans(k)}" for k in PATTERNS) + ")"
    fields = ", ".join(f"'{k}', s.{k}" for k in PATTERNS)
    base = _let("s", kinds, f"named_struct({fields}, 'base', array_sort(concat({', '.join(f's.{k}' for k in PATTERNS)})))")
    whole = _let("r", base, _let("t", _blanked(), f"named_struct({fields.replace('s.', 'r.')}, 'base', r.base, 'spans', array_sort(concat(r.base, {_extra()})))"))
    return rows.select("doc_id", F.expr(whole).alias("found")).select("doc_id", *[F.col(f"found.{n}").alias(n) for n in (*PATTERNS, "base", "spans")])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(scanned: DataFrame) -> DataFrame:
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS]
    return scanned.select("doc_id", *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def oracle() -> str:
    def kind(name: str, i: int) -> str:
        pattern, group, least = PATTERNS[name]
        p = pattern.replace("'", "''")
        return f"""
{name}_m AS (SELECT doc_id, generate_subscripts(string_split_regex(text, '{p}'), 1) AS i, unnest(string_split_regex(text, '{p}')) AS seg,
    unnest(list_concat(regexp_extract_all(text, '{p}', 0), [NULL])) AS m, unnest(list_concat(regexp_extract_all(text, '{p}', {group}), [NULL])) AS g FROM d),
{name} AS (SELECT doc_id, '{name}' AS kind, {i} AS ord, e - length(m) AS s, e, m FROM (SELECT *, sum(length(seg) + coalesce(length(m), 0)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM {name}_m)
    WHERE m IS NOT NULL AND length(g) >= {least})"""

    p = CANDIDATE
    bound = "CASE " + " ".join(f"WHEN regexp_matches(m, '{c}') THEN {h}" for _, c, h in CLASSES) + " END"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{",".join(kind(k, i) for i, k in enumerate(PATTERNS))},
base AS (SELECT * FROM assign UNION ALL SELECT * FROM access UNION ALL SELECT * FROM hex),
run_m AS (SELECT doc_id, generate_subscripts(string_split_regex(text, '{p}'), 1) AS i, unnest(string_split_regex(text, '{p}')) AS seg,
    unnest(list_concat(regexp_extract_all(text, '{p}', 0), [NULL])) AS m FROM d),
run AS (SELECT doc_id, e - length(m) AS s, e, m FROM (SELECT *, sum(length(seg) + coalesce(length(m), 0)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM run_m) WHERE m IS NOT NULL),
cut AS (SELECT DISTINCT r.doc_id, r.s, r.e, r.m FROM run r JOIN base b ON b.doc_id = r.doc_id AND b.s < r.e AND r.s < b.e),
pos AS (SELECT doc_id, s, m, unnest(range(CAST(s AS BIGINT), CAST(e AS BIGINT))) AS x FROM cut),
free AS (SELECT *, x - row_number() OVER (PARTITION BY doc_id, s ORDER BY x) AS island FROM pos WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = pos.doc_id AND b.s <= pos.x AND pos.x < b.e)),
piece AS (SELECT doc_id, min(x) AS s, max(x) + 1 AS e, substr(m, CAST(min(x) - s AS BIGINT) + 1, count(*)) AS m FROM free GROUP BY doc_id, s, m, island HAVING count(*) >= {WINDOW}
    UNION ALL SELECT doc_id, s, e, m FROM run ANTI JOIN cut USING (doc_id, s)),
can AS (SELECT * FROM piece WHERE NOT regexp_matches(m, '{ALLOWED}') AND (regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')
    OR regexp_matches(m, '^[+/=_-]*[A-Za-z]+[+/=_-]*$') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]'))),
win AS (SELECT doc_id, s, e, m, unnest(range(1, length(m) - {WINDOW} + 2)) AS i FROM can),
ent AS (SELECT doc_id, s, e, m, max(round(list_aggregate(string_split(substr(m, i, {WINDOW}), ''), 'entropy'), 6)) AS h FROM win GROUP BY ALL),
extra AS (SELECT doc_id, 'entropy' AS kind, 3 AS ord, s, e, m FROM ent WHERE h >= {bound}),
a AS (SELECT *, true AS is_base FROM base UNION ALL SELECT *, false FROM extra),
t AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg(kind || ':' || CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR), ',' ORDER BY s, ord) FILTER (WHERE is_base) AS b,
    string_agg(kind || ':' || CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR), ',' ORDER BY s, ord) AS spans FROM a GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN t ON d.doc_id = t.doc_id
"""
