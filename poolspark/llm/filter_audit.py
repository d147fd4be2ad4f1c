"""Audit of how text filters interact (operator 13).

A worker reads the Arrow buffers of a slice of texts: a table of byte classes
and prefix sums give words, capitals, symbols and code points of every text;
words are hashed eight bytes at a time, sorted by text and hash, and equal
neighbours are compared byte by byte, so the number of distinct words is exact
whatever the hash does.  What leaves the worker is a row of fixed size: id,
part, a mask of the failed filters and a digest of the text.  Rows are counted
by digest, where every id but the smallest fails filter E, then by part and
mask.  A part has at most 32 masks, and all 120 orders follow from them.

A null text counts as empty and a null part as the empty string.  Rows with a
null id have no smaller id and are none, so they pass E; of rows that repeat the
smallest id with the same text all pass.  A document is good or toxic if any of
its labels says so; labels without an id are left out.  An empty table has no
parts and gives no rows.  Texts are taken whole; one longer than a slice is
counted in pieces that end with a word and whose distinct words are put together.
Columns other than those named are not read and may have any name.
"""

from __future__ import annotations

import hashlib
import itertools
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poolspark.llm.common import plain, slices, tidied

SLICE_BYTES = 2 << 20
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
#: Words longer than this many bytes are hashed and compared one by one.
LONG_WORD = 128
_SPACE, _CAPITAL, _SYMBOL, _INNER = 1, 2, 4, 8


def _classes() -> np.ndarray:
    """Flags of each byte; an inner byte continues a code point."""
    table = np.zeros(256, np.uint8)
    table[[32, 9, 10, 11, 12, 13]] = _SPACE
    table[65:91] = _CAPITAL
    table[[ord(c) for c in "#$%&*|"]] = _SYMBOL
    table[128:192] = _INNER
    return table


_TABLE = _classes()


def _windows(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each place as one number; ``data`` ends with eight bytes to spare."""
    seen = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))[at]
    cut = (np.maximum(8 - left, 0) * 8).astype(np.uint64)
    return (seen << cut) >> cut


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    h = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    own = np.flatnonzero(size <= LONG_WORD)
    k = 0
    while len(own):
        x = (h[own] ^ _windows(data, start[own] + k, size[own] - k)) * np.uint64(0xFF51AFD7ED558CCD)
        h[own] = x ^ (x >> np.uint64(32))
        k += 8
        own = own[size[own] > k]
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : start[i] + size[i]], digest_size=8).digest(), "little")
    return h


def _same(data: np.ndarray, start: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words ``a`` and ``b`` (places in ``start``) have the same bytes, pair by pair."""
    same = size[a] == size[b]
    left, k = np.flatnonzero(same & (size[a] <= LONG_WORD)), 0
    while len(left):
        i, j = a[left], b[left]
        same[left] = _windows(data, start[i] + k, size[i] - k) == _windows(data, start[j] + k, size[j] - k)
        k += 8
        left = left[same[left] & (size[i] > k)]
    for p in np.flatnonzero(same & (size[a] > LONG_WORD)):
        i, j = start[a[p]], start[b[p]]
        same[p] = bytes(data[i : i + size[a[p]]]) == bytes(data[j : j + size[a[p]]])
    return same


def distinct_words(data: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of one word of each kind in each text; words are given by text, first byte and length."""
    if not len(start):
        return np.empty(0, np.int64)
    h = _hashes(data, start, size)
    order = np.lexsort((h, text))
    first = np.ones(len(order), bool)
    first[1:] = (h[order[1:]] != h[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
    pair = np.flatnonzero(~first)
    if len(pair):
        odd = pair[~_same(data, start, size, order[pair - 1], order[pair])]
        runs = np.cumsum(first) - 1
        for r in np.unique(runs[odd]):  # different words share a hash: told apart by their bytes
            place, seen = np.flatnonzero(runs == r), set()
            for p in place:
                i = order[p]
                word = bytes(data[start[i] : start[i] + size[i]])
                first[p] = word not in seen
                seen.add(word)
    return order[first]


def _words(cls: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and lengths of the words; ``bounds`` are the first bytes of the texts."""
    word = (cls & _SPACE) == 0
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    inner = bounds[(bounds > 0) & (bounds < len(cls))]
    begin[inner] = word[inner]
    end[inner - 1] = word[inner - 1]
    start = np.flatnonzero(begin)
    return start, np.flatnonzero(end) - start + 1


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """words, capitals, symbols, points and distinct words of each text of a buffer with ``offsets`` from 0."""
    m = len(offsets) - 1
    cls = _TABLE[data]
    start, size = _words(cls, offsets[:-1])

    def total(flag: int) -> np.ndarray:
        sums = np.zeros(len(cls) + 1, np.int64)
        np.cumsum((cls & flag) != 0, out=sums[1:])
        return np.diff(sums[offsets])

    of = np.searchsorted(offsets, start, "right") - 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    kinds = distinct_words(padded, of, start, size)
    return {
        "words": np.bincount(of, minlength=m), "capitals": total(_CAPITAL), "symbols": total(_SYMBOL),
        "points": np.diff(offsets) - total(_INNER), "distinct": np.bincount(of[kinds], minlength=m),
    }


def counts_of_long(data: np.ndarray) -> dict[str, np.ndarray]:
    """The same of a single text of any length, a piece of it at a time."""
    out = dict.fromkeys(("words", "capitals", "symbols", "points"), 0)
    starts, sizes, at, n = [], [], 0, len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    while at < n:
        stop = min(at + SLICE_BYTES, n)
        while stop < n:  # up to the next white space
            gap = np.flatnonzero(_TABLE[data[stop : stop + SLICE_BYTES]] & _SPACE)
            stop = stop + int(gap[0]) if len(gap) else min(stop + SLICE_BYTES, n)
            if len(gap):
                break
        cls = _TABLE[data[at:stop]]
        start, size = _words(cls, np.zeros(1, np.int64))
        out["words"] += len(start)
        for name, flag in (("capitals", _CAPITAL), ("symbols", _SYMBOL)):
            out[name] += int(np.count_nonzero(cls & flag))
        out["points"] += len(cls) - int(np.count_nonzero(cls & _INNER))
        kinds = distinct_words(padded, np.zeros(len(start), np.int64), start + at, size)
        starts.append(start[kinds] + at)
        sizes.append(size[kinds])
        at = stop
    start, size = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (starts, sizes))
    out["distinct"] = len(distinct_words(padded, np.zeros(len(start), np.int64), start, size))
    return {k: np.array([v]) for k, v in out.items()}


def _failed(c: dict[str, np.ndarray]) -> np.ndarray:
    """The mask of filters A to D."""
    a = c["words"] < MIN_WORDS
    b = 100 * c["distinct"] < DISTINCT_PERCENT * c["words"]
    upper = 100 * c["capitals"] > CAPITAL_PERCENT * c["points"]
    return (a + 2 * b + 4 * upper + 8 * (c["symbols"] > 0)).astype(np.int32)


@tidied
def _masks(seen):
    for batch in seen:
        texts = batch.column("text")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in slices(sizes, SLICE_BYTES):
            own = plain(texts.slice(a, b - a))
            offsets = np.frombuffer(own.buffers()[1], np.int64)[own.offset : own.offset + len(own) + 1]
            data = np.frombuffer(own.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if own.buffers()[2] is not None else np.empty(0, np.uint8)
            got = counts_of_long(data) if b - a == 1 and sizes[a] > SLICE_BYTES else counts(data, offsets - offsets[0])
            rest = {n: batch.column(n).slice(a, b - a) for n in ("doc_id", "part", "digest")}
            yield pa.record_batch(rest | {"mask": pa.array(_failed(got))})


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, digest, mask): the filters of A to D that each document fails, as bits from A."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    return own.mapInArrow(_masks, "doc_id long, part string, digest binary, mask int")


def mask_counts(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by all failed filters, E among them.

    Text copies meet only as counts: rows are counted by id where the labels were joined, then by digest, part and mask.
    """
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id IS NOT NULL")
    per_doc = named.groupBy("doc_id").agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    keys = ["digest", "part", "mask", "good", "toxic"]
    rows = judged.join(per_doc, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    by_id = rows.groupBy("doc_id", *keys).agg(F.count("*").alias("n"))
    known = F.col("doc_id").isNotNull()
    per_text = by_id.groupBy(*keys).agg(F.sum("n").alias("n"), F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nameless"))
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    passed = per_text.withColumn("kept", F.col("nameless") + F.coalesce(F.when(F.col("first.doc_id") == least, F.col("first.n")), F.lit(0)))
    both = F.array(F.struct("mask", F.col("kept").alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(16)).alias("mask"), (F.col("n") - F.col("kept")).alias("n")))
    split = passed.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    of = lambda c: F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0))
    return split.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good").alias("good"), of("toxic").alias("toxic"))


def _orders() -> str:
    """All steps of all orders as JSON: the filter's bit and the bits of those before it."""
    out = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, f in enumerate(order, 1):
            bit = 1 << FILTERS.index(f)
            out.append({"filter_order": "".join(order), "step": step, "own": bit, "before": before})
            before |= bit
    return json.dumps(out)


def report(by_mask: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included."""
    whole = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("xs"))  # 32 masks at most
    steps = whole.select("part", "xs", F.inline(F.from_json(F.lit(_orders()), "array<struct<filter_order string, step int, own int, before int>>")))

    def total(where: str, what: str = "x.n"):
        return F.expr(f"aggregate(xs, 0L, (s, x) -> s + IF({where}, {what}, 0L))")

    fails, first = "x.mask & own <> 0", "x.mask & before = 0"
    return steps.select(
        "part", "filter_order", "step", total(f"{first} AND x.mask & own = 0").alias("kept"), total(f"{fails} AND {first}").alias("removed"), total(f"{fails} AND x.mask & before <> 0").alias("redundant"),
        total("x.mask = own").alias("unique_fails"), total(f"{fails} AND {first}", "x.good").alias("good_lost"), total(f"{fails} AND {first}", "x.toxic").alias("toxic_lost"),
        total(fails, "x.n * (120 DIV bit_count(x.mask))").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return report(mask_counts(masks(docs, id_col, text_col, part_col), labels))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
e AS (SELECT text, min(doc_id) AS lo FROM t GROUP BY text),
m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws), 100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 5 * length(w.text),
     regexp_matches(w.text, '[#$%&*|]'), coalesce(w.doc_id > e.lo, false)] AS f
  FROM w JOIN e ON w.text = e.text LEFT JOIN l ON w.doc_id = l.doc_id),
k AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS ord FROM k a, k b, k c, k d, k e
  WHERE a.i <> b.i AND a.i <> c.i AND a.i <> d.i AND a.i <> e.i AND b.i <> c.i AND b.i <> d.i AND b.i <> e.i AND c.i <> d.i AND c.i <> e.i AND d.i <> e.i),
s AS (SELECT ord, k.i AS step, ord[k.i] AS own, ord[1:k.i - 1] AS before FROM o, k),
g AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, f),
r AS (SELECT part, ord, step, own, f[own] AS fails, len(list_filter(before, lambda x: f[x])) > 0 AS gone, len(list_filter(f, lambda x: x)) AS fs, n, good, toxic FROM g, s),
x AS (
  SELECT part, array_to_string(list_transform(ord, lambda x: substr('ABCDE', x, 1)), '') AS filter_order, step, own,
    coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (fails AND fs = 1), 0) AS unique_fails, coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost
  FROM r GROUP BY part, ord, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM x
"""
