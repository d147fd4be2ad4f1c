"""Quality rules as a learned decision list (operator 5).

Statistics of every whole text are counted first.  Texts that fail the base
rules are not kept.  For the others, sequential covering learns from labelled
statistics when a text is bad: a rule grows by the threshold that gains most
(FOIL gain) on two thirds of the rows, is pruned from its end on the last
third, and is taken if it is right more often than ``PRECISION`` there; the
rows it covers are removed and the next rule is learned.  The list becomes one
ordered Spark conditional expression; a text that no rule covers is kept.

Learned from at most ``most`` labelled documents, a repeated id once; without
labels of both kinds, or without any rows, the list is empty.  Null or empty
texts have all counts zero and fail the base rules.  Each row gives one row,
repeated rows and null ids included; an empty table gives no rows.  Texts are
counted whole, in slices of some megabytes, and one longer than that stands
alone.  Columns other than the id and the text are not read and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolspark.llm.common import plain, slices, tidied
from poolspark.llm.labelled import sample

SLICE_BYTES = 2 << 20
MOST_LABELLED = 4000
PRECISION, MAX_RULES, MAX_TERMS = 0.6, 12, 4
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs", "n_upper", "n_digits")
#: Ratios that rules may test: name, numerator, denominator.
RATIOS = (
    ("word_length", "word_chars", "n_words"), ("symbols", "n_symbols", "n_words"), ("dup_lines", "n_dup_lines", "n_lines"),
    ("repeats", "n_repeat_words", "n_words"), ("bangs", "n_bangs", "n_words"), ("upper", "n_upper", "word_chars"),
    ("digits", "n_digits", "word_chars"), ("line_words", "n_words", "n_lines"),
)


def _windows(codes: np.ndarray, docs: np.ndarray, n_docs: int) -> np.ndarray:
    """Number of words of each text in three-word windows that its text holds twice or more."""
    if len(codes) < 3:
        return np.zeros(n_docs, np.int64)
    d, pairs = int(codes.max()) + 1, codes[:-1].astype(np.int64)
    _, pair = np.unique(pairs * d + codes[1:], return_inverse=True)
    start = np.flatnonzero(docs[:-2] == docs[2:])
    if int(pair.max() + 1) * d * n_docs < 2**62:
        key = (docs[start] * int(pair.max() + 1) + pair[start]) * d + codes[start + 2]
    else:  # too many different words for one number: name the windows first
        _, tri = np.unique(np.stack([pair[start], codes[start + 2]]), axis=1, return_inverse=True)
        key = docs[start] * (int(tri.max(initial=0)) + 1) + tri.ravel()
    _, where, n = np.unique(key, return_inverse=True, return_counts=True)
    own = start[n[where] >= 2]
    hit = np.zeros(len(codes), bool)
    for k in range(3):
        hit[own + k] = True
    return np.bincount(docs[hit], minlength=n_docs)


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of each text."""
    texts = plain(texts)
    m = len(texts)
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    keep = pc.greater(pc.binary_length(flat), 0)
    docs = np.repeat(np.arange(m), np.diff(parts.offsets.to_numpy()))[keep.to_numpy(zero_copy_only=False)]
    words = flat.filter(keep)
    lines = pc.split_pattern(texts, "\n")
    line_docs = np.repeat(np.arange(m), np.diff(lines.offsets.to_numpy()))
    full = pc.match_substring_regex(lines.flatten(), r"[^\x{20}\x{9}-\x{D}]")
    line_docs = line_docs[full.to_numpy(zero_copy_only=False)]
    coded = lines.flatten().filter(full).dictionary_encode()
    distinct = np.unique(line_docs * (len(coded.dictionary) + 1) + coded.indices.to_numpy()) // (len(coded.dictionary) + 1)
    n_lines = np.bincount(line_docs, minlength=m)
    count = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(np.int64)
    return {
        "n_words": np.bincount(docs, minlength=m),
        "word_chars": np.bincount(docs, weights=pc.utf8_length(words).to_numpy(zero_copy_only=False), minlength=m).astype(np.int64),
        "n_symbols": count("[#*$%&|<>]"),
        "n_dup_lines": n_lines - np.bincount(distinct, minlength=m),
        "n_repeat_words": _windows(words.dictionary_encode().indices.to_numpy(), docs, m),
        "n_lines": n_lines,
        "n_bangs": count("!"),
        "n_upper": count(r"\p{Lu}"),
        "n_digits": count("[0-9]"),
    }


@tidied
def _count(seen):
    for batch in seen:
        texts = batch.column("text")
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, SLICE_BYTES):
            own = text_counts(texts.slice(a, b - a))
            rest = {n: batch.column(n).slice(a, b - a) for n in batch.schema.names if n != "text"}
            yield pa.record_batch(rest | {k: pa.array(own[k].astype(np.int64)) for k in COUNTS})


def counted(docs: DataFrame) -> DataFrame:
    """COUNTS beside the columns of ``docs`` (doc_id, text[, label])."""
    kept = ", ".join(f"{n} {t}" for n, t in docs.dtypes if n != "text")
    return docs.mapInArrow(_count, kept + "".join(f", {c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


@dataclass(frozen=True)
class Term:
    ratio: str
    above: bool
    bound: float

    def holds(self, x: pd.DataFrame) -> np.ndarray:
        v = x[self.ratio].to_numpy()
        return v > self.bound if self.above else v <= self.bound

    def column(self) -> Column:
        top, under = next((F.col(a), F.col(b)) for n, a, b in RATIOS if n == self.ratio)
        value = top / F.greatest(under, F.lit(1))
        return value > self.bound if self.above else value <= self.bound

    def __str__(self) -> str:
        return f"{self.ratio} {'>' if self.above else '<='} {self.bound:.4g}"


def ratios(x: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({n: x[a] / np.maximum(x[b], 1) for n, a, b in RATIOS})


def _covers(rule: list[Term], x: pd.DataFrame) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in rule:
        out &= t.holds(x)
    return out


def _best_term(x: pd.DataFrame, bad: np.ndarray) -> tuple[float, Term | None]:
    """The threshold of the highest FOIL gain: p * (log2 of the new precision - log2 of the old)."""
    best, base = (0.0, None), np.log2(bad.mean())
    for name, *_ in RATIOS:
        v = x[name].to_numpy()
        order = np.argsort(v, kind="stable")
        v, y = v[order], bad[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        below, n = np.cumsum(y)[cut], cut + 1
        for above, p, m in ((False, below, n), (True, y.sum() - below, len(y) - n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / m) - base), 0)
            k = int(np.argmax(gain))
            if gain[k] > best[0] + 1e-9:
                best = float(gain[k]), Term(name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return best


def learn(x: pd.DataFrame, bad: np.ndarray) -> list[list[Term]]:
    """Ordered rules, each a conjunction of thresholds, for rows of ratios that are bad."""
    rules: list[list[Term]] = []
    x, bad = x.reset_index(drop=True), np.asarray(bad, bool)
    while len(rules) < MAX_RULES and bad.sum() >= 5:
        prune = np.arange(len(x)) % 3 == 2
        gx, gy, px, py = x[~prune], bad[~prune], x[prune], bad[prune]
        rule: list[Term] = []
        while len(rule) < MAX_TERMS and 0 < gy.sum() < len(gy):
            _, term = _best_term(gx, gy)
            if term is None:
                break
            rule.append(term)
            own = term.holds(gx)
            gx, gy = gx[own], gy[own]

        def worth(r: list[Term]) -> float:
            own = _covers(r, px)
            p = int(py[own].sum())
            return (2 * p - own.sum()) / own.sum() if own.any() else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule.pop()
        own = _covers(rule, px) if rule else np.zeros(len(px), bool)
        if not own.any() or py[own].mean() < PRECISION:
            break
        rules.append(rule)
        left = ~_covers(rule, x)
        x, bad = x[left].reset_index(drop=True), bad[left]
    return rules


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, **cols: str) -> list[list[Term]]:
    """Rules for texts whose label is 0, from at most ``most`` labelled documents."""
    own = counted(sample(docs, labels, most, **cols)).where(~base_failed()).toPandas().sort_values("doc_id")
    bad = own["label"].to_numpy() == 0
    return learn(ratios(own), bad) if bad.any() and not bad.all() else []


def rejecting_rule(rules: list[list[Term]]) -> Column:
    """The text of the first rule that covers a row, else null: the decision list as a conditional expression."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        every = rule[0].column()
        for t in rule[1:]:
            every &= t.column()
        out = F.when(every, " and ".join(map(str, rule))).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[list[Term]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base counts, base_failed, kept, rule (the one that rejects)."""
    own = counted(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    own = own.withColumn("base_failed", base_failed()).withColumn("rule", F.when(~F.col("base_failed"), rejecting_rule(rules)))
    return own.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")
