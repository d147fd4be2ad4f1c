"""Quality classifier by attention-based multiple-instance learning (operator 6).

A document is a bag of passages of ``PASSAGE`` words; only the bag is labelled.
A passage's features are frequencies of pairs of character classes and of its
repeated words.  Each passage is encoded, h = tanh(W x + b); gated attention
e = w . (tanh(V h) * sigmoid(U h)) gives its weight by a softmax over the bag;
the weighted sum of the codes gives the score, sigmoid(c . z + d).

All weights are learned together from document labels, with every passage of at
most ``most`` labelled documents whose id does not hash to the held-out quarter.
Documents are drawn by a hash of their ids as long as all their passages fit into
``PASSAGES_LEARNED`` together; one that does not fit in what is left is not drawn.
So what reaches the driver is bounded by PASSAGES_LEARNED * 520 bytes.  Scores take every passage of the
whole text: a text longer than a slice is read in pieces of whole passages, whose
attention is added up.  Ids, languages, sources and labels are no inputs of a score.

A text without words is one empty passage.  Null texts count as empty.  Each
row gives one row, repeated rows and null ids included, without any shuffle; a
repeated id is learned from once.  Without labels of both kinds, or with empty
tables, there is no model and every score is 1.  Columns other than the id and
the text are not read and may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolspark.llm.common import plain, slices, tidied
from poolspark.llm.labelled import id_crc, sample
from poolspark.plans.shared import materialize

SLICE_BYTES = 2 << 20
PASSAGE, CLASSES = 64, 16
EXTRA = 4
#: Labelled documents, and passages of all of them together, that the model is learned from.
MOST_LABELLED, PASSAGES_LEARNED = 3000, 200_000
CODE, ATTENTION, EPOCHS, BATCH, RATE = 24, 12, 30, 128, 0.01


def _class_table() -> np.ndarray:
    """A class below CLASSES for each byte; 0 is white space."""
    table = np.full(256, 15, np.uint8)  # bytes of other scripts and accents
    table[:128] = 14
    table[[32, 9, 10, 11, 12, 13]] = 0
    for k, chars in enumerate(("aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "0123456789", ".", ",", "!", "?", "|", "*#$%&", "<>{}[]\\", "'\"-;:()"), 1):
        table[[ord(c) for c in chars]] = k
    return table


_TABLE = _class_table()


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and the number of passages of each text."""
    texts = plain(texts)
    m = len(texts)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.empty(0, np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + m + 1] if m else np.zeros(1, np.int64)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    cls = _TABLE[data]
    doc = np.repeat(np.arange(m, dtype=np.int64), np.diff(offsets))
    begin = cls != 0
    begin[1:] &= (cls[:-1] == 0) | (doc[1:] != doc[:-1])
    starts = np.flatnonzero(begin)
    word_doc = doc[starts]
    n_words = np.bincount(word_doc, minlength=m)
    bags = np.maximum(1, -(-n_words // PASSAGE))
    first = np.concatenate([[0], np.cumsum(bags)])
    word_from = np.concatenate([[0], np.cumsum(n_words)])
    word_passage = first[word_doc] + (np.arange(len(starts)) - word_from[word_doc]) // PASSAGE
    total = int(first[-1])
    x = np.zeros((total, CLASSES * CLASSES + EXTRA), np.float32)
    at = first[doc]
    if len(starts):
        word_of = np.cumsum(begin) - 1
        # white space before a text's first word belongs to its first passage
        at = np.where((word_of >= 0) & (word_doc[np.maximum(word_of, 0)] == doc), word_passage[np.maximum(word_of, 0)], at)
    same = at[1:] == at[:-1]
    pair = cls[:-1].astype(np.int64) * CLASSES + cls[1:]
    x[:, : CLASSES * CLASSES] = np.bincount((at[:-1] * CLASSES * CLASSES + pair)[same], minlength=total * CLASSES * CLASSES).reshape(total, -1)
    size = np.maximum(x.sum(1, keepdims=True), 1)
    x[:, : CLASSES * CLASSES] = np.sqrt(x[:, : CLASSES * CLASSES] / size)
    per = np.maximum(np.bincount(word_passage, minlength=total), 1)
    if len(starts):
        parts = pc.ascii_split_whitespace(texts).flatten()
        codes = parts.filter(pc.greater(pc.binary_length(parts), 0)).dictionary_encode()
        n_codes, codes = len(codes.dictionary), codes.indices.to_numpy().astype(np.int64)
        x[:, -4] = np.bincount(np.unique(word_passage * n_codes + codes) // n_codes, minlength=total) / per
        x[:, -3] = np.bincount(word_passage[1:][(codes[1:] == codes[:-1]) & (word_passage[1:] == word_passage[:-1])], minlength=total) / per
    x[:, -2], x[:, -1] = np.log1p(size[:, 0]) / 8, per / PASSAGE
    return x, bags


def pieces(text: str) -> list[str]:
    """A text cut into parts of about SLICE_BYTES that hold whole passages, the last one excepted."""
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) <= SLICE_BYTES:
        return [text]
    blank = _TABLE[data] == 0
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])[PASSAGE::PASSAGE]
    at = np.searchsorted(starts, np.arange(SLICE_BYTES, len(data), SLICE_BYTES))
    cuts = [0, *np.unique(starts[at[at < len(starts)]]).tolist(), len(data)]
    return [data[a:b].tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class AttentionModel:
    """Weights by name; ``score`` works on passages in the order of their documents."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def new(cls, features: int, seed: int = 7) -> AttentionModel:
        r = np.random.default_rng(seed)
        draw = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        return cls({"W": draw(features, CODE), "b": np.zeros(CODE, np.float32), "V": draw(CODE, ATTENTION), "U": draw(CODE, ATTENTION), "w": draw(ATTENTION), "c": draw(CODE), "d": np.zeros(1, np.float32)})

    def forward(self, x: np.ndarray, bags: np.ndarray):
        w, starts, of = self.w, np.concatenate([[0], np.cumsum(bags)[:-1]]), np.repeat(np.arange(len(bags)), bags)
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        e = (t * g) @ w["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[of])
        a = e / np.add.reduceat(e, starts)[of]
        z = np.add.reduceat(a[:, None] * h, starts)
        return h, t, g, a, z, _sigmoid(z @ w["c"] + w["d"]), starts, of

    def score(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        return self.forward((x - self.w["mean"]) / self.w["std"], bags)[5]

    def score_pieces(self, parts) -> float:
        """The score of one document whose passages come in several arrays."""
        w, top, total, z = self.w, -np.inf, 0.0, np.zeros(CODE)
        for x in parts:
            h = np.tanh((x - w["mean"]) / w["std"] @ w["W"] + w["b"])
            e = (np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"])) @ w["w"]
            most = max(top, float(e.max()))
            a, shrink = np.exp(e - most), np.exp(top - most)
            top, total, z = most, total * shrink + a.sum(), z * shrink + a @ h
        return float(_sigmoid(z / total @ w["c"] + w["d"])[0])

    def gradients(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        h, t, g, a, z, p, starts, of = self.forward(x, bags)
        ds = (p - y).astype(np.float32) / len(y)
        dz = (ds[:, None] * w["c"])[of]
        da = (h * dz).sum(1)
        de = a * (da - np.add.reduceat(a * da, starts)[of])
        dt, dg = np.outer(de, w["w"]) * g * (1 - t * t), np.outer(de, w["w"]) * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ de, "c": z.T @ ds, "d": ds.sum(keepdims=True)}


def train(x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> AttentionModel:
    """Adam over batches of documents."""
    model = AttentionModel.new(x.shape[1], seed)
    mean, std = x.mean(0), np.maximum(x.std(0), 0.02)
    x = np.subtract(x, mean, dtype=np.float32)
    x /= std.astype(np.float32)
    starts = np.concatenate([[0], np.cumsum(bags)])
    rng, step = np.random.default_rng(seed), 0
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), BATCH):
            own, step = order[i : i + BATCH], step + 1
            rows = np.concatenate([np.arange(starts[k], starts[k + 1]) for k in own])
            for k, g in model.gradients(x[rows], bags[own], y[own]).items():
                g = g + 1e-4 * model.w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.w[k] = (model.w[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    model.w |= {"mean": mean.astype(np.float32), "std": std.astype(np.float32)}
    return model


@tidied
def _features(most: int, seen):
    """The number of passages of each text, and all their features unless they are more than ``most``."""
    for batch in seen:
        texts = batch.column("text")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, SLICE_BYTES):
            if b - a == 1 and sizes[a] > SLICE_BYTES:
                n, held = 0, []
                for p in pieces(texts[a].as_py()):
                    x, bags = passages(pa.array([p]))
                    n += int(bags[0])
                    held = [*held, x.astype("<f2").tobytes()] if n <= most else []
                counts, rows = [n], [b"".join(held) if n <= most else None]
            else:
                x, bags = passages(texts.slice(a, b - a))
                starts, counts = np.concatenate([[0], np.cumsum(bags)]), bags
                rows = [x[i:j].astype("<f2").tobytes() if j - i <= most else None for i, j in zip(starts[:-1], starts[1:], strict=True)]
            rest = {c: batch.column(c).slice(a, b - a) for c in ("doc_id", "label")}
            yield pa.record_batch(rest | {"n": pa.array(np.asarray(counts, np.int64)), "x": pa.array(rows, pa.binary())})


def learned(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, passages_learned: int = PASSAGES_LEARNED, **cols: str) -> DataFrame:
    """(doc_id, label, n, x): all passages of the documents that a model is learned from, outside the held-out quarter."""
    own = sample(docs, labels, most, where="crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2", **cols)
    held = materialize(own.mapInArrow(lambda seen: _features(passages_learned, seen), "doc_id long, label int, n long, x binary"), "passages")
    drawn, left = [], passages_learned
    for r in held.select("doc_id", "n").orderBy(F.xxhash64("doc_id"), "doc_id").collect():  # ``most`` rows at most
        if r["n"] <= left:
            drawn.append((r["doc_id"],))
            left -= r["n"]
    return held.join(F.broadcast(held.sparkSession.createDataFrame(drawn, "doc_id long")), "doc_id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED, passages_learned: int = PASSAGES_LEARNED, **cols: str) -> AttentionModel | None:
    """A model of quality from labels outside the held-out quarter; None without labels of both kinds."""
    seen = learned(docs, labels, most, passages_learned, **cols).toPandas().sort_values("doc_id")
    y = seen["label"].to_numpy(np.float32)
    if not len(y) or y.min() == y.max():
        return None
    width = CLASSES * CLASSES + EXTRA
    x = np.frombuffer(b"".join(seen["x"]), "<f2").reshape(-1, width).astype(np.float32)
    return train(x, seen["n"].to_numpy(), y)


@tidied
def _score(weights: dict[str, np.ndarray] | None, text_col: str, name: str, seen):
    model = AttentionModel(weights) if weights else None
    for batch in seen:
        texts = batch.column(text_col)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, SLICE_BYTES):
            if model is None:
                p = np.full(b - a, 1.0)
            elif b - a == 1 and sizes[a] > SLICE_BYTES:
                p = np.array([model.score_pieces(passages(pa.array([t]))[0] for t in pieces(texts[a].as_py()))])
            else:
                p = model.score(*passages(texts.slice(a, b - a)))
            rest = {n: batch.column(n).slice(a, b - a) for n in batch.schema.names}
            yield pa.record_batch(rest | {name: pa.array(p.astype(np.float64))})


def with_score(docs: DataFrame, model: AttentionModel | None, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``, its score; 1 for all if there was nothing to learn from."""
    weights = model.w if model else None
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(lambda seen: _score(weights, text_col, name, seen), schema)


def judge(docs: DataFrame, model: AttentionModel | None, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = with_score(own, model).drop("text")
    return scored.select("doc_id", (id_crc(F.col("doc_id")) % 4 == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
