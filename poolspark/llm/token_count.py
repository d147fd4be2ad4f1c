"""Token counts with a whole-token shortcut (operator 2).

Before any document is read, the driver encodes every vocabulary string that can
end a word by itself, once; those that come out as one id are *proven* and sent
to the workers, at most as many as the vocabulary has.  A document's words that
are proven count one each without merging; only the rest is merged, each
distinct word of a slice of texts once.

Null and empty texts have no tokens and no bytes.  Each input row gives one
output row, repeated rows and null ids included; an empty table gives no rows.
Texts are taken whole, in slices of some megabytes, and one longer than that
stands alone.  Columns other than the id and the text are not read and may have
any name.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolspark.llm.bpe import SLICE_BYTES, _byte_chars, encoder, splitter
from poolspark.llm.common import slices, tidied

#: Lengths kept of merged words in a worker; the store is emptied when it is full.
KEPT_WORDS = 1 << 17


@functools.cache
def whole_tokens(path: str) -> pa.Array:
    """Words that the vocabulary proves to be a single token; no longer than the vocabulary."""
    enc = encoder(path)
    back = {c: b for b, c in _byte_chars().items()}
    words = []
    for piece in enc.pieces.values():
        body = piece.removesuffix("</w>")
        if body != piece and all(c in back for c in body):
            try:
                words.append(bytes(back[c] for c in body).decode())
            except UnicodeDecodeError:
                continue
    words = [w for w in words if w]
    proven = [w for w, ids in zip(words, enc(words), strict=True) if len(ids) == 1]
    return pa.array(sorted({*proven, *enc.special}), pa.large_string())


@tidied
def _count(path: str, whole: pa.Array, limit: int, seen):
    split, enc, kept = splitter(path), encoder(path), {}
    for batch in seen:
        texts = batch.column(1)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in slices(sizes, SLICE_BYTES):
            words, counts = split(texts.slice(a, b - a))
            coded = words.dictionary_encode()
            lens = np.ones(len(coded.dictionary), np.int64)
            rest = np.flatnonzero(pc.is_null(pc.index_in(coded.dictionary, value_set=whole)).to_numpy(zero_copy_only=False))
            own = coded.dictionary.take(pa.array(rest)).to_pylist()
            todo = [w for w in own if w not in kept]
            if len(kept) + len(todo) > KEPT_WORDS:
                kept.clear()
                todo = own
            kept.update(zip(todo, map(len, enc(todo)), strict=True))
            lens[rest] = [kept[w] for w in own]
            run = np.concatenate([[0], np.cumsum(lens[coded.indices.to_numpy()])]) if len(words) else np.zeros(1, np.int64)
            tokens = np.diff(np.concatenate([[0], run[np.cumsum(counts)]]))
            yield pa.record_batch({"doc_id": batch.column(0).slice(a, b - a), "n_bytes": pa.array(sizes[a:b]), "n_tokens": pa.array(tokens, pa.int64()), "over_limit": pa.array(tokens > limit)})


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    proven = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))
    return own.mapInArrow(lambda seen: _count(path, proven.value, limit, seen), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
