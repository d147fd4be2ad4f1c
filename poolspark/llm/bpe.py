"""BPE encoding and decoding through a table of distinct words (operator 1).

1. *Split.*  Texts are cut into the tokenizer's words.  A chunk of up to
   ``CHUNK_BYTES`` of text becomes one row: its distinct words and, for every
   document, the positions of its words in that list.
2. *Encode.*  The chunks' word lists are dealt into ``BUCKETS`` buckets by a hash of
   the word, so each distinct word meets all its chunks in one place and is merged
   once.  A word occurs at most once in a chunk's list, so even the most frequent
   word comes once from each chunk and no partition grows with it.  The number of
   buckets is fixed, so rows grow with the chunks alone.  A worker keeps
   ``KNOWN_WORDS`` merged words of a bucket at a time; a bucket with more forgets them
   and merges some again, which costs time and changes nothing.
3. *Join back.*  The ids return to their chunk, whose rows lie in a bucketed table
   and do not move again, and are gathered by position.
4. *Decode.*  Ids are joined with the vocabulary's pieces by id; the pieces
   are joined by spaces, which is what the library does without a decoder.  The
   id-to-piece table is the vocabulary, a file of fixed size that every worker
   reads, so the join is a gather from an array.

Null and empty texts have no tokens.  Every input row gives one output row,
repeated rows and null ids included; columns other than the id and the text are
not read and may have any name.  An empty table gives an empty result.  Texts are
taken whole; one longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolspark.llm.common import plain, slices, tidied
from poolspark.plans.shared import materialize_bucketed

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CHUNK_BYTES = 16 << 20
SLICE_BYTES, SLICE_WORDS = 2 << 20, 1 << 18
#: Parts of the distinct words, and merged words of one that a worker keeps.
BUCKETS, KNOWN_WORDS = 256, 1 << 20

# Below U+0300 these are the tokenizer's white space and word classes.
_WS = "\t\n\x0b\x0c\r \x85\xa0"
_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\pL+|\pN|[^\t-\r \x{85}\x{A0}\pL\pN]+"
#: Texts with other characters, or with special strings, take the library's own way.
_SLOW = r"[^\x{0}-\x{12F}\x{131}-\x{2FF}]|<\|"


class WordSplitter:
    """Words of a text exactly as the tokenizer's normaliser and pre-tokenizer make them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        self.norm, self.pre = tok.normalizer, tok.pre_tokenizer
        spec = json.load(open(path, encoding="utf-8"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.back = {c: b for b, c in _byte_chars().items()}

    def slow(self, text: str) -> list[str]:
        out = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(part)
            elif part:
                words = self.pre.pre_tokenize_str(self.norm.normalize_str(part))
                out += [bytes(self.back[c] for c in w).decode() for w, _ in words]
        return out

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All words, and the number of words of each text."""
        texts = plain(texts)
        slow = pc.match_substring_regex(texts, _SLOW).to_numpy(zero_copy_only=False)
        fast = pc.if_else(pa.array(slow), pa.scalar("", pa.large_string()), texts)
        marked = pc.replace_substring_regex(pc.utf8_lower(fast), _WORD, "\\0\n")
        parts = pc.split_pattern(marked, "\n")
        flat = pc.utf8_trim(parts.flatten(), _WS)
        keep = pc.greater(pc.binary_length(flat), 0)
        ends = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
        at = parts.offsets.to_numpy()
        counts = np.diff(ends[at - at[0]])
        words = flat.filter(keep)
        if slow.any():
            pieces, done, edges = [], 0, np.concatenate([[0], np.cumsum(counts)])
            for i in np.flatnonzero(slow):
                own = self.slow(texts[int(i)].as_py())
                pieces += [words.slice(edges[done], edges[i] - edges[done]), pa.array(own, pa.large_string())]
                counts[i], done = len(own), i + 1
            pieces.append(words.slice(edges[done]))
            words = pa.concat_arrays(pieces)
        return words, counts


@functools.cache
def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.cache
def splitter(path: str) -> WordSplitter:
    return WordSplitter(path)


class WordEncoder:
    """Ids of single words: the vocabulary's merges without any normalising or splitting."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = {i: p for p, i in spec["model"]["vocab"].items()} | {i: p for p, i in self.special.items()}
        spec |= {"normalizer": None, "added_tokens": [], "truncation": None, "padding": None}
        spec["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.tok = Tokenizer.from_str(json.dumps(spec))

    def __call__(self, words: list[str]) -> list[list[int]]:
        ids = [e.ids for e in self.tok.encode_batch(words, add_special_tokens=False)]
        for i, w in enumerate(words):
            if w in self.special:
                ids[i] = [self.special[w]]
        return ids


@functools.cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@functools.cache
def vocabulary(path: str) -> pa.Array:
    """Piece by id: the id-to-piece table, as long as the vocabulary."""
    pieces = encoder(path).pieces
    return pa.array([pieces.get(i, "") for i in range(max(pieces) + 1)], pa.large_string())


def _pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed: bytes of a place stand together."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


#: A chunk has one row with its documents and codes (bucket -1) and one for each bucket of its words.
CHUNK_SCHEMA = "chunk_id long, bucket int, docs array<long>, counts array<long>, codes binary, n int, pos binary, words binary, size long"
_CHUNK_ARROW = pa.schema([("chunk_id", pa.int64()), ("bucket", pa.int32()), ("docs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("codes", pa.binary()), ("n", pa.int32()), ("pos", pa.binary()), ("words", pa.binary()), ("size", pa.int64())])


@tidied
def _chunks(path: str, buckets: int, seen):
    """Rows of CHUNK_SCHEMA from batches of (doc_id, text)."""
    from pandas.util import hash_array
    from pyspark import TaskContext

    split, part, seq = splitter(path), TaskContext.get().partitionId(), 0
    docs, counts, words, held = [], [], [], 0

    def out():
        nonlocal docs, counts, words, held, seq
        coded = pa.concat_arrays(words).dictionary_encode()
        codes, n = coded.indices.to_numpy(), len(coded.dictionary)
        order = np.argsort(-np.bincount(codes, minlength=n), kind="stable")  # frequent words get small codes
        rank = np.empty(n, np.uint32)
        rank[order] = np.arange(n, dtype=np.uint32)
        uid = (part << 32) + seq
        rows = [{"chunk_id": uid, "bucket": -1, "docs": pa.concat_arrays(docs).to_pylist(), "counts": np.concatenate(counts), "codes": _pack(rank[codes])}]
        own = coded.dictionary.take(pa.array(order)).to_numpy(zero_copy_only=False)
        dealt = (hash_array(own, categorize=False) % buckets).astype(np.int32) if n else np.empty(0, np.int32)
        by = np.argsort(dealt, kind="stable")
        for pos in np.split(by, np.flatnonzero(np.diff(dealt[by])) + 1) if n else []:
            text = "\n".join(own[pos]).encode()  # no word holds white space
            rows.append({"chunk_id": uid, "bucket": int(dealt[pos[0]]), "n": len(pos), "pos": _pack(np.diff(pos, prepend=0)), "words": pa.compress(text, "zstd", asbytes=True), "size": len(text)})
        docs, counts, words, held, seq = [], [], [], 0, seq + 1
        return pa.RecordBatch.from_pylist(rows, _CHUNK_ARROW)

    for batch in seen:
        ids, texts = batch.column(0), batch.column(1)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, SLICE_BYTES):
            n = int(sizes[a:b].sum())
            if held and held + n > CHUNK_BYTES:
                yield out()
            w, c = split(texts.slice(a, b - a))
            docs.append(ids.slice(a, b - a))
            counts.append(c)
            words.append(w)
            held += n
    if docs:
        yield out()


IDS_SCHEMA = "chunk_id long, n int, pos binary, lens binary, ids binary, total long"
_IDS_ARROW = pa.schema([("chunk_id", pa.int64()), ("n", pa.int32()), ("pos", pa.binary()), ("lens", pa.binary()), ("ids", pa.binary()), ("total", pa.int64())])


@tidied
def _encode_words(path: str, seen):
    """(bucket, chunk_id, n, pos, words, size) by bucket -> IDS_SCHEMA; each distinct word of a bucket is merged once."""
    enc, at, known = encoder(path), None, {}
    for batch in seen:
        for row in batch.to_pylist():
            if row["bucket"] != at:
                at, known = row["bucket"], {}
            words = pa.decompress(row["words"], row["size"], "zstd", asbytes=True).decode().split("\n")
            if len(known) > KNOWN_WORDS:
                known = {}
            todo = [w for w in words if w not in known]
            known.update(zip(todo, enc(todo), strict=True))
            own = [known[w] for w in words]
            lens = np.fromiter(map(len, own), np.uint32, len(own))
            ids = np.fromiter((i for x in own for i in x), np.uint32, int(lens.sum()))
            yield pa.RecordBatch.from_pylist([{"chunk_id": row["chunk_id"], "n": row["n"], "pos": row["pos"], "lens": _pack(lens), "ids": _pack(ids), "total": len(ids)}], _IDS_ARROW)


@tidied
def _gather(path: str, decode: bool, seen):
    """Batches of (docs, counts, codes, packs): the ids of a chunk's words, by position, back into its documents."""
    for batch in seen:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i] for n in ("counts", "codes", "packs")}
            docs = batch.column("docs").slice(i, 1).flatten()
            counts = row["counts"].values.to_numpy()
            codes = _unpack(row["codes"].as_py(), int(counts.sum()))
            packs = row["packs"].as_py() or []
            pos = np.concatenate([np.cumsum(_unpack(w["pos"], w["n"]).view(np.int32)) for w in packs] or [np.empty(0, np.int64)])
            lens = np.concatenate([_unpack(w["lens"], w["n"]) for w in packs] or [np.empty(0, np.uint32)]).astype(np.int64)
            flat = np.concatenate([_unpack(w["ids"], w["total"]) for w in packs] or [np.empty(0, np.uint32)])
            table = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int64()), pa.array(flat, pa.uint32()))
            where = np.argsort(pos)  # pos is a permutation of the chunk's codes
            edges = np.concatenate([[0], np.cumsum(counts)])
            for a, b in slices(counts, SLICE_WORDS):
                own = where[codes[edges[a] : edges[b]]]
                run = np.concatenate([[0], np.cumsum(lens[own])])
                ends = run[edges[a : b + 1] - edges[a]].astype(np.int64)
                ids = table.take(pa.array(own)).flatten().to_numpy() if len(own) else np.empty(0, np.uint32)
                raw = ids.astype("<u4").tobytes()
                out = {"doc_id": docs.slice(a, b - a), "ids": pa.array([raw[4 * x : 4 * y] for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.binary())}
                if decode:
                    out["decoded"] = decode_ids(path, ids, ends)
                yield pa.record_batch(out)


def decode_ids(path: str, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Texts of flat ``ids`` cut at ``ends``: the id-to-piece join, a gather from the vocabulary."""
    texts = []
    for a, b in slices(np.diff(ends), 1 << 20):
        own = vocabulary(path).take(pa.array(ids[ends[a] : ends[b]].astype(np.int64)))
        texts.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends[a : b + 1] - ends[a], pa.int32()), own), pa.scalar(" ", pa.large_string())).cast(pa.string()))
    return pa.concat_arrays(texts) if texts else pa.array([], pa.string())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, ids[, decoded]): token ids as little-endian unsigned 32-bit integers.

    ``decode`` adds the text that the ids stand for, special tokens kept.
    ``buckets``: into how many parts the distinct words are dealt; a worker works on one at a time.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize_bucketed(own.mapInArrow(lambda seen: _chunks(path, buckets, seen), CHUNK_SCHEMA), "chunks", parts, "chunk_id")
    words = rows.where("bucket >= 0").select("bucket", "chunk_id", "n", "pos", "words", "size").repartition("bucket").sortWithinPartitions("bucket")
    ids = words.mapInArrow(lambda seen: _encode_words(path, seen), IDS_SCHEMA)
    packs = ids.groupBy("chunk_id").agg(F.collect_list(F.struct("n", "pos", "lens", "ids", "total")).alias("packs"))
    chunks = rows.where("bucket < 0").select("chunk_id", "docs", "counts", "codes")
    joined = chunks.join(packs, "chunk_id", "left").select("docs", "counts", "codes", "packs")
    return joined.mapInArrow(lambda seen: _gather(path, decode, seen), "doc_id long, ids binary" + ", decoded string" * decode)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): the inverse way, for ids from anywhere."""

    def run(seen):
        for batch in seen:
            raw = [x or b"" for x in batch.column(1).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in raw])]).astype(np.int64)
            yield pa.record_batch({"doc_id": batch.column(0), "text": decode_ids(path, np.frombuffer(b"".join(raw), "<u4"), ends)})

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of :func:`encode` with ``decode``."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
