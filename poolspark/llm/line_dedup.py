"""Incremental, reversible line dedup (operator 3).

State, all of it on shared storage and only ever added to:

``refs``     exact references: one row (key, doc_id, n) for each line key of each document;
``counts``   exact reference counts: one row (key, n_docs, first_doc) for each key;
``filters``  cuckoo filters, a chain of equal parts for each shard of the key space.

Each is a log of written tables whose rows carry the number of the change that
wrote them; for a key, or a shard, the row of the last change holds.  A key that no
document holds any more has a last row of no documents, and a document that is
deleted a row in the list of deletions, which hides what it said before.  So a
change writes rows of the keys and shards that it touches only.  After
``COMPACT`` changes the logs are written anew as one table each, with more
shards if the keys have outgrown them.

*Insert*: a batch is first reduced to its distinct keys.  Each shard's filters
say which of them were certainly never seen; only the others are looked up in
``counts``.  Keys that are not found there, those that the filters took for
known by mistake included, are added and their fingerprints inserted; keys
that are found are merged.  So every key of ``counts`` has a fingerprint of its
own.  *Delete* takes a document's references away, recounts the keys it held,
and removes one fingerprint of each key that no document holds any more.  All
parts of a chain have the same size, so equal fingerprints of a shard stand for
each other wherever they lie: what is left still covers every key of ``counts``,
and a deletion restores what an insertion changed.  *Verdicts* come from the
exact tables, which are right only because filters never deny a key.

:func:`index` inserts a table of documents in ``BATCHES`` batches by a hash of
the id, so all but the first go through the filters.

A key is a line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lowered;
it is carried as its 128-bit MD5.  Only keys of ``min_chars`` code points count.
A key that two or more documents hold loses all its lines but those of the
smallest doc_id.  Null or empty texts are one empty line; rows that repeat a
doc_id count as one document and each lose the lines that it loses; a null
doc_id is a document smaller than any other.  Other columns are not read, may
have any name, and stay as they are in :func:`strip`.  An empty table gives an
empty index and no rows.  Texts of any length are split as they are; a line or
text is held in memory once, and its cost grows with its length.

Hot lines: references are counted by (key, doc_id), then by key with partial
sums, so a line that a third of the documents holds reaches the counting task
as one row from each task before it.  Keys that more than one in ``HOT_KEYS``
of the references of repeated keys name (and more than ``HOT_LEAST``) are joined back by a
broadcast, which holds ``HOT_KEYS`` keys at most; only the others are shuffled.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolspark.llm.common import LOWER, UPPER, slices, tidied, unused
from poolspark.plans.shared import materialize

_TRIM = " \t\n\x0b\x0c\r"
_LOWER_TABLE = str.maketrans(UPPER, LOWER)


#: Keys that one filter part is made for, and keys of a shard when an index is laid out.
PART_KEYS, SHARD_KEYS = 1 << 15, 200_000
#: An index is laid out for so many times the keys of its first batch; beyond that, chains only get longer.
GROWTH = 4
BATCHES = 3
HOT_KEYS, HOT_LEAST = 20_000, 1000
SLICE_BYTES = 8 << 20


class CuckooFilter:
    """Fingerprints of ``bits`` bits, sixteen at most, four to a bucket; bulk operations on arrays of 64-bit hashes.

    Fingerprints that find no place after ``ROUNDS`` of evictions go to a stash, so
    nothing inserted is ever denied.  Equal keys may be inserted several times.
    """

    SLOTS, ROUNDS, LOAD = 4, 256, 0.9

    def __init__(self, capacity: int, bits: int = 16):
        self.bits, self.mask = bits, (1 << max(1, int(np.ceil(np.log2(max(capacity, 8) / self.SLOTS / self.LOAD))))) - 1
        self.table = np.zeros((self.mask + 1, self.SLOTS), np.uint16)
        self.stash = np.empty((0, 2), np.uint32)

    @staticmethod
    def _mix(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        fp = np.maximum(hashes >> np.uint64(64 - self.bits), np.uint64(1)).astype(np.uint16)
        one = (self._mix(hashes) & np.uint64(self.mask)).astype(np.int64)
        return fp, one, self._other(fp, one)

    def _other(self, fp: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ (self._mix(fp) & np.uint64(self.mask)).astype(np.int64)

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table)) + len(self.stash)

    def room(self) -> int:
        return max(0, int(self.table.size * self.LOAD) - len(self))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        fp, one, two = self._places(hashes)
        found = (self.table[one] == fp[:, None]).any(1) | (self.table[two] == fp[:, None]).any(1)
        if len(self.stash):
            low = np.minimum(one, two)
            held = set(map(tuple, self.stash.tolist()))
            found |= np.fromiter(((int(b), int(f)) in held for b, f in zip(low, fp, strict=True)), bool, len(fp))
        return found

    def insert(self, hashes: np.ndarray) -> None:
        fp, at, _ = self._places(hashes)
        rng = np.random.default_rng(len(hashes))
        for turn in range(self.ROUNDS):
            if not len(fp):
                return
            order = np.argsort(at, kind="stable")
            fp, at = fp[order], at[order]
            first = np.r_[0, np.flatnonzero(np.diff(at)) + 1]
            rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
            free = self.table[at] == 0
            fits = rank < free.sum(1)
            slot = np.argmax(np.cumsum(free[fits], 1) == (rank[fits] + 1)[:, None], 1)
            self.table[at[fits], slot] = fp[fits]
            fp, at, rank = fp[~fits], at[~fits], rank[~fits]
            if turn % 2 and len(fp):  # both places were full: the first waiting at each bucket evicts one fingerprint
                lead = np.r_[True, np.diff(at) != 0]
                victim = rng.integers(0, self.SLOTS, int(lead.sum()))
                out = self.table[at[lead], victim].copy()
                self.table[at[lead], victim] = fp[lead]
                fp[lead] = out
            at = self._other(fp, at)
        low = np.minimum(at, self._other(fp, at))
        self.stash = np.concatenate([self.stash, np.stack([low, fp], 1).astype(np.uint32)])

    def remove(self, hashes: np.ndarray) -> np.ndarray:
        """Take away one fingerprint of each hash; which of them had one here."""
        done = np.zeros(len(hashes), bool)
        for k, (fp, one, two) in enumerate(zip(*(x.tolist() for x in self._places(hashes)), strict=True)):
            for b in (one, two):
                hit = np.flatnonzero(self.table[b] == fp)
                if len(hit):
                    self.table[b, hit[0]], done[k] = 0, True
                    break
            else:
                hit = np.flatnonzero((self.stash == (min(one, two), fp)).all(1))
                self.stash, done[k] = np.delete(self.stash, hit[:1], 0), len(hit) > 0
        return done

    def dump(self) -> bytes:
        head = np.array([self.mask + 1, len(self.stash), self.bits], "<u4").tobytes()
        return pa.compress(head + self.stash.astype("<u4").tobytes() + self.table.astype("<u2").tobytes(), "zstd", asbytes=True)

    @classmethod
    def load(cls, data: bytes, size: int) -> CuckooFilter:
        raw = pa.decompress(data, size, "zstd", asbytes=True)
        n, stash, bits = np.frombuffer(raw[:12], "<u4").tolist()
        own = cls.__new__(cls)
        own.mask, own.bits = n - 1, bits
        own.stash = np.frombuffer(raw[12 : 12 + 8 * stash], "<u4").reshape(-1, 2).astype(np.uint32)
        own.table = np.frombuffer(raw[12 + 8 * stash :], "<u2").reshape(-1, cls.SLOTS).astype(np.uint16)
        return own

    def size(self) -> int:
        return 12 + 8 * len(self.stash) + 2 * self.table.size


FILTERS = "shard int, part int, size long, filter binary"
#: What an index writes, and changes after which it is written anew.
LOGS = {"refs": "key binary, doc_id long, n long", "counts": "key binary, n_docs long, first_doc long", "filters": FILTERS, "gone": "doc_id long"}
COMPACT = 8


def line_key(line: Column) -> Column:
    """A line's key in full."""
    return F.translate(F.btrim(line, F.lit(_TRIM)), UPPER, LOWER)


def references(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, n): how often a document holds each key of ``min_chars`` code points."""
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("line"))
    keys = lines.select("doc_id", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keys.select("doc_id", F.unhex(F.md5(F.col("key").cast("binary"))).alias("key")).groupBy("key", "doc_id").agg(F.count("*").alias("n"))


def count(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count("*").alias("n_docs"), _least_doc("doc_id"))


def _least_doc(name: str) -> Column:
    """The smallest id, null before all others."""
    return F.min_by(name, F.coalesce(name, F.lit(-(2**63)))).alias("first_doc")


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)[:, 0]


def _chain(filters: pa.Table) -> list[CuckooFilter]:
    return [CuckooFilter.load(r["filter"], r["size"]) for r in sorted(filters.to_pylist(), key=lambda r: r["part"])]


def _dumped(shard: int, chain: list[CuckooFilter]) -> pa.Table:
    rows = [{"shard": shard, "part": i, "size": f.size(), "filter": f.dump()} for i, f in enumerate(chain)]
    return pa.Table.from_pylist(rows, pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("size", pa.int64()), ("filter", pa.binary())]))


def _probe(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """The keys of a shard that its filters may know."""
    own = keys.column("key")
    hashes = _hashes(own.to_pylist())
    known = np.zeros(len(hashes), bool)
    for f in _chain(filters):
        known |= f.contains(hashes)
    return pa.table({"key": own.filter(pa.array(known))})


def _admit(bits: int, key, keys: pa.Table, filters: pa.Table) -> pa.Table:
    """Filters of a shard with a fingerprint for each of ``keys``."""
    hashes, chain = _hashes(keys.column("key").to_pylist()), _chain(filters)
    while len(hashes):
        room = chain[-1].room() if chain else 0
        if not room:
            chain.append(CuckooFilter(PART_KEYS, bits))
            room = chain[-1].room()
        chain[-1].insert(hashes[:room])
        hashes = hashes[room:]
    return _dumped(key[0].as_py(), chain)


def _withdraw(key, keys: pa.Table, filters: pa.Table) -> pa.Table:
    """Filters of a shard without one fingerprint of each of ``keys``."""
    hashes, chain = _hashes(keys.column("key").to_pylist()), _chain(filters)
    for f in chain:
        hashes = hashes[~f.remove(hashes)]
    return _dumped(key[0].as_py(), chain)


def _written(df: DataFrame, log: list[DataFrame], label: str, change: int) -> list[DataFrame]:
    """``log`` with the rows of one more change, if there are any."""
    own = materialize(df.withColumn("change", F.lit(change)), label)
    return log if own.isEmpty() else [*log, own]


class LineIndex:
    """Lines of a growing and shrinking collection of documents.

    ``shards``: parts of the key space; a task holds one shard's keys of a batch
    and its filters.  0 lets the first batch decide: SHARD_KEYS keys to a shard
    when the collection has grown to GROWTH times that batch.  ``bits``: size of a
    fingerprint, which only changes how many keys are looked up for nothing.
    """

    def __init__(self, spark, logs: dict[str, list[DataFrame]], change: int, shards: int, min_chars: int, bits: int = 16):
        self.spark, self.logs, self.change, self.shards, self.min_chars, self.bits = spark, logs, change, shards, min_chars, bits

    @classmethod
    def empty(cls, spark, shards: int = 0, min_chars: int = 10, bits: int = 16) -> LineIndex:
        return cls(spark, {name: [] for name in LOGS}, 0, shards, min_chars, bits)

    def _log(self, name: str) -> DataFrame:
        """All rows that were ever written."""
        parts = self.logs[name]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], f"{LOGS[name]}, change int")

    def _last(self, rows: DataFrame, *by: str) -> DataFrame:
        """Of rows of a log those of the last change of each key; one table has no others."""
        rest = [c for c in rows.columns if c not in (*by, "change")]
        return rows.groupBy(*by).agg(*[F.max_by(c, "change").alias(c) for c in rest])

    @property
    def counts(self) -> DataFrame:
        rows = self._log("counts")
        return (self._last(rows, "key") if len(self.logs["counts"]) > 1 else rows.drop("change")).where("n_docs > 0")

    @property
    def refs(self) -> DataFrame:
        rows = self._log("refs")
        if not self.logs["gone"]:
            return rows.drop("change")
        gone = self._log("gone").groupBy(F.col("doc_id").alias("lost")).agg(F.max("change").alias("until"))
        return rows.join(gone, F.col("doc_id").eqNullSafe(F.col("lost")) & (F.col("change") < F.col("until")), "left_anti").drop("change")

    @property
    def filters(self) -> DataFrame:
        rows = self._log("filters")
        if len(self.logs["filters"]) < 2:
            return rows.drop("change")
        last = rows.groupBy(F.col("shard").alias("of")).agg(F.max("change").alias("at"))
        return rows.join(last, (F.col("shard") == F.col("of")) & (F.col("change") == F.col("at")), "left_semi").drop("change")

    def _by_shard(self, keys: DataFrame, shards: int):
        """Keys beside the filters of the shards that they touch."""
        own = keys.select(F.pmod(F.crc32("key"), F.lit(shards)).cast("int").alias("shard"), "key")
        touched = own.select("shard").distinct()
        return own.groupBy("shard").cogroup(self.filters.join(touched, "shard", "left_semi").groupBy("shard"))

    def _next(self, shards: int, **more: list[DataFrame]) -> LineIndex:
        """The index after a change, compacted if its logs are long."""
        out = LineIndex(self.spark, self.logs | more, self.change + 1, shards, self.min_chars, self.bits)
        return out.compacted() if max(map(len, out.logs.values())) >= COMPACT else out

    def compacted(self) -> LineIndex:
        """The same index with one table for each log; keys are dealt to more shards if there are too many for each."""
        one = lambda df, label: [materialize(df.withColumn("change", F.lit(self.change)), label)]
        refs, counts = one(self.refs, "line-refs"), one(self.counts, "line-counts")
        shards, keys = max(1, self.shards), counts[0].count()
        logs = {"refs": refs, "counts": counts, "gone": []}
        if keys <= 2 * SHARD_KEYS * shards:
            return LineIndex(self.spark, logs | {"filters": one(self.filters, "line-filters")}, self.change + 1, self.shards, self.min_chars, self.bits)
        shards = -(-GROWTH * keys // SHARD_KEYS)
        bare = LineIndex(self.spark, logs | {"filters": []}, self.change, shards, self.min_chars, self.bits)
        return LineIndex(self.spark, logs | {"filters": one(bare._admitted(counts[0].select("key"), shards), "line-filters")}, self.change + 1, shards, self.min_chars, self.bits)

    def _admitted(self, keys: DataFrame, shards: int) -> DataFrame:
        bits = self.bits
        return self._by_shard(keys, shards).applyInArrow(lambda k, a, b: _admit(bits, k, a, b), FILTERS)

    def insert(self, docs: DataFrame, **cols: str) -> LineIndex:
        """The index with ``docs``, whose doc_ids must be new to it, or deleted before."""
        change = self.change
        refs = _written(references(docs, self.min_chars, **cols), self.logs["refs"], "line-refs", change)
        if len(refs) == len(self.logs["refs"]):
            return self
        batch = materialize(count(refs[-1]), "line-batch")
        shards = self.shards or max(1, -(-GROWTH * batch.count() // SHARD_KEYS))
        if not self.logs["filters"]:
            new = written = batch
        else:
            maybe = materialize(self._by_shard(batch, shards).applyInArrow(_probe, "key binary"), "line-maybe")
            near = self._log("counts").join(maybe, "key", "left_semi")  # the exact lookup
            old = materialize(self._last(near, "key").where("n_docs > 0"), "line-old")
            names = old.select("key")
            new = materialize(batch.join(names, "key", "left_anti"), "line-new")
            both = old.unionByName(batch.join(names, "key", "left_semi"))
            written = both.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), _least_doc("first_doc")).unionByName(new)
        counts = _written(written, self.logs["counts"], "line-counts", change)
        filters = _written(self._admitted(new, shards), self.logs["filters"], "line-filters", change)
        return self._next(shards, refs=refs, counts=counts, filters=filters)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents of ``doc_ids`` (column doc_id); ids that it does not hold change nothing."""
        change = self.change
        asked = doc_ids.select(F.col("doc_id").cast("long").alias("gone")).distinct()
        held = self.refs
        lost = materialize(held.join(asked, held["doc_id"].eqNullSafe(asked["gone"]), "left_semi"), "line-lost")
        gone = _written(lost.select("doc_id").distinct(), self.logs["gone"], "line-gone", change)
        if len(gone) == len(self.logs["gone"]):
            return self
        after = LineIndex(self.spark, self.logs | {"gone": gone}, change, self.shards, self.min_chars, self.bits)
        touched = materialize(lost.select("key").distinct(), "line-touched")
        again = materialize(count(after.refs.join(touched, "key", "left_semi")), "line-again")
        left = materialize(touched.join(again, "key", "left_anti"), "line-left")
        none = left.select("key", F.lit(0).cast("long").alias("n_docs"), F.lit(None).cast("long").alias("first_doc"))
        counts = _written(again.unionByName(none), self.logs["counts"], "line-counts", change)
        filters = _written(self._by_shard(left, max(1, self.shards)).applyInArrow(_withdraw, FILTERS), self.logs["filters"], "line-filters", change)
        return self._next(self.shards, gone=gone, counts=counts, filters=filters)

    def drops(self) -> DataFrame:
        """(doc_id, keys): the keys whose lines each document loses."""
        counts, refs = materialize(self.counts.where("n_docs >= 2"), "line-repeated"), self.refs
        total = counts.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
        often = max(HOT_LEAST, total // HOT_KEYS)  # fewer than HOT_KEYS keys have more references than this
        hot = F.broadcast(counts.where(F.col("n_docs") > often).select("key", "first_doc"))
        rest = counts.where(F.col("n_docs") <= often).select("key", "first_doc")
        found = refs.join(hot, "key").unionByName(refs.join(hot, "key", "left_anti").join(rest, "key"))
        return found.where(~F.col("doc_id").eqNullSafe(F.col("first_doc"))).groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


@tidied
def _strip(text_col: str, keys_col: str, counts: tuple[str, ...], seen):
    for whole in seen:
        sizes = pc.fill_null(pc.binary_length(whole.column(text_col)), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, SLICE_BYTES):
            batch = whole.slice(a, b - a)
            kept, lines, dropped = [], [], []
            for text, keys in zip(batch.column(text_col).to_pylist(), batch.column(keys_col).to_pylist(), strict=True):
                text = text or ""
                lines.append(text.count("\n") + 1)
                if not keys:
                    kept.append(text)
                    dropped.append(0)
                    continue
                lost, own = set(keys), text.split("\n")
                stay = [x for x in own if hashlib.md5(x.strip(_TRIM).translate(_LOWER_TABLE).encode()).digest() not in lost]
                kept.append("\n".join(stay))
                dropped.append(len(own) - len(stay))
            out = {n: batch.column(n) if n != text_col else pa.array(kept, pa.string()) for n in batch.schema.names if n != keys_col}
            yield pa.record_batch(out | dict(zip(counts, (pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())))))


def index(docs: DataFrame, min_chars: int = 10, shards: int = 0, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES) -> LineIndex:
    """An index of ``docs``, inserted in ``batches`` by a hash of the id."""
    out, batch = LineIndex.empty(docs.sparkSession, shards, min_chars), F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(batches))
    for k in range(batches):
        out = out.insert(docs.where(batch == k), id_col=id_col, text_col=text_col)
    return out


def strip(docs: DataFrame, drops: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with the lines of ``drops`` taken out of the text; ``counts`` adds n_lines and n_dropped."""
    drop_id, keys = unused(docs, "drop_id"), unused(docs, "keys")
    lost = drops.select(F.col("doc_id").alias(drop_id), F.col("keys").alias(keys))
    joined = docs.join(lost, F.col(id_col).cast("long").eqNullSafe(F.col(drop_id)), "left").drop(drop_id)
    names = ("n_lines", "n_dropped") if counts else ()
    return joined.mapInArrow(lambda seen: _strip(text_col, keys, names, seen), T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)]))


def dedup(docs: DataFrame, min_chars: int = 10, shards: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): each document's remaining lines, by an index of ``docs``."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return strip(own, index(own, min_chars, shards).drops())


def digests(deduped: DataFrame) -> DataFrame:
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT doc_id, pos, line,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.first_doc AS dropped FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
