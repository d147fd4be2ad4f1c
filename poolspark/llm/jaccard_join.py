"""Near duplicates by a grouped prefix join on word shingles (operator 8).

A document's set holds the 64-bit hashes of its distinct ``width``-word
shingles (A-Z lowered); with fewer words it holds one hash of all its words,
and without words it is empty and linked with nothing.  Two documents link when
100 * intersection >= ``percent`` * union.

1. *Order.*  Shingles that occur often are found by counting them in chunks of
   all texts; they go last in the order, from rare to frequent, and all others
   are ordered by hash.  So texts put together from shared passages meet by the
   shingles between passages, which few of them have in common, not by those that
   all of them hold.  Any order gives the same links, so missing a frequent
   shingle costs time only.
2. *Prefixes.*  Sets of ``n`` shingles that link share one of their first
   ``n - ceil(percent * n / 100) + 1`` shingles.
3. *Groups.*  Equal sets become one set, sets with the same prefix and size one
   group; both are recognised by 128-bit digests and then numbered in a written
   table.  Only groups enter the posting lists of shingles.  A pair in a list can
   link only if the shorter rest of the two sets behind the shared shingle
   still holds the overlap that their sizes ask for.
4. *First links.*  Each list ties its groups to the one that passes the filter
   and stands in most lists, which a text that others were copied from does, and
   each group's members to one of them.  These pairs, linear in the lists, are
   verified: first the prefixes must share enough, then the whole sets decide.
   They give components.
5. *Remaining links.*  In each list, members of *different* groups and components
   that pass the filter are paired and verified likewise.  Members of one group
   have all of their prefix in common, so those in different components are
   paired whether or not their group meets another.  Pairs inside a component
   change nothing and are not formed, so a large set of near copies costs no
   square of its size.

The result is exact as long as no two different shingles of the two texts of a
pair share a 64-bit hash; which texts are equal does not rest on these hashes
meeting by chance in the whole corpus, but on 128 bits.

Null and empty texts have no words.  Every row gives one row.  Rows that repeat
an id are judged each by its own text and share the id; rows without an id are
judged and link like all others, and only their own component's name is null
where nobody in it has an id.  An empty table gives no rows.  Texts are taken
whole, in slices of some megabytes; one longer than a slice stands alone.
Columns other than the id and the text are not read and may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolspark.llm.common import LOWER, UPPER, plain, slices, tidied
from poolspark.llm.components import components
from poolspark.plans.shared import materialize

SLICE_BYTES, CHUNK_BYTES = 2 << 20, 48 << 20
#: A shingle is frequent from so many documents in a chunk of texts, and in all such chunks; so many at most are put last.
HOT_IN_CHUNK, HOT, HOT_KEPT = 2, 6, 1_000_000
#: Lists up to this length are filtered row by row before they are kept.
DENSE = 512
#: Ids of about eight bytes that are still broadcast to find the texts of candidates.
BROADCAST_IDS = 500_000
_P, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M
    return x ^ (x >> np.uint64(27))


def shingle_sets(texts: pa.Array, width: int):
    """For each text the sorted distinct hashes of its shingles."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(plain(texts)))
    flat = parts.flatten()
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    at = parts.offsets.to_numpy()
    ends = np.concatenate([[0], np.cumsum(keep)])[at - at[0]]
    coded = flat.filter(pa.array(keep)).dictionary_encode()
    own = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    words = own[coded.indices.to_numpy()]
    with np.errstate(over="ignore"):
        run = words[: max(0, len(words) - width + 1)].copy()
        for k in range(1, width):
            run = run * _P + words[k : k + len(run)]
        run = _mix(run + np.uint64(width))
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            if b - a >= width:
                yield np.unique(run[a : b - width + 1])
            elif b > a:
                short = words[a]
                for w in words[a + 1 : b]:
                    short = short * _P + w
                yield _mix(np.array([short + np.uint64(b - a)], np.uint64))
            else:
                yield np.empty(0, np.uint64)


@tidied
def _hot(width: int, seen):
    """(hash, n) of shingles that several documents of a chunk of texts hold."""
    held, size = [], 0

    def out():
        h, n = np.unique(np.concatenate(held), return_counts=True)
        own = n >= HOT_IN_CHUNK
        return pa.record_batch({"hash": pa.array(h[own].view(np.int64)), "n": pa.array(n[own].astype(np.int64))})

    for batch in seen:
        texts = batch.column(0)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, SLICE_BYTES):
            held += shingle_sets(texts.slice(a, b - a), width)
            size += int(sizes[a:b].sum())
            if size >= CHUNK_BYTES:
                yield out()
                held, size = [], 0
    if held:
        yield out()


def _digest(u: np.ndarray, size: int = 0) -> bytes:
    return hashlib.blake2b(u.tobytes(), digest_size=16, salt=size.to_bytes(8, "little")).digest()


SETS_SCHEMA = "doc_id long, n long, set binary, grp binary, prefix array<long>"


@tidied
def _prefixes(width: int, percent: int, hot: np.ndarray, ranks: np.ndarray, seen):
    """SETS_SCHEMA; the prefix of a group is given once in a task.

    ``hot`` are the frequent shingles, sorted, and ``ranks`` their places from rare to frequent.
    """
    known: set[bytes] = set()
    for batch in seen:
        ids, texts = batch.column(0), batch.column(1)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, SLICE_BYTES):
            n, own_set, grp, prefix = [], [], [], []
            for u in shingle_sets(texts.slice(a, b - a), width):
                n.append(len(u))
                if not len(u):
                    own_set.append(None), grp.append(None), prefix.append(None)
                    continue
                order = u
                if len(hot):
                    where = np.minimum(np.searchsorted(hot, u), len(hot) - 1)
                    often = hot[where] == u
                    by_count = np.argsort(ranks[where[often]])
                    order = np.concatenate([u[~often], u[often][by_count]])
                own = order[: len(u) - -(-percent * len(u) // 100) + 1]
                group = _digest(own, len(u))
                own_set.append(_digest(u))
                grp.append(group)
                prefix.append(None if group in known else own.view(np.int64))
                if len(known) < 1 << 20:
                    known.add(group)
            yield pa.record_batch({"doc_id": ids.slice(a, b - a), "n": pa.array(n, pa.int64()), "set": pa.array(own_set, pa.binary()), "grp": pa.array(grp, pa.binary()), "prefix": pa.array(prefix, pa.list_(pa.int64()))})


def _runs(seen):
    """Columns of sorted batches as arrays, cut so that no run of the first column is split.

    Batches of one run are kept as they come and put together once.
    """
    held: list[list[np.ndarray]] = []
    for batch in seen:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        if not len(cols[0]):
            continue
        if held and cols[0][-1] == held[0][0][-1]:
            held.append(cols)
            continue
        whole = [np.concatenate(c) for c in zip(*held, cols, strict=True)]
        cut = int(np.searchsorted(whole[0], whole[0][-1], "left"))
        if cut:
            yield [c[:cut] for c in whole]
        held = [[c[cut:].copy() for c in whole]]
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


@tidied
def _live(percent: int, seen):
    """Postings (token, n, rem, g), sorted by token, that pass the filter with another of their list."""
    for token, n, rem, g in _runs(seen):
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        lens = np.diff(np.r_[starts, len(token)])
        # two may link if each one's reach covers the other's size
        reach, size, own = (100 + percent) * rem - percent * n, percent * n, np.zeros(len(token), bool)
        two = starts[lens == 2]
        both = (reach[two] >= size[two + 1]) & (reach[two + 1] >= size[two])
        own[two], own[two + 1] = both, both
        for a, m in zip(starts[lens > 2], lens[lens > 2], strict=True):
            if m <= DENSE:
                r, z = reach[a : a + m], size[a : a + m]
                fits = (r[:, None] >= z) & (r >= z[:, None])
                np.fill_diagonal(fits, False)
                own[a : a + m] = fits.any(1)
            else:
                own[a : a + m] = True
        yield pa.record_batch({"token": token[own], "n": n[own], "rem": rem[own], "g": g[own]})


def _may(n, rem, m, rest, percent):
    """The shorter rest behind a shared token can hold the overlap that the sizes ask for."""
    return np.minimum(rem, rest) * (100 + percent) >= percent * (n + m)


@tidied
def _ties(percent: int, seen):
    """Pairs (a, b) of groups: each with two likely centres of its list, if they pass the filter.

    From sorted (token, n, rem, g, degree), degree being the number of lists that
    a group stands in.  The text that others were copied from has few shingles of
    its own before the shared ones, so its reach is longest, and it stands in
    many lists.  Groups that don't pass with a centre are tied among themselves.
    """
    for token, n, rem, g, degree in _runs(seen):
        told: set[tuple[int, int]] = set()
        reach = (100 + percent) * rem - percent * n
        edges = np.r_[np.flatnonzero(np.r_[True, token[1:] != token[:-1]]), len(token)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            for order in (np.lexsort((g[a:b], -reach[a:b])), np.lexsort((g[a:b], -degree[a:b]))):
                left = order + a
                while len(left) > 1:
                    p, rest = left[0], left[1:]
                    fits = _may(n[p], rem[p], n[rest], rem[rest], percent)
                    told.update((min(int(g[p]), int(x)), max(int(g[p]), int(x))) for x in g[rest[fits]])
                    left = rest[~fits]
        pairs = np.array(sorted(told), np.int64).reshape(-1, 2)
        yield pa.record_batch({"a": pairs[:, 0], "b": pairs[:, 1]})


@tidied
def _across(percent: int, seen):
    """Pairs (a, b) of sets in different components and groups that pass the filter, with their groups (ga, gb).

    From sorted (token, n, rem, sid, root, g).
    """
    for token, n, rem, sid, root, g in _runs(seen):
        told: set[tuple[int, int, int, int]] = set()
        edges = np.r_[np.flatnonzero(np.r_[True, token[1:] != token[:-1]]), len(token)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a < 2 or (root[a:b] == root[a]).all():
                continue
            ns, rs, ss, cs, gs = n[a:b], rem[a:b], sid[a:b], root[a:b], g[a:b]
            order = np.argsort(ns, kind="stable")
            ns, rs, ss, cs, gs = ns[order], rs[order], ss[order], cs[order], gs[order]
            ends = np.searchsorted(ns, ns * 100 // percent, "right")
            for i in range(len(ns) - 1):
                j = slice(i + 1, int(ends[i]))
                fits = (cs[j] != cs[i]) & (gs[j] != gs[i]) & _may(ns[i], rs[i], ns[j], rs[j], percent)
                me = int(ss[i]), int(gs[i])
                for x, y in zip(ss[j][fits].tolist(), gs[j][fits].tolist(), strict=True):
                    told.add((me[0], x, me[1], y) if me[0] < x else (x, me[0], y, me[1]))
        pairs = np.array(sorted(told), np.int64).reshape(-1, 4)
        yield pa.record_batch({"a": pairs[:, 0], "b": pairs[:, 1], "ga": pairs[:, 2], "gb": pairs[:, 3]})


@tidied
def _sets(width: int, seen):
    for batch in seen:
        texts = batch.column(0)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, SLICE_BYTES):
            own = [u for u in shingle_sets(texts.slice(a, b - a), width) if len(u)]
            yield pa.record_batch({"set": pa.array([_digest(u) for u in own], pa.binary()), "hs": pa.array([u.view(np.int64) for u in own], pa.list_(pa.int64()))})


def _small(ids: DataFrame) -> DataFrame:
    """A written table of ids, to be broadcast while it has at most BROADCAST_IDS rows."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _ends(pairs: DataFrame, name: str) -> DataFrame:
    return pairs.select(F.col("a").alias(name)).unionByName(pairs.select(F.col("b").alias(name))).distinct()


def _plausible(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of groups whose prefixes share enough shingles.

    Two sets that link share at least alpha = ceil(percent * (x + y) / (100 + percent))
    shingles.  At most ceil(percent * n / 100) - 1 of a set's lie behind its
    prefix, so both prefixes hold the first alpha - max(ceil(percent * n / 100)) + 1
    of the shared ones.
    """
    pairs = materialize(pairs.where("a <> b").distinct(), "near-pairs")
    wanted = materialize(_ends(pairs, "g"), "near-groups")
    own = groups.select("g", "n", "prefix").join(_small(wanted), "g", "left_semi")
    both = pairs.join(own.toDF("a", "x", "pa"), "a").join(own.toDF("b", "y", "pb"), "b")
    tail = lambda n: f"(({n} * {percent} + 99) div 100)"
    alpha = f"((({percent} * (x + y)) + {99 + percent}) div {100 + percent})"
    return both.where(F.expr(f"size(array_intersect(pa, pb)) >= {alpha} - greatest({tail('x')}, {tail('y')}) + 1")).select("a", "b")


def _verified(pairs: DataFrame, own: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs of set ids (a, b) that link, by their whole sets, which are made from the texts again."""
    pairs = materialize(pairs.where("a <> b").distinct(), "near-pairs")
    wanted = materialize(sets.join(_ends(pairs, "sid"), "sid", "left_semi").select("sid", "set", "u"), "near-wanted")
    texts = own.join(_small(wanted.select("u").distinct()), F.col("doc_id").eqNullSafe(F.col("u")), "left_semi").select("text")
    full = texts.mapInArrow(lambda seen: _sets(width, seen), "set binary, hs array<long>").join(_small(wanted.select("set", "sid")), "set").select("sid", "hs").dropDuplicates(["sid"])
    both = pairs.join(full.toDF("a", "ha"), "a").join(full.toDF("b", "hb"), "b").select("a", "b", F.size(F.array_intersect("ha", "hb")).alias("i"), F.size("ha").alias("x"), F.size("hb").alias("y"))
    return materialize(both.where(F.col("i") * 100 >= (F.col("x") + F.col("y") - F.col("i")) * percent).select("a", "b"), "near-links")


def _within(known: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of one group in different components.

    From (g, sid, root).  One of each pair lies outside the component that holds
    most of the group, so a large component is met only by the sets that are not in it.
    """
    held = known.groupBy("g", "root").agg(F.count("*").alias("m"))
    mixed = held.groupBy("g").agg(F.max_by("root", F.struct("m", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1").select("g", "top")
    own = materialize(known.join(mixed, "g").select("g", "sid", "root", "top"), "near-mixed")
    few = own.where("root <> top").toDF("g", "a", "ra", "top")
    return few.join(own.select("g", F.col("sid").alias("b"), F.col("root").alias("rb")), "g").where("ra <> rb and (rb = top or ra < rb)").select("a", "b")


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id reachable by links."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    often = own.select("text").mapInArrow(lambda seen: _hot(width, seen), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT)
    top = often.orderBy(F.desc("n"), "hash").limit(HOT_KEPT).select("hash").toPandas()["hash"].to_numpy(np.int64).view(np.uint64)
    by_hash = np.argsort(top)
    hot = spark.sparkContext.broadcast((top[by_hash], (len(top) - 1 - by_hash).astype(np.int32)))  # the last is the rarest
    rows = materialize(own.mapInArrow(lambda seen: _prefixes(width, percent, *hot.value, seen), SETS_SCHEMA), "near-sets")

    numbered = lambda df, name, label: materialize(df.withColumn(name, F.monotonically_increasing_id()), label)
    groups = numbered(rows.where("prefix is not null").groupBy("grp").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix")), "g", "near-groups")
    # an id that is null stands for a set only if no other row has it
    sets = rows.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("u"), F.first("n").alias("n"), F.first("grp").alias("grp"))
    sets = numbered(sets.join(groups.select("grp", "g"), "grp").drop("grp"), "sid", "near-distinct")
    posted = groups.select("n", "g", F.posexplode("prefix").alias("pos", "token")).select("token", "n", (F.col("n") - F.col("pos")).alias("rem"), "g")
    sorted_by = lambda df, *c: df.repartition("token").sortWithinPartitions("token", *c)
    live = materialize(sorted_by(posted).mapInArrow(lambda seen: _live(percent, seen), "token long, n long, rem long, g long"), "near-postings")

    several = sets.groupBy("g").agg(F.count("*").alias("m")).where("m > 1").select("g")
    wanted = live.select("g").unionByName(several).distinct()
    members = materialize(sets.join(wanted, "g", "left_semi"), "near-members")
    reps = members.groupBy("g").agg(F.min("sid").alias("rep"))

    degrees = live.groupBy("g").agg(F.count("*").alias("degree"))
    ranked = live.join(degrees, "g").select("token", "n", "rem", "g", "degree")
    ties = _plausible(sorted_by(ranked, "g").mapInArrow(lambda seen: _ties(percent, seen), "a long, b long"), groups, percent)
    ties = ties.join(reps.toDF("a", "ra"), "a").join(reps.toDF("b", "rb"), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    inside = members.join(reps, "g").select(F.col("rep").alias("a"), F.col("sid").alias("b"))
    first = _verified(ties.unionByName(inside), own, sets, width, percent)
    roots = components(first)

    known = materialize(members.join(roots, members["sid"] == roots["vertex"], "left").select("g", "sid", F.coalesce("root", "sid").alias("root")), "near-known")
    spread = live.join(known, "g").select("token", "n", "rem", "sid", "root", "g")
    rest = materialize(sorted_by(spread, "n", "sid").mapInArrow(lambda seen: _across(percent, seen), "a long, b long, ga long, gb long").distinct(), "near-across")
    likely = _plausible(rest.select(F.least("ga", "gb").alias("a"), F.greatest("ga", "gb").alias("b")), groups, percent).toDF("la", "lb")
    apart = rest.join(likely, (F.least("ga", "gb") == F.col("la")) & (F.greatest("ga", "gb") == F.col("lb")), "left_semi").select("a", "b")
    second = _verified(_within(known).unionByName(apart), own, sets, width, percent)
    roots = components(first.unionByName(second))

    least = sets.join(roots, sets["sid"] == roots["vertex"], "left").select("set", "u", F.coalesce("root", "sid").alias("root"))
    named = least.join(least.groupBy("root").agg(F.min("u").alias("component_id")), "root").select("set", "component_id")
    out = rows.select("doc_id", "n", "set").join(named, "set", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def oracle(percent: int = 80, width: int = 5) -> str:
    """Shingles as text, all pairs that share one, and the closure of the links."""
    return f"""
WITH RECURSIVE t AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {width} THEN list_transform(range(1, len(w) - {width} + 2), lambda j: array_to_string(w[j:j + {width - 1}], ' ')) ELSE [array_to_string(w, ' ')] END) AS shingle
    FROM t WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= {percent} * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS reached FROM t UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.reached) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
