"""Benchmark decontamination by MinHash containment (operator 10); DataFrame operations only.

Test items are short and documents long, so a document's own sketch of fixed
size would drown an item, and a bound that suits all items would suit none.
Items are therefore partitioned by size, and the sketch is the item's: its
MinHash signature is its ``k`` smallest shingle hashes.  An item of ``n`` shingles
that a document contains to the share ``t`` lacks at most ``n - ceil(t * n)`` of
them, so with ``k = n - ceil(t * n) + 1`` at least one of the ``k`` minima is a hash
of the document, and no such pair is missed.

1. *Partitions.*  One for each width and power of two of items' sizes, with two bounds of its
   own: the number of shingles that a document needs to hold any of its items,
   and the largest hash of its signatures.  The larger its items, the lower that hash.
2. *Probe.*  A document is put to each partition that it is long enough for, with
   those of its hashes that lie below the partition's bound, and meets the partition's
   signatures by (partition, hash).  Each pair must also reach the item's own
   least size.  Distinct (document, item) pairs are the candidates.
3. *Verification.*  Exact containment of the shingle texts decides.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; a shingle is five words.  An
item with fewer words is one shingle of them all and is looked for among
documents' windows of that many words; one without words matches nothing.
Null and empty texts have no words.  Rows with the same id count as one document or item,
whose shingles are those of all its rows; a null id is an id like any other.  Without
items or documents the result is empty.  Texts are taken whole, however long.
Other columns are not read, may have any name, and stay in :func:`clean`.
Items' signatures and shingles are broadcast while they are at most
``BROADCAST_ROWS``; above that, both joins shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poolspark.llm.common import LOWER, UPPER, unused
from poolspark.plans.shared import materialize

#: Rows of about 100 bytes that are still broadcast.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """Lower-cased words; empty without any."""
    own = F.btrim(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(own == "", F.array().cast("array<string>")).otherwise(F.split(own, "[\\x20\\x09-\\x0D]+"))


def _once(value: Column) -> Column:
    """The value as a generator's row, so that no filter is moved below it and computes it again for each element."""
    return F.explode(F.array(value))


def _hashes(w: str, width: int) -> Column:
    """64-bit hashes of all windows of ``width`` words."""
    args = ", ".join(f"{w}[i + {j}]" for j in range(width))
    return F.expr(f"IF(size({w}) >= {width}, transform(sequence(0, size({w}) - {width}), i -> xxhash64({args})), array())")


def _texts(w: str, width: int) -> Column:
    return F.expr(f"IF(size({w}) >= {width}, transform(sequence(0, size({w}) - {width}), i -> concat_ws(' ', slice({w}, i + 1, {width}))), array())")


def item_shingles(items: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, width, shingle, hash, n_item): distinct shingles."""
    own = items.select(F.col(id_col).alias("item_id"), _once(words(F.col(text_col))).alias("w")).where("size(w) > 0")
    cases = F.when(F.size("w") >= width, F.lit(width)).otherwise(F.size("w"))
    own = own.withColumn("width", cases)
    texts, hashes = F.array().cast("array<string>"), F.array().cast("array<long>")
    for k in range(1, width + 1):
        texts, hashes = F.when(F.col("width") == k, _texts("w", k)).otherwise(texts), F.when(F.col("width") == k, _hashes("w", k)).otherwise(hashes)
    rows = own.select("item_id", "width", F.explode(F.arrays_zip(texts.alias("t"), hashes.alias("h"))).alias("x")).select("item_id", "width", F.col("x.t").alias("shingle"), F.col("x.h").alias("hash")).distinct()
    sizes = rows.groupBy("item_id").agg(F.count("*").alias("n_item")).withColumnRenamed("item_id", "size_id")
    return rows.join(sizes, F.col("item_id").eqNullSafe(F.col("size_id"))).select("item_id", "width", "shingle", "hash", "n_item")


def need(n: str, percent: int) -> str:
    """SQL: the least whole number of at least ``percent`` hundredths of ``n``."""
    return f"(({n} * {percent} + 99) div 100)"


def signatures(shingles: DataFrame, percent: int) -> DataFrame:
    """(item_id, width, n_item, part, hash): the MinHash signature of each item, as many minima as its size asks for."""
    ranked = shingles.groupBy("item_id", "width", "n_item").agg(F.array_sort(F.collect_set("hash")).alias("hs"))
    k = f"cast(n_item - {need('n_item', percent)} + 1 as int)"
    return ranked.select("item_id", "width", "n_item", F.floor(F.log2("n_item")).cast("int").alias("part"), F.explode(F.expr(f"slice(hs, 1, {k})")).alias("hash"))


def partitions(minima: DataFrame, percent: int) -> dict[int, list[dict]]:
    """By width: part, least (shingles that a document needs) and most (largest hash); as many rows as there are powers of two."""
    out: dict[int, list[dict]] = {}
    for r in minima.groupBy("width", "part").agg(F.max("hash").alias("most"), F.min("n_item").alias("n")).orderBy("width", "part").collect():
        out.setdefault(r["width"], []).append({"part": r["part"], "most": r["most"], "least": -(-r["n"] * percent // 100)})
    return out


def _probes(parts: list[dict]) -> str:
    """SQL: what of a document's hashes ``hs`` each partition is asked for."""
    one = "IF(size(hs) >= {least}, transform(filter(hs, h -> h <= {most}L), h -> named_struct('part', {part}, 'hash', h)), cast(array() as array<struct<part:int,hash:bigint>>))"
    return "flatten(array(" + ", ".join(one.format(**p) for p in parts) + "))"


def contained(docs: DataFrame, items: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_item, n_found, containment): items of which a document has ``percent`` hundredths or more."""
    shingles = materialize(item_shingles(items, width, item_id, item_text), "leak-items")
    held = lambda df: F.broadcast(df) if small else df
    small = shingles.count() <= BROADCAST_ROWS
    minima = materialize(signatures(shingles, percent), "leak-minima")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), _once(words(F.col(text_col))).alias("w"))
    found, hits, parts = [], [], partitions(minima, percent)
    if not parts:
        return shingles.select(F.lit(0).cast("long").alias("doc_id"), "item_id", "n_item", F.lit(0).cast("long").alias("n_found"), F.lit(0.0).alias("containment")).where("false")
    for k, mine in parts.items():
        hashed = own.select("doc_id", _once(_hashes("w", k)).alias("hs")).where(F.size("hs") >= min(p["least"] for p in mine))
        probes = hashed.select("doc_id", F.size("hs").alias("n_doc"), F.explode(F.expr(_probes(mine))).alias("p")).select("doc_id", "n_doc", "p.part", "p.hash")
        pairs = probes.join(held(minima.where(F.col("width") == k)), ["part", "hash"]).where(F.expr(f"n_doc >= {need('n_item', percent)}"))
        found.append(pairs.select("doc_id", "item_id"))
    candidates = materialize(reduce(DataFrame.unionByName, found).distinct(), "leak-candidates")
    docs_in = candidates.select(F.col("doc_id").alias("candidate")).distinct()
    texts = own.join(docs_in, own["doc_id"].eqNullSafe(docs_in["candidate"]), "left_semi")
    for k in parts:
        rows = texts.select("doc_id", F.explode(_texts("w", k)).alias("shingle"))
        hits.append(rows.join(held(shingles.where(F.col("width") == k)), "shingle").select("doc_id", "item_id", "n_item", "shingle"))
    counts = reduce(DataFrame.unionByName, hits).distinct().groupBy("doc_id", "item_id", "n_item").agg(F.count("*").alias("n_found")).where(F.col("n_found") * 100 >= F.col("n_item") * percent)
    pair = candidates.select(F.col("doc_id").alias("c_doc"), F.col("item_id").alias("c_item"))
    sure = counts.join(pair, counts["doc_id"].eqNullSafe(pair["c_doc"]) & counts["item_id"].eqNullSafe(pair["c_item"]), "left_semi")
    return sure.withColumn("containment", F.col("n_found") / F.col("n_item")).select("doc_id", "item_id", "n_item", "n_found", "containment")


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that contain an item."""
    name = unused(docs, "leak_id")
    leaks = contained(docs, items, **options).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(leaks, F.col(options.get("id_col", "doc_id")).cast("long").eqNullSafe(F.col(name)), "left_anti")


ORACLE = f"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
s AS (SELECT DISTINCT item_id, least(len(w), 5) AS k, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda j: array_to_string(w[j:j + least(len(w), 5) - 1], ' '))) AS shingle FROM i WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id),
d AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS shingle FROM t, (SELECT DISTINCT k FROM s) WHERE len(w) >= k),
c AS (SELECT doc_id, item_id, count(*) AS n_found FROM d JOIN s USING (k, shingle) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment FROM c JOIN n USING (item_id) WHERE n_found * 100 >= n_item * 80
"""
