"""URL filter: host and path rules, then a weighted vocabulary (operator 7).

Rules come first: a rule fits its host and every subdomain if the path starts
with the rule's; the longest rule wins.  All other URLs are judged by words: an
Aho-Corasick automaton finds every term of the vocabulary in one pass over the
lower-cased URL; a hit counts if no ASCII letter or digit touches it.  Each
different term counts once with its weight; a URL whose weights reach ``reject_at``
is blocked.  A strict term weighs as much as that alone, a soft one less.

The vocabulary is a table (term, weight); :func:`vocabulary` makes the one of the
registered query.  It may hold up to ``MOST_TERMS`` terms, which is checked: they go
to every worker, which builds one automaton and keeps it.  A term twice has its
larger weight; terms without letters or weight are left out; A-Z are lowered.

A null URL or one without ``://`` has an empty host and path and fits no rule;
its words are judged all the same (a null has none, so it is allowed).  Each
row gives one row, repeated rows and null ids included; an empty table gives no
rows, an empty vocabulary blocks nothing; URLs are taken whole, however long;
columns other than the id and the URL are not read and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from poolspark.llm.common import LOWER, UPPER

#: Terms that a vocabulary may hold; a million make an automaton of some hundred megabytes.
MOST_TERMS = 1_000_000
#: Weight at which a URL is blocked.
REJECT_AT = 2

# The stems of the vocabulary, and the forms in which each of them counts.
STRICT = """
bdsm camgirl casino cialis crackz cumshot escort fetish hentai hookup incest keygen levitra malware milf nude orgy phishing porn porno
pornstar ransomware sexcam shemale slut spam striptease viagra voyeur warez webcamsex xanax xvideo xxx
""".split()
SOFT = """
adult ads affiliate baccarat banner bet betting bingo bitcoin blackjack bonus cam cash casual cheap chat click clone coin coupon crack credit cure
dating deal debt detox diet discount download earn erotic farm fat free gamble game generic gift girl hack hot insurance jackpot keno kiss
loan lottery lotto love lucky massage miracle mortgage naked offer pharma pharmacy pill poker popup prize promo proxy replica ringtone roulette
serial sex sexy singles slim slot spin sportsbook stream subscribe supplement survey teen ticket torrent track tracker trial viral vip vpn watch weight win winner x
""".split()
FORMS = ("*", "*s", "*z", "*hub", "*site", "*online", "*world", "*4u", "best*", "free*", "my*", "top*", "get*", "buy*")
#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def vocabulary(spark: SparkSession) -> DataFrame:
    """(term, weight): every form of every stem."""
    stems = spark.createDataFrame([(s, REJECT_AT) for s in STRICT] + [(s, 1) for s in SOFT], "stem string, weight int")
    forms = spark.createDataFrame([(f,) for f in FORMS], "form string")
    return stems.crossJoin(F.broadcast(forms)).groupBy(F.replace("form", F.lit("*"), F.col("stem")).alias("term")).agg(F.max("weight").alias("weight"))  # two short lists


def collect_terms(terms: DataFrame) -> dict[str, int]:
    """The vocabulary's terms with their weights; more than MOST_TERMS are an error."""
    own = terms.select(F.translate("term", UPPER, LOWER).alias("term"), F.col("weight").cast("long").alias("weight")).where("term rlike '[^ ]' and weight is not null")
    rows = own.groupBy("term").agg(F.max("weight").alias("weight")).limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"a vocabulary of more than {MOST_TERMS} terms")
    return {r["term"]: r["weight"] for r in sorted(rows)}


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The text of the longest rule that fits, else null."""
    fits = lambda h, p: ((host == h) | host.endswith("." + h)) & path.startswith(p)
    longest = sorted(rules, key=lambda r: len(r[1] + r[2]))
    return reduce(lambda other, r: F.when(fits(r[1], r[2]), F.lit(r[1] + r[2])).otherwise(other), longest, F.lit(None).cast("string"))


_LAST: dict[str, object] = {}


def _automaton(key: str, terms):
    """The automaton of a vocabulary; a worker keeps the last one it built."""
    if key not in _LAST:
        import ahocorasick

        own = ahocorasick.Automaton()
        for term, weight in terms().items():
            own.add_word(term, (term, weight))
        if len(own):
            own.make_automaton()
        _LAST.clear()
        _LAST[key] = own
    return _LAST[key]


_LETTER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_LOWER = str.maketrans(UPPER, LOWER)


def hits(url: str | None, automaton) -> dict[str, int]:
    """The different terms of a URL with their weights."""
    found = {}
    if isinstance(url, str) and len(automaton):
        text = url.translate(_LOWER)
        for end, (term, weight) in automaton.iter(text):
            start = end - len(term) + 1
            if (start == 0 or text[start - 1] not in _LETTER) and (end + 1 == len(text) or text[end + 1] not in _LETTER):
                found[term] = weight
    return found


def word_hits(spark: SparkSession, terms: dict[str, int], reject_at: int):
    """Pandas UDF: struct of a URL's weight and of its numbers of different strict and soft terms."""
    key, held = hashlib.sha256(repr(sorted(terms.items())).encode()).hexdigest(), spark.sparkContext.broadcast(terms)

    @F.pandas_udf("weight long, strict int, soft int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(key, lambda: held.value)
        for urls in batches:
            rows = []
            for url in urls:
                weights = hits(url, automaton).values()
                strict = sum(w >= reject_at for w in weights)
                rows.append((sum(weights), strict, len(weights) - strict))
            yield pd.DataFrame(rows, columns=["weight", "strict", "soft"])

    return count


def judge(pages: DataFrame, terms: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, reject_at: int = REJECT_AT) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits."""
    spark = pages.sparkSession
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    parts = own.withColumn("rest", F.coalesce(_rest(F.col("url")), F.lit("")))
    parts = parts.withColumn("host", F.translate(F.regexp_extract("rest", "^([^/?#]*)", 1), UPPER, LOWER)).withColumn("path", F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1))
    judged = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("hits", word_hits(spark, collect_terms(terms), reject_at)("url"))
    says = {h + p: v for v, h, p in rules}
    verdict = reduce(lambda other, r: F.when(F.col("rule") == r, says[r]).otherwise(other), says, F.when(F.col("hits.weight") >= reject_at, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("hits.strict").alias("strict_hits"), F.col("hits.soft").alias("soft_hits"))


def oracle() -> str:
    """Terms are letters and digits only, so a hit is a whole run of them."""
    stems = ", ".join(f"('{s}', {w})" for own, w in ((STRICT, REJECT_AT), (SOFT, 1)) for s in own)
    forms = ", ".join(f"('{f}')" for f in FORMS)
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p}'" for _, h, p in longest)
    says = " ".join(f"WHEN rule = '{h + p}' THEN '{v}'" for v, h, p in RULES)
    return f"""
WITH v AS (SELECT replace(form, '*', stem) AS term, max(weight) AS weight FROM (VALUES {stems}) s(stem, weight), (VALUES {forms}) f(form) GROUP BY ALL),
p AS (SELECT row_number() OVER () AS row, page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT row, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT *, CASE {rule} END AS rule FROM h),
w AS (SELECT DISTINCT row, unnest(string_split_regex(low, '[^a-z0-9]+')) AS term FROM p),
c AS (SELECT row, sum(weight) AS weight, count(*) FILTER (WHERE weight >= {REJECT_AT}) AS strict, count(*) FILTER (WHERE weight < {REJECT_AT}) AS soft FROM w JOIN v USING (term) GROUP BY row)
SELECT page_id, host, path, rule, CASE {says} WHEN coalesce(weight, 0) >= {REJECT_AT} THEN 'block' ELSE 'allow' END AS verdict,
  CAST(coalesce(strict, 0) AS INTEGER) AS strict_hits, CAST(coalesce(soft, 0) AS INTEGER) AS soft_hits
FROM r LEFT JOIN c ON c.row = r.row
"""
