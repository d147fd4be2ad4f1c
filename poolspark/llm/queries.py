"""Queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from poolspark.llm import bpe, decontam, filter_audit, jaccard_join, line_dedup, maxscore, prefix_trie, quality_mil, quality_rules, secrets, sharding, token_count, url_filter
from poolspark.llm.common import documents, table


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(documents(spark, sf_dir), word_vocabulary(), decode=True))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(documents(spark, sf_dir), word_vocabulary(), limit=2048)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(line_dedup.dedup(documents(spark, sf_dir), min_chars=10))


#: Bytes of text that a shard may hold: small enough that the smallest tables are split as well.
SHARD_BYTES = 64 << 10


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_map(documents(spark, sf_dir), SHARD_BYTES)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_mil.judge(docs, quality_mil.fit(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.vocabulary(spark))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir), percent=80, width=5)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(documents(spark, sf_dir)))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), percent=80, width=5)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.digests(table(spark, sf_dir, "conversations"))


def op12_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_token_counts": op2_token_counts,
    "op3_line_dedup": op3_line_dedup,
    "op4_sharding": op4_sharding,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_url_filter": op7_url_filter,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_secret_scan": op9_secret_scan,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_maxscore": op12_maxscore,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": line_dedup.ORACLE,
    "op4_sharding": sharding.oracle(SHARD_BYTES),
    "op7_url_filter": url_filter.oracle(),
    "op8_near_duplicates": jaccard_join.oracle(),
    "op9_secret_scan": secrets.oracle(),
    "op10_decontamination": decontam.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_maxscore": maxscore.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
