"""The registered queries of this folder and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import bwt, decontam, divergence, langid, merkle, ordinal, raking, rendezvous, repair, secretscan, simhash, tokencount, warc
from daybook.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal.graded(table(spark, sf_dir, "documents"), ordinal.ratings_of(table(spark, sf_dir, "labels")))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(*warc.archive(table(spark, sf_dir, "pages")))


def op3_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt.deduplicated(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("mark")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendezvous.shards(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raking.decisions(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(table(spark, sf_dir, "documents")).drop("mark")


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokencount.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_warc": op2_warc,
    "op3_merkle": op3_merkle,
    "op4_suffixes": op4_suffixes,
    "op5_decontamination": op5_decontamination,
    "op6_secrets": op6_secrets,
    "op7_sharding": op7_sharding,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_language": op10_language,
    "op11_tokens": op11_tokens,
    "op12_conversations": op12_conversations,
    "op13_divergence": op13_divergence,
}

ORACLE_SQL = {
    "op9_mixing": raking.ORACLE_SQL,
    "op2_warc": warc.PAGES_SQL,
    "op13_divergence": divergence.ORACLE_SQL,
}
