"""Registered queries of the operators in this folder, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pactframe.llm import chat_format, fill_middle, fingerprints, line_crf, mixing, near_dedup, packing, quality_rules, substring_dedup, suffix_tree, token_counts, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.score(docs, line_crf.train(docs, table(spark, sf_dir, "labels")))


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_words(table(spark, sf_dir, "documents"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(spark, table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digests(chat_format.with_probe(table(spark, sf_dir, "conversations")))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_quality": op2_quality,
    "op3_substrings": op3_substrings,
    "op4_mix": op4_mix,
    "op5_pack": op5_pack,
    "op6_warc": op6_warc,
    "op7_rules": op7_rules,
    "op8_near": op8_near,
    "op9_tokens": op9_tokens,
    "op10_lm": op10_lm,
    "op11_whitening": op11_whitening,
    "op12_chat": op12_chat,
    "op13_fim": op13_fim,
}
ORACLE: dict[str, str] = {"op4_mix": mixing.MIX_SQL, "op6_warc": warc.WARC_SQL, "op12_chat": chat_format.CHAT_SQL, "op13_fim": fill_middle.FIM_SQL}
