"""Registered queries of the subpackage: (spark, sf_dir) -> DataFrame, each
over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from canvass.llm import alignment, chat_format, decontaminate, language_id, pii, quality, quality_rules, ranked_search, sentencepiece_bpe
from canvass.llm import sharding, simhash, token_count, winnowing
from canvass.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


# The one conversation that op2 adds to the table (fixed by its contract).
ADDED_CONVERSATION = """
SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)
"""


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = chat_format.conversation_messages(conversations.unionByName(spark.sql(ADDED_CONVERSATION)))
    return chat_format.conversation_digests(chat_format.format_conversations(messages))


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_likeness(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_classes(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_documents(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents")).withColumnRenamed("groups", "groups_sha256")


RULE_COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents")).select(*RULE_COLUMNS)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_chat_format": op2_chat_format,
    "op3_winnowing": op3_winnowing,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_pii": op5_pii,
    "op6_quality": op6_quality,
    "op7_decontaminate": op7_decontaminate,
    "op8_simhash": op8_simhash,
    "op9_token_counts": op9_token_counts,
    "op10_sharding": op10_sharding,
    "op11_alignment": op11_alignment,
    "op12_quality_rules": op12_quality_rules,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE_SQL: dict[str, str] = {
    "op2_chat_format": chat_format.ORACLE_SQL,
    "op12_quality_rules": quality_rules.ORACLE_SQL,
    "op13_ranked_search": ranked_search.ORACLE_SQL,
}
