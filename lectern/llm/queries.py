"""The thin queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, chat, embed_forest, fill_in_middle, line_dedup, mil, order_minhash, pfair, quality_rules, simhash, suffix_dedup, tie_ranks, unigram
from lectern.llm.common import documents, table
from lectern.llm.oracles import ORACLES


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies; operators take the path as a parameter."""
    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil.scored(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated(documents(spark, sf_dir)).drop("text_key")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    nodes = chat.conversations_as_trees(rows.unionByName(extra))
    return chat.digest(chat.format_trees(nodes, "conv_id", "node", "parent", "role", "text"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfair.scheduled(documents(spark, sf_dir).select("doc_id", "source")).drop("src_key")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(documents(spark, sf_dir)).drop("class_distance", "word_distance", "word_limit")


def op11_grouped_ranking_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tie_ranks.first_lines(table(spark, sf_dir, "sale_lines"))
    return lines.select("vendor_id", "part", "month", "pos", "place", "sale_id", "line_no", "quantity", "percent", "amount_cents", "tied")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(table(spark, sf_dir, "documents"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.with_next(documents(spark, sf_dir))


QUERIES = (op1_token_counts, op2_embedding_near_dedup, op3_line_dedup, op4_quality_classifier, op5_suffix_array_dedup, op6_chat_formatting, op7_simhash_near_dedup, op8_bpe_round_trip, op9_source_mix, op10_quality_rules, op11_grouped_ranking_ties, op12_fill_in_middle, op13_document_fingerprints)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
