"""Queries opN_<name> over the whole tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthloom.llm import centroids, chat, decontamination, embedding_duplicates, language, mixing, near_duplicates, prefix_trie, recurrent, token_counts, token_files, toxicity, url_filter
from monthloom.llm.common import table


#: Vocabulary files; ids 0 to 2 of the piece vocabulary are its controls.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2


def op1_embedding_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_duplicates.near_duplicates(table(spark, folder, "embeddings"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), PIECES)


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"), PIECES)


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.encode_to_files(table(spark, folder, "documents"), BYTES, END_ID)


def op5_recurrent(spark: SparkSession, folder: str) -> DataFrame:
    return recurrent.score_texts(table(spark, folder, "documents"))


def op6_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.collapse_snapshots(table(spark, folder, "conversations"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.withColumns({"rate": F.round("rate", 6), "text_md5": F.md5(F.col("text").cast("binary"))}).drop("text")


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("passages")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))


def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"))


def op13_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, folder, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_embedding_duplicates, op2_token_counts, op3_near_duplicates, op4_language, op5_recurrent, op6_chat, op7_mixing, op8_decontamination, op9_token_files, op10_toxicity,
    op11_prefix_trie, op12_url_filter, op13_centroids,
)}
ORACLES = {"op1_embedding_duplicates": embedding_duplicates.SQL, "op3_near_duplicates": near_duplicates.SQL, "op6_chat": chat.SQL, "op7_mixing": mixing.SQL, "op8_decontamination": decontamination.SQL, "op11_prefix_trie": prefix_trie.SQL, "op13_centroids": centroids.SQL}
