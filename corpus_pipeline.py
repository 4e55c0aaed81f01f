"""Corpus pipeline: toxicity, near duplicates, decontamination, mixing, token files.

Each stage works on all rows that the one before kept, and what it decides takes effect. All
but the last return the columns of documents. Stages follow the operators in what they make
of nulls, empty texts, repeated rows and empty tables; columns beyond those of documents are
dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthloom.llm import decontamination, mixing, near_duplicates, token_files, toxicity
from monthloom.llm.common import saved, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents of a higher score are rejected.
TOXIC = 0.3
#: A document of which one word in so many is a benchmark's is rejected.
SHARE = 20
TEMPERATURE = 0.7
SEED = 42
TOKENIZER, END_ID = "byte_bpe_50k.json", 2


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` but those whose doc_id is in ``rejected``; rows of null doc_id stay."""
    return docs.select(*COLUMNS).join(rejected.select("doc_id").distinct(), "doc_id", "left_anti")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on their labelled rows, does not reject."""
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), threshold=TOXIC)
    return _without(docs, scored.filter("predicted = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id, one row of it."""
    found = near_duplicates.near_duplicates(docs).filter("not kept")
    # One row a doc_id is chosen before the only shuffle of the texts; the join that follows keeps its order.
    once = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    return _without(once, found).unionByName(docs.select(*COLUMNS).filter("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    judged = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), SHARE)
    return _without(docs, judged.filter("contaminated"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's Poisson rate gives, in globally shuffled order."""
    return mixing.mix_sources(docs, temperature=TEMPERATURE, seed=SEED).select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files with their index; per row its place and checksum, read back from them."""
    return token_files.encode_to_files(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [
    ("toxicity", toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_output", token_output),
]
#: Toxicity is a fitted model and token ids come from a library: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
