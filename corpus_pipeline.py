"""From raw documents to packed training sequences: each stage works on what the one before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shoploom.llm import gam, packing, queries, rules
from shoploom.llm.common import table, written
from shoploom.llm.exact import ExactDuplicates
from shoploom.llm.simhash import NearDuplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels outside the held-out third, takes for label 1."""
    return gam.accepted(docs, queries.quality_model(spark, sf_dir, docs))


def rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return rules.passing(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return ExactDuplicates(docs).kept()


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return NearDuplicates(docs).kept()


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, packed into sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality),
    ("quality_rules", rule_filter),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("best_fit_packing", pack),
]

#: SQL can't express the classifier and the tokenizer; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
