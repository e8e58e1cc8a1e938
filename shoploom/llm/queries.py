"""The registered queries of this package: each applies its operator to a whole table with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoploom.llm import checks, gam, hosts, language, lattice, lexical, mixing, negatives, packing, rules, wrapper
from shoploom.llm.common import in_fold, table
from shoploom.llm.exact import ExactDuplicates
from shoploom.llm.hmm import LanguageModel
from shoploom.llm.simhash import NearDuplicates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(checks.SQL)


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.text_model(table(spark, sf_dir, "documents"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return language.fused(pages, model).select("page_id", "lang", "score", "text_lang", "declared", "address")


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> gam.Model:
    """Fitted on the labels outside the held-out third."""
    labels = table(spark, sf_dir, "labels").where(~in_fold(F.col("doc_id"), 3, 1))
    return gam.train(docs, labels)


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = gam.scored(docs, quality_model(spark, sf_dir, docs), carried={"doc_id": F.col("doc_id")})
    return found.select("doc_id", in_fold(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    outcomes = hosts.document_outcomes(pages, table(spark, sf_dir, "labels"))
    return hosts.judged(pages, outcomes).select("page_id", *hosts.RESULTS)


@query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 10, 0)
    found = LanguageModel(docs, ~held_out).scores().withColumn("doc_id", F.col("row.doc_id"))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ExactDuplicates(docs).verdicts().select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judged(docs).select(F.col("row.doc_id").alias("doc_id"), *rules.BASE, "base_failed", "kept")


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return NearDuplicates(docs).verdicts().select("doc_id", "fingerprint", "component_id")


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return wrapper.extracted(pages).select("page_id", "url", "text", "n_chars")


@query
def op10_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")
    found = lattice.sampled(docs, path, lattice.piece_counts(docs, path))
    return found.select("doc_id", "sample", F.size("ids").alias("n_pieces"), "ids", "log_prob", "perturbed", "log_inclusion", "round_trip")


@query
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words("text").alias("size"))
    found = mixing.Mixture(docs, "size").taken()
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "epochs")


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.HardNegatives(rows, F.col("vec_id") % 100 == 0, label=moved).mined()


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.ranked(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
