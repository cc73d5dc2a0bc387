"""The corpus pipeline: five stages over ``documents``, each on all that the stage before has kept.

A stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read again as the next stage's
documents, so a lost executor repeats work of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from leadloom.llm import neardup, packing, pii, rules, weak_quality
from leadloom.llm.queries import PII_KEY, trusted_ids
from leadloom.llm.shared import let_workers_import, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram log-likelihood ratio."""
    weights = rules.gram_weights(docs, trusted_ids(table(spark, sf_dir, "labels")))
    return rules.apply_rules(docs, weights, out_col="__rules").where("__rules.kept").drop("__rules")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier keeps."""
    let_workers_import(spark)
    return weak_quality.classify(docs, weak_quality.fit(docs), out_col="__quality").where("__quality.kept").drop("__quality")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    let_workers_import(spark)
    return neardup.deduplicate(docs)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced; ``n_chars`` follows the text."""
    done = pii.pseudonymise(docs, PII_KEY, out_col="__pii").drop("__pii")
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    let_workers_import(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("pseudonyms", pseudonyms),
    ("best_fit_packing", best_fit_packing),
]

#: Hashed scores, MinHash and the tokenizer have no SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
