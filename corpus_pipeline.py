"""A corpus pipeline: language, near-duplicates, secrets, mixing, packing. Every stage works on all it is given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.llm import jaccard, language, mixing, packing, secret_scan
from ebbtide.llm.common import staged, table

LEAST_SCORE = 0.3  # below it no language is likelier than the others together by far; four languages guess at 0.25
MIX_SHARE = 0.9    # of the tokens that reach the stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (null, no letter, or no clear winner); fills a missing `lang`.

    Where no document is labelled, there is no model to decide by, and all stay as they are.
    """
    net = language.train(docs.select("doc_id", "text", "lang"))
    if net is None:
        return docs
    found = language.predict(docs.select(F.struct(*docs.columns).alias("row"), "text"), net)
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.coalesce(F.col("row.lang"), "lang_pred").alias("lang") if c == "lang" else F.col("row")[c].alias(c)
                         for c in docs.columns])


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link, directly or not, (5 words, 0.8), the smallest id stays."""
    return jaccard.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; no document goes."""
    masked = secret_scan.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the documents that bring sources to their weights within MIX_SHARE of the tokens."""
    return mixing.mix_documents(docs, MIX_SHARE)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language", identify_language), ("jaccard", keep_one_of_each_group), ("secrets", mask_secrets),
          ("mixing", mix_to_weights), ("packing", pack_windows)]
ORACLE_SQL = None  # models, tokens and positions of matches have no SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
