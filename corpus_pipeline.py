"""Cleaning a corpus in stages; each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm import decontaminate, language_id, mixing, ngram_join, substring_dedup
from demandloom.llm.common import free_name, row_key, stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language, or without a main one, go; a null lang is filled."""
    model = language_id.learn(docs.where(language_id.learning_fold()))
    return language_id.keep_known(docs, model, least=0.3)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles at a similarity of 0.8 the least id stays.

    One row of each group stays.  Rows are told apart by all their columns: those of
    one id and different texts are judged one by one, equal rows are one text.  No id
    is less than any id; of equal ids the one with the least row key stays.
    """
    own = free_name(docs.columns, "row_key")
    kept_key = free_name([*docs.columns, own], "kept_key")
    keyed = docs.withColumn(own, row_key(docs.columns))
    groups = ngram_join.similar_groups(keyed, size=5, similarity=0.8, id_col=own).select(
        F.col("doc_id").alias("key"), "component_id")
    rows = keyed.select(F.col(own).alias("mine"), F.col("doc_id").alias("id"))
    first = rows.join(groups, F.col("mine") == F.col("key")).groupBy("component_id").agg(
        F.min(F.struct("id", "mine"))["mine"].alias(kept_key))
    kept = keyed.join(first.select(kept_key).hint("merge"), F.col(own) == F.col(kept_key), "left_semi")
    return kept.dropDuplicates([own]).drop(own)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages leave the texts; a text that holds nothing else goes.

    Each row is cut by its own text; see ``substring_dedup.cut_rows`` for rows of one
    id and rows without an id.
    """
    removed = free_name(docs.columns, "n_removed")
    n_chars = F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return substring_dedup.cut_rows(docs, 50, removed).withColumn("n_chars", n_chars).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold a benchmark item, within a fifth of its words in edits, go, each row by its own text."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of half the tokens, by the target shares of source, language and topic; scarce cells are kept whole.

    Only doc_id, text, lang and source go on, with what ``mixing`` adds to them.
    """
    measured = mixing.measure(docs, keep_text=True)
    counts = stage(measured.drop("text"), "mixing-measured")
    return mixing.mix_all(measured, counts).where("sampled").drop("sampled")


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_each_group),
    ("substring_dedup", cut_repeats),
    ("decontamination", without_benchmark),
    ("mixing", to_target_weights),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
